"""The operators that are DataFrame operations only."""

from __future__ import annotations

import itertools
import math

import pytest
from pyspark.sql import functions as F

from tabularium.llm import chat, decontamination, hilbert, line_frequency, url_rules


# Decontamination


def test_masks_leave_no_allowed_pattern_unseen():
    for width in range(decontamination.EXACT_BELOW, decontamination.WINDOW + 1):
        allowed = width - math.ceil(width * decontamination.SIMILARITY - 1e-9)
        for gone in itertools.combinations(range(width), allowed):
            assert any(
                all(at + k not in gone for k in mask) for mask in decontamination.MASKS for at in range(width - mask[-1])
            ), (width, gone)


def test_leaks_with_substitutions(spark, docs):
    item = [f"t{i}" for i in range(30)]
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None), (4, ""), (1, " ".join(item))], "item_id long, text string")

    def swap(places):
        return " ".join(f"z{i}" if i in places else w for i, w in enumerate(item))

    rows = [
        (0, "before " + " ".join(item) + " after"), (1, swap({4, 8, 12, 19, 23, 27})), (2, " ".join(item[:14])), (3, " ".join(item[5:20]).upper()),
        (4, swap(set(range(0, 30, 3)))), (5, None), (6, ""), (7, "too short"), (8, "clean words " * 5000), (None, " ".join(item)), (0, "again"),
    ]
    found = decontamination.leaks(docs(rows), bench)
    assert {(r["doc_id"], r["item_id"], r["n_window"], r["n_equal"]) for r in found.collect()} == {
        (0, 1, 15, 15), (1, 1, 15, 12), (2, 1, 15, 14), (3, 1, 15, 15), (None, 1, 15, 15)}
    assert found.count() == 5
    kept = decontamination.keep_clean(docs(rows), found)
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6, 7, 8] and kept.columns == docs(rows).columns
    assert decontamination.leaks(docs(rows).limit(0), bench).count() == decontamination.leaks(docs(rows), bench.limit(0)).count() == 0


def test_short_items_and_scripts_without_spaces(spark, docs):
    items = ["What is the capital of France", "法国的首都是哪里呢", "हिन्दी भाषा में पाँच शब्द", "only four words here", "ประเทศไทยอยู่ที่ไหน", "日本の首都はどこですか、東京です"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = [
        (0, "quiz: what is the capital of france? Paris"), (1, "what is the big capital of france"), (2, "请问法国的首都是哪里呢？巴黎"), (3, "法国的首都哪里"),
        (4, "यह हिन्दी भाषा में पाँच शब्द है"), (5, "हिनदी भाषा में पाँच शब्द"), (6, "only four words here"), (7, "ข้อ ประเทศไทยอยู่ที่ไหน"), (8, "日本の首都はどこですか、京都です"),
    ]
    got = {(r["doc_id"], r["item_id"]): (r["n_window"], r["n_equal"]) for r in decontamination.leaks(docs(rows), benchmark).collect()}
    assert set(got) == {(0, 0), (2, 1), (4, 2), (7, 4), (8, 5)}
    assert got[0, 0] == (6, 6) and got[2, 1] == (9, 9) and got[4, 2] == (5, 5) and got[8, 5] == (15, 13)


def test_leaks_without_broadcast(spark, docs, monkeypatch):
    item = " ".join(f"t{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(i, f"p{i} {item}" if i % 3 == 0 else f"nothing {i} here at all to see") for i in range(30)]
    want = sorted(map(tuple, decontamination.leaks(docs(rows), bench).collect()))
    monkeypatch.setattr(decontamination, "MAX_BROADCAST_BYTES", 0)
    assert sorted(map(tuple, decontamination.leaks(docs(rows), bench).collect())) == want and len(want) == 10


# Hilbert shards


def slow_index(x, bits):
    x, n, q = list(x), len(x), 1 << (bits - 1)
    top = q
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, top
    while q > 1:
        t ^= q - 1 if x[-1] & q else 0
        q >>= 1
    return int("".join(str((v ^ t) >> b & 1) for b in range(bits - 1, -1, -1) for v in x), 2)


@pytest.mark.parametrize(("n", "bits"), [(2, 3), (3, 2), (4, 2), (2, 1)])
def test_curve(spark, n, bits):
    points = list(itertools.product(range(1 << bits), repeat=n))
    df = spark.createDataFrame(points, [f"c{i}" for i in range(n)])
    got = {tuple(r[:n]): r[n] for r in hilbert.with_curve_index(df, [F.col(f"c{i}") for i in range(n)], bits).collect()}
    assert got == {p: slow_index(p, bits) for p in points}
    walk = sorted(got, key=got.get)
    assert all(sum(abs(a - b) for a, b in zip(p, q, strict=True)) == 1 for p, q in zip(walk, walk[1:], strict=False))


def test_shards(spark, docs, tmp_path):
    rows = [(i, None if i % 9 == 0 else "ä" * (i % 40), ["en", "de", None][i % 3], f"src{i % 7}" if i % 2 else "src0") for i in range(500)]
    table = docs([*rows, *rows[:50], (None, "x", "en", "s")])
    placed = hilbert.shard_documents(table)
    got = placed.collect()
    sizes = [sum(r["shard"] == s for r in got) for s in range(24)]
    assert sum(sizes) == 551 and max(sizes) - min(sizes) <= 1
    for s in range(24):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sizes[s]))
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    assert all(a["curve"] <= b["curve"] for a, b in zip(order, order[1:], strict=False))
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[0]["size"] == 8 and by_id[1]["size"] == 10 and by_id[0]["text_crc32"] == 0 and by_id[0]["grown_shard"] is None
    assert hilbert.shard_documents(table.limit(0)).count() == 0
    hilbert.write_shards(table.where("doc_id is not null").dropDuplicates(["doc_id"]), str(tmp_path / "out"), placed)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 500
    ranges = placed.groupBy("shard").agg(F.countDistinct("dim_source").alias("n")).agg(F.avg("n")).first()[0]
    assert ranges < 5  # of 8 sources


def test_strings_are_ranked_whole(spark, docs):
    names = [f"https://www.a-very-long-shared-prefix.org/host{i}" for i in range(8)]
    table = docs([(i, "x" * 10, "en", names[i * 8 // 640]) for i in range(640)])
    cells = hilbert.quantise(table, ["source"], 3)
    found = {(r[0], r[1]) for r in table.select("source", cells[0]).collect()}
    assert found == {(n, i) for i, n in enumerate(names)}
    rows = hilbert.shard_documents(table, shards=8, dimensions=("source",)).groupBy("shard").agg(F.countDistinct("dim_source").alias("n")).collect()
    assert {r["n"] for r in rows} == {1}
    skewed = docs([(i, "x", "en", None if i % 10 == 0 else "hot" if i % 3 else f"s{i}") for i in range(300)])
    edges = hilbert.value_edges(skewed.select("source"), "source", 4)
    values = sorted(r[0] for r in skewed.where("source is not null").select("source").collect())
    assert edges == [values[-(-len(values) * k // 4) - 1] for k in (1, 2, 3)]
    assert hilbert.value_edges(skewed.limit(0).select("source"), "source", 4) == []


# Line frequency


def letters(i):
    return "".join("abcdefghij"[int(c)] for c in str(i))


def test_lines_and_verdicts(docs):
    body = " ".join(f"w{letters(i)}" for i in range(60))
    common = "Buy  now 123!"
    rows = [(i, f"{body} {letters(i)} x\n{common}\n", "en", "a") for i in range(25)]
    rows += [(100, f"{common}\nbuy  NOW 9!\n" + " ".join(f"k{i}" for i in range(60)) + "\n" + f"{common}\n" * 40, "en", "a"), (101, f"{common}\n" + body + " unique", "en", "b")]
    rows += [(102, None, "en", "a"), (103, "", "en", None), (104, "a b c a b c a b", "en", "a"), (None, f"{body} own", "en", "a")]
    table = docs(rows)
    got = {r["doc_id"]: r for r in line_frequency.judge(table).collect()}
    assert len(got) == len(rows)
    assert got[3]["kept"] and got[101]["kept"] and got[None]["kept"]
    assert not got[100]["kept"] and got[100]["base_failed"]
    assert got[102]["base_failed"] and got[103]["n_words"] == 0 and got[104]["n_repeat_words"] == 8
    assert got[100]["n_dup_lines"] == 40 and got[3]["n_symbols"] == 0
    cleaned = line_frequency.clean(table)
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert cleaned.columns == table.columns and common not in texts[3] and texts[3].startswith(body) and common in texts[101]
    assert line_frequency.judge(table.limit(0)).count() == 0


def test_copies_of_a_row_are_one_document(docs, monkeypatch):
    text = "\n".join(" ".join(f"c{letters(j)}x{letters(i)}" for i in range(20)) for j in range(4))
    for bound in (line_frequency.MAX_BROADCAST_BYTES, 0):
        monkeypatch.setattr(line_frequency, "MAX_BROADCAST_BYTES", bound)
        got = line_frequency.judge(docs([(7, text, "en", "a")] * 25)).collect()
        assert len(got) == 25 and all(r["kept"] and r["removed_chars"] == 0 for r in got)
        nobody = line_frequency.judge(docs([(None, text, "en", "a")] * 25)).collect()
        assert len(nobody) == 25 and not any(r["kept"] for r in nobody)


def test_repeated_words_of_a_long_text(docs):
    words = [f"v{i * 7919 % 90_001}" for i in range(90_000)] + ["x", "y", "z"] * 2 + [f"v{i * 7919 % 90_001}" for i in range(50)]
    assert line_frequency.judge(docs([" ".join(words)])).first()["n_repeat_words"] == 6 + 100


def test_depleted_documents_go(docs):
    lines = [" ".join(f"b{letters(j)}x{letters(i)}" for i in range(20)) for j in range(4)]
    rows = [(i, "\n".join([*lines, f"own {letters(i)}"]), "en", "a") for i in range(21)] + [(50, "\n".join(lines), "en", "b")]
    got = {r["doc_id"]: r for r in line_frequency.judge(docs(rows)).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert not got[0]["kept"] and got[50]["kept"] and got[0]["removed_chars"] < got[0]["line_chars"]


@pytest.mark.parametrize("text", ["", "a", "a a a", "a a a a", "a b c", "a b c a b c", "x a b c y a b c d", "a b a b a b a", "q w e r t y " * 40])
def test_repeated_words(docs, text):
    words = text.split()
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    assert line_frequency.judge(docs([text])).first()["n_repeat_words"] == len(covered)


# URL rules


def slow_match(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("rows_per_range", [3, 100_000])
def test_url_rules(spark, rows_per_range):
    rules = [*url_rules.RULES, ("block", "a.example.net", "/en/x"), ("allow", "example.net", "/"), ("block", "xample.net", "/"), ("allow", "b.org", ""), ("block", "com", "/z")]
    hosts = ["example.net", "a.example.net", "b.a.EXAMPLE.net", "xample.net", "net", "nets", "example.com", "w.example.com", "b.org", "c.b.org", "org", "com", "", "é.com", "example.net:80"]
    urls = [f"{s}://{h}{p}" for s in ("http", "x") for h in hosts for p in ("", "/", "/en/", "/en/x?q=/de/", "/de/1#a", "/fr/", "/z", "?a=b", "#top")]
    urls += [None, "", "no scheme", "://", "a://b://c/d", "http://example.net/en/\nx"] + ["http://hot.example.net/en/1"] * 60
    table = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, key string, rule string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_rules.match(table, rules, rows_per_range=rows_per_range).collect()}
    assert got == {i: slow_match(u, rules) for i, u in enumerate(urls)}
    assert url_rules.match(table.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_rules.match(table, []).collect()} == {"allow"}
    left = url_rules.filter_allowed(table, url_rules.match(table, rules))
    assert left.columns == table.columns and left.count() == sum(v[3] == "allow" for v in got.values())


def test_url_ranges_beyond_their_number_become_copies(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "MAX_RANGES", 2)
    table = spark.createDataFrame([(i, f"http://h{i % 7}.example.{'net' if i % 3 else 'com'}/{'en' if i % 2 else 'de'}/{i}") for i in range(200)], "page_id long, url string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_rules.match(table, url_rules.RULES, rows_per_range=5).collect()}
    assert got == {r["page_id"]: slow_match(r["url"], url_rules.RULES) for r in table.collect()}


# Chat


@pytest.mark.parametrize("block", [2, 256])
def test_snapshots_collapse(spark, block):
    def turns(conv, texts, roles=None):
        return [(conv, i, (roles or ["user", "assistant"])[i % 2], t, "extra") for i, t in enumerate(texts)]

    rows = [
        *turns(1, ["a", "b"]), *turns(2, ["a", "b", "c"]), *turns(3, ["a", "b", "c", "d", "e"]), *turns(4, ["a", "x"]), *turns(5, ["a", "b", "c", "d", "e"]),
        *turns(6, ["a", "b"], ["user", "tool"]), *turns(7, ["b", "a"]), (8, None, None, None, "e"), (8, 4, "user", "later", "e"), (8, 4, "user", "later", "e"),
        (None, 0, "user", "lost", "e"), (9, 7, "user", "a", "e"), (10, 0, "user", "", "e"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string")
    got = {}
    for r in sorted(chat.format_conversations(table, block).collect()):
        got[r["conv_id"]] = got.get(r["conv_id"], "") + r["text"]
    assert set(got) == {3, 4, 6, 7, 8, 10}
    assert got[3] == "<|user|>\na\n<|assistant|>\nb\n<|user|>\nc\n<|assistant|>\nd\n<|user|>\ne\n"
    assert got[8] == "<|unknown|>\n\n<|user|>\nlater\n" and got[10] == "<|user|>\n\n"
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_a_long_conversation_comes_in_segments(spark):
    table = spark.range(1000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    rows = chat.format_conversations(table, 100).collect()
    assert sorted((r["segment"], r["n_turns"]) for r in rows) == [(i, 100) for i in range(10)]


def test_turns_without_numbers_or_with_sparse_or_equal_ones(spark):
    """Places, lengths and prefixes of conversations whose turns say little, cut in small blocks, against plain Python."""
    rows = [(1, None, "user", f"t{i % 40:03}") for i in range(90)] + [(2, 7, "user", f"t{i:03}") for i in range(40)]
    rows += [(3, 10_000_000_000 * i - 5, "assistant", f"t{i:03}") for i in range(60)] + [(4, i, "user", None) for i in range(30)] + [(5, i, "user", "x" * 300 + str(i % 5)) for i in range(9)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = chat.turns(table, 4).collect()
    want = {}
    for row in sorted(set(rows), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3] is not None, r[3] or "")):
        want.setdefault(row[0], []).append(row[1:])
    for conv, turns in want.items():
        mine = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: r["place"])
        assert [(r["turn"], r["role"], r["text"]) for r in mine] == turns
        assert [r["place"] for r in mine] == list(range(len(turns))) and {r["n"] for r in mine} == {len(turns)}
    prefixes = {}
    for r in got:
        told = tuple((role, text) for _, role, text in want[r["conv_id"]][: r["place"] + 1])
        prefixes.setdefault((r["place"], r["a"], r["b"]), set()).add(told)
    assert all(len(told) == 1 for told in prefixes.values())
    assert len(prefixes) == len(set().union(*prefixes.values())) and len(got) == sum(map(len, want.values()))
