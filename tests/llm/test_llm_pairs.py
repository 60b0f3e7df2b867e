"""Queries that SQL can express, against their SQL; the pipeline and its stages."""

from __future__ import annotations

import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check_pairs import compare, connect
from tabularium.llm import packing, pii, queries

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from test_simhash import brute_components, slow_fingerprint  # noqa: E402
from test_texts import slow_languages, slow_spans  # noqa: E402


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_agrees_with_its_sql(spark, small, name):
    assert compare(spark, connect(small), name, small) == ""


def test_all_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")} and "pipeline" in names


def test_native_queries_run_no_python(spark, small, plan):
    for name in queries.QUERIES:
        if name.split("_")[0] in ("op3", "op5", "op6", "op7", "op8"):
            text = plan(queries.QUERIES[name](spark, small))
            assert not any(word in text for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop")), name


def test_pipeline_on_awkward_documents(spark, docs, small, tmp_path):
    leak = spark.read.parquet(f"{small}/benchmark.parquet").first()["text"]
    words = " ".join(f"word{i % 37}x{i}" for i in range(400))
    table = docs([None, "", " \n ", "123 456", words, words, f"intro {leak} outro", "mail me at jo@ex.example.com now", "x" * 50_000, (None, "nobody owns this text")])
    frame = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, small)
        assert frame.columns == table.columns, name
        frame.write.parquet(str(tmp_path / name.replace(" ", "-")))
        frame = spark.read.parquet(str(tmp_path / name.replace(" ", "-")))
    kept = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert set(kept) == {4, 7, 8, None}
    assert kept[7] == "mail me at [EMAIL] now" and kept[4] == words
    packed = corpus_pipeline.STAGES[-1][1](spark, frame, small)
    assert {r["doc_id"] for r in packed.collect()} == set(kept)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, table.limit(0), small).count() == 0, name


def slow_leak(text, items):
    """Whether 80 % of 15 tokens (all tokens, in items of fewer) agree along some alignment with an item."""
    own = np.array([hash(w) for w in slow_tokens(text)], np.int64)
    for item in items:
        width = min(15, item.size)
        least = -(-width * 8 // 10) if width >= 8 else width
        for shift in range(-item.size + 1, own.size):
            low, high = max(0, -shift), min(item.size, own.size - shift)
            equal = np.zeros(item.size, int)
            equal[low:high] = item[low:high] == own[low + shift : high + shift]
            if np.convolve(equal, np.ones(width, int), "valid").max() >= least:
                return True
    return False


def slow_tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def slow_pipeline(documents, benchmark):
    """``(doc_id, text)`` that four stages leave, by plain Python over all pairs."""
    learned = [(r["text"], r["lang"]) for r in documents if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    told = slow_languages(learned, [r["text"] for r in documents])
    rows = [(r["doc_id"], r["text"]) for r, (name, _) in zip(documents, told, strict=True) if name != "und"]
    least = brute_components([(i, slow_fingerprint(t)) for i, t in rows])
    rows = [(i, t) for (i, t), first in zip(rows, least, strict=True) if i == first]
    items = [np.array([hash(w) for w in slow_tokens(r["text"])], np.int64) for r in benchmark]
    rows = [(i, t) for i, t in rows if not slow_leak(t, [x for x in items if x.size >= 5])]
    seen = Counter()
    spans = {}
    for i, t in rows:
        base = slow_spans(t)
        spans[i] = base, pii.candidates(t, base)
        for span in base + spans[i][1]:
            seen[span[1], pii.votes(t, span), pii._features(t, span)] += 1
    model = pii.estimate(seen)
    out = []
    for i, t in rows:
        base, more = spans[i]
        found = base + [s for s in more if model.likelihood(s[1], pii.votes(t, s), pii._features(t, s)) >= pii.THRESHOLD]
        marks, end = [], 0
        for a, kind, b in sorted(found):
            if a >= end:
                marks.append((a, b, kind))
            else:
                marks[-1] = (marks[-1][0], max(marks[-1][1], b), marks[-1][2])
            end = max(end, b)
        for a, b, kind in reversed(marks):
            t = f"{t[:a]}[{pii.ALL_KINDS[kind].upper()}]{t[b:]}"
        out.append((i, t))
    return out


def test_pipeline_by_brute_force(spark, small):
    """Every piece of every document that five plain-Python stages leave, and no other."""
    import public_tokenizers
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY)).encode
    documents, benchmark = (spark.read.parquet(f"{small}/{n}.parquet").collect() for n in ("documents", "benchmark"))
    want = set()
    for doc_id, text in slow_pipeline(documents, benchmark):
        ids = [*encode(text, add_special_tokens=False).ids, 0]
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[at : at + 2048], "<u4")
            want.add((doc_id, piece, at, part.size, zlib.crc32(part.tobytes())))
    rows = corpus_pipeline.run(spark, small).collect()
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert len(got) == len(set(got)) and set(got) == want
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in places.values():
        ends = np.cumsum([n for _, n in sorted(pieces)])
        assert [a for a, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_the_language_stage_writes_what_it_predicts(spark, small):
    before = spark.read.parquet(f"{small}/documents.parquet")
    told = {r["doc_id"]: r["lang_pred"] for r in queries.QUERIES["op1_rank_order_language"](spark, small).collect()}
    after = corpus_pipeline.identify_language(spark, before, small)
    assert {r["doc_id"]: r["lang"] for r in after.collect()} == {i: name for i, name in told.items() if name != "und"}
    wrong = before.withColumn("lang", F.lit(None).cast("string")).withColumn("text", F.lit("no language was learned"))
    assert corpus_pipeline.identify_language(spark, wrong, small).count() == 0
