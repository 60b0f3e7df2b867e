"""Language ID, language-model scores and personal data."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabularium.llm import brown, langid, pii
from tabularium.llm.queries import QUERIES


# Language ID


def slow_ngrams(text):
    out = Counter()
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        padded = f"\0{word}\0"
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                if padded[i : i + n] != "\0":
                    out[tuple(map(ord, padded[i : i + n]))] += 1
    return out


@pytest.mark.parametrize("text", ["", "a", "ab cd ab", "Éa 12 b--c", "no\nle\tt", "x" * 3000 + " yz"])
@pytest.mark.parametrize("window", [5, 1 << 20])
def test_ngrams(monkeypatch, text, window):
    monkeypatch.setattr(langid, "_WINDOW", window)
    keys, counts = langid.ngrams(text)
    got = {}
    for key, n in zip(keys.tolist(), counts.tolist(), strict=True):
        parts = [key >> 42, key >> 21 & langid._NONE, key & langid._NONE]
        got[tuple(p for p in parts if p != langid._NONE)] = n
    assert got == slow_ngrams(text)


def slow_order(counts, top=langid.TOP):
    """The most frequent n-grams; ties go by number, in which shorter n-grams stand behind."""
    filled = lambda g: (langid._NONE,) * (3 - len(g)) + g
    return sorted(counts, key=lambda g: (-counts[g], filled(g)))[:top]


def slow_languages(rows, predicted):
    """``(language, score)`` of each text in ``predicted``, learned from ``(text, lang)`` in ``rows``."""
    total = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            total.setdefault(lang, Counter()).update(slow_ngrams(text))
    profiles = {lang: {g: i for i, g in enumerate(slow_order(counts))} for lang, counts in sorted(total.items())}
    out = []
    for text in predicted:
        own = slow_order(slow_ngrams(text or ""))
        away = {n: sum(min(abs(p[g] - i), langid.TOP) if g in p else langid.TOP for i, g in enumerate(own)) for n, p in profiles.items()}
        best = min(away, key=lambda n: (away[n], n)) if own and away else None
        out.append(("und", 0.0) if best is None else (best, 1 - away[best] / (len(own) * langid.TOP)))
    return out


def test_predictions_by_brute_force(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang").collect()
    learned = [(r["text"], r["lang"]) for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    want = dict(zip([r["doc_id"] for r in rows], slow_languages(learned, [r["text"] for r in rows]), strict=True))
    for r in QUERIES["op1_rank_order_language"](spark, small).collect():
        assert (r["lang_pred"], r["score"]) == (want[r["doc_id"]][0], pytest.approx(want[r["doc_id"]][1]))


def test_languages_of_odd_texts(spark, docs):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the cat and the dog " * 3, "en"), ("der hund und die katze " * 3, "de")] * 8)]
    odd = [(100, None, None, "s"), (101, "", "en", "s"), (102, "12 -- 3", "de", "s"), (103, "und die katze", None, "s"), (None, "the dog", "en", "s"), (103, "und die katze", None, "s")]
    table = docs(rows + odd)
    got = langid.identify(table, langid.fit(table, where=langid.training())).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) + len(odd) and by_id[103]["lang_pred"] == "de" and by_id[None]["lang_pred"] == "en"
    assert all(by_id[i]["lang_pred"] == langid.UNKNOWN and by_id[i]["score"] == 0 for i in (100, 101, 102))
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = langid.keep_known(table, langid.fit(table))
    assert kept.columns == table.columns and kept.count() == len(got) - 3
    none = langid.fit(table.limit(0))
    assert none.predict("the dog") == (langid.UNKNOWN, 0.0) and langid.identify(table.limit(0), none).count() == 0


def test_held_out_languages(spark, small):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").collect()}
    got = QUERIES["op1_rank_order_language"](spark, small).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in lang}
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in got if r["held_out"]]
    assert sum(held) / len(held) > 0.95


# Language-model scores


def slow_base(texts, held):
    words = {d: (t or "").encode().lower().split() for d, t in texts.items()}
    counts = Counter(w for d, ws in words.items() if not held[d] for w in ws)
    ends = sum(not h for h in held.values())
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    norm = n + 0.5 * (v + 1)
    return {d: (len(ws) + 1, sum(w in counts for w in ws) + (ends > 0), n,
                sum(math.log10((counts[w] + 0.5) / norm) for w in ws) + math.log10((ends + 0.5) / norm)) for d, ws in words.items()}


def test_base_scores(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    want = slow_base(texts, held)
    got = QUERIES["op2_brown_class_scores"](spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        tokens, known, n, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], tokens, known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / tokens), rel=1e-6)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_scores_of_odd_texts(docs):
    rows = [(0, "The cat\x0bsat  on the mat"), (1, None), (2, ""), (3, "the cat sat"), (4, "ünknown wörds " * 30), (None, "the mat"), (3, "the cat sat")]
    table = docs([*rows, *((10 + i, "the dog sat on the cat") for i in range(12))])
    for chunk in (1, 1 << 24):
        got = brown.score(table, chunk_bytes=chunk).collect()
        assert len(got) == table.count()
        by_id = {r["doc_id"]: r for r in got}
        assert by_id[1]["n_tokens"] == by_id[2]["n_tokens"] == 1 and by_id[1]["score"] == by_id[2]["score"]
        assert by_id[0]["n_tokens"] == 7 and all(r["score"] < 0 for r in got)
    assert brown.score(table.limit(0)).count() == 0
    held = docs([(d, "a b") for d in range(60) if zlib.crc32(str(d).encode()) % 5 == 1])
    assert {(r["train_tokens"], r["n_known"], r["base_score"]) for r in brown.score(held).collect()} == {(0, 0, 0.0)}


def test_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(2)
    kind = rng.integers(0, 3, 41)
    chance = np.array([[0.05, 0.9, 0.05], [0.05, 0.05, 0.9], [0.9, 0.05, 0.05]])
    bigrams = rng.poisson(30 * chance[kind][:, kind]).astype(float)

    def fit(label):
        member = np.eye(label.max() + 1)[label]
        grid = member.T @ bigrams @ member
        return brown._h(grid).sum() - brown._h(grid.sum(axis=0)).sum() - brown._h(grid.sum(axis=1)).sum()

    scores = [fit(brown.exchange(bigrams, 5, sweeps)) for sweeps in range(5)]
    assert all(b >= a - 1e-6 for a, b in zip(scores, scores[1:], strict=False)) and scores[-1] > scores[0] + 1
    label = brown.exchange(bigrams, 5)
    assert label[-1] == 0 and (label[:-1] > 0).all()


def test_probabilities_add_up(docs):
    table = docs([(10 + i, "a b c a d " * 4) for i in range(20)])
    model, words = brown.fit(brown.encode(table))
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    for k in range(1, brown.CLASSES):
        if model.class_words[k]:
            known = sum(r["c"] + 0.5 for r in words.where(f"class = {k}").collect())
            assert (known + 0.5) / (model.class_tokens[k] + 0.5 * (model.class_words[k] + 1)) == pytest.approx(1)


def test_best_class_by_brute_force():
    rng = np.random.default_rng(3)
    words, classes = 30, 5
    bigrams = rng.poisson(1.5, (words + 1, words + 1)).astype(float)
    label = np.append(rng.integers(1, classes, words), 0)

    def total(label):
        member = np.eye(classes)[label]
        return brown.likelihood(member.T @ bigrams @ member)

    member = np.eye(classes)[label]
    table = np.zeros((words, 2 * classes + 1))
    for w in range(words):
        other = np.arange(words + 1) != w
        table[w] = [*np.bincount(label[other], bigrams[other, w], classes), *np.bincount(label[other], bigrams[w, other], classes), bigrams[w, w]]
    word, code = np.nonzero(table)
    got = brown.best_classes(member.T @ bigrams @ member, label[:-1], word, code, table[word, code])
    for w in range(words):
        moves = [total(np.where(np.arange(words + 1) == w, b, label)) for b in range(1, classes)]
        assert moves[got[w] - 1] == pytest.approx(max(moves), abs=1e-9)


# Personal data


def slow_spans(x):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", x)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", x) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", x):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and sum((int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))) for i, c in enumerate(digits[::-1])) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", x) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="01259.@a-+ ()x_%é", max_size=60))
def test_base_spans_are_the_leftmost_matches(x):
    assert pii.base_spans(x) == slow_spans(x)


def test_candidates_touch_no_base_span():
    parts = ["a@b.org", "(030) 12345 67", "x [at] y.org", "+49 30 1234567", "1.2.3.4", "1[.]2[.]3[.]4", "4111/1111/1111/1111", "4111 1111 1111 1111"]
    texts = [f"{p}{gap}{q}{gap}{r}" for p in parts for q in parts for r in parts for gap in (" ", ", ", "")]
    for text in texts:
        base = pii.base_spans(text)
        alone, more = pii.candidates(text, []), pii.candidates(text, base)
        assert not any(a < y and x < b for a, _, b in more for x, _, y in base)
        assert all(p[2] <= q[0] for p, q in zip(more, more[1:], strict=False))
        want = [s for s in alone if not any(s[0] < y and x < s[2] for x, _, y in base)]
        assert set(want) <= set(more)


def test_base_spans_in_long_runs():
    for x in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 50_000, "+1 " * 50_000, "a1" * 100_000, "a1B" * 60_000 + "@", "1-" * 100_000):
        assert isinstance(pii.candidates(x, pii.base_spans(x)), list)


def test_query_finds_every_base_span(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op9_weak_supervision_pii"](spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        base = slow_spans(texts[r["doc_id"]])
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(joined.split(",")) <= set(r["spans"].split(",")) | {""}


def test_the_classifier_adds_spans_and_leaves_others(docs):
    plain = [f"user{i}@mail.example.com and +1 (555) 010-77{i:02d} from 10.0.{i}.7 card 4111 1111 1111 1111" for i in range(40)]
    model = pii.fit(docs(plain))
    assert model.reliability.shape == (5, 4, 2, 2) and np.allclose(model.reliability.sum(axis=-1), 1)
    found = "Phone: (030) 555-7713 or write to mail jo (at) example.com"
    spans = pii.all_spans(found, model)[1]
    assert {found[a:b] for a, _, b in spans} == {"(030) 555-7713", "jo (at) example.com"}
    for clean in ("in 1999 (2001) 345 pages", "version 030 4521 of 12", "meet at noon dot", "see 0302 221 page", "totals 1234 5678 90"):
        assert pii.all_spans(clean, model)[1] == []


def test_added_spans_on_planted_documents(docs):
    """Precision and recall of what the method adds, on secrets and written-out forms among look-alikes."""
    rng = np.random.default_rng(3)
    hexa = lambda n: "".join(rng.choice(list("0123456789abcdef"), n))
    mixed = lambda n: "aB3" + "".join(rng.choice(list("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789"), n))
    rows, want = [], set()
    for i in range(300):
        before, value, after = [
            ('the token = "', hexa(40), '" of'), ("API_KEY: ", f"AKIA{hexa(16).upper()}", " and"), ("password='", mixed(30), "' for"),
            ("commit ", hexa(40), " fixed it"), ("id ", "-".join(hexa(n) for n in (8, 4, 4, 4, 12)), " seen"), ("see ", f"a-long-page-title-of-{i}-words", " here"),
            ("sold ", "98" + "".join(map(str, rng.integers(0, 10, 13))), " units"), ("write to mail ", f"jo{i} (at) example.com", " now"), ("aaaaaaaaaaaaaaaaaaaaaaa", f"aa{i}aa", " long"),
            ("10.0.0.1 and jo@mail.example.com ", "", " or +1 (555) 010-7713"),
        ][i % 10]
        rows.append(before + value + after)
        if i % 10 in (0, 1, 2, 7):
            want.add((i, len(before), len(before) + len(value)))
    model = pii.fit(docs(rows))
    added = set()
    for i, text in enumerate(rows):
        base, spans = pii.all_spans(text, model)
        added |= {(i, a, b) for a, _, b in set(spans) - set(base)}
    assert added == want


def test_card_issuers_and_calling_codes():
    assert all(pii._issued(x) for x in ("4111111111111111", "5500000000000004", "2720990000000000", "340000000000009", "30000000000004", "3528000000000000"))
    assert not any(pii._issued(x) for x in ("9807915762804490", "2721000000000000", "411111111111111", "0810992847249404"))
    assert pii._called("+49 30"[1:]) and pii._called("352123") and pii._called("1555") and not pii._called("83123")


def test_odd_documents_and_masks(docs):
    table = docs([None, "", "é jo@ex.com, 1.2.3.4", (None, "no data"), (2, "é jo@ex.com, 1.2.3.4"), "x" * 100_000])
    model = pii.fit(table)
    got = {r["doc_id"]: r for r in pii.find(table, model).collect()}
    assert got[0]["spans"] == got[1]["spans"] == "" and got[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[2]["spans"] == "email:2:11,ip:13:20"
    masked = pii.mask(table, model)
    assert masked.columns == table.columns
    rows = {r["doc_id"]: r for r in masked.collect()}
    assert rows[2]["text"] == "é [EMAIL], [IP]" and rows[2]["n_chars"] == 15 and rows[0]["text"] is None
    assert pii.masked("abcdef", [(1, 0, 4), (2, 1, 5)]) == "a[EMAIL]f"
    assert pii.find(table.limit(0), pii.fit(table.limit(0))).count() == pii.mask(table.limit(0), model).count() == 0
