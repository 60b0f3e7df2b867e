"""Toxic segments: the scan against its definition, scores against a plain version, held-out accuracy."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from tabularium.llm import toxicity


def brute_segments(values):
    """Maximal scoring segments by their recursive definition: the best segment (the shortest, then the first), then both sides."""
    best = None
    for i in range(len(values)):
        total = 0.0
        for j in range(i, len(values)):
            total += values[j]
            if total > 1e-12 and (best is None or (total, i - j, -i) > (best[0], best[1] - best[2] + 1, -best[1])):
                best = (total, i, j + 1)
    if best is None:
        return []
    total, i, j = best
    right = [(b + j, e + j, s) for b, e, s in brute_segments(values[j:])]
    return [*brute_segments(values[:i]), (i, j, total), *right]


@pytest.mark.parametrize("seed", range(30))
def test_all_maximal_segments_are_found(seed):
    rng = random.Random(seed)
    values = [rng.choice([-3, -1, -0.5, 0, 0, 1.25, 2.5]) for _ in range(40)]
    got = toxicity.maximal_segments([(i, v) for i, v in enumerate(values) if v], drift=0.0625)
    want = brute_segments([v - 0.0625 for v in values])
    assert [(b, e) for b, e, _ in got] == [(b, e) for b, e, _ in want]
    assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_extreme_value_parameters_solve_their_equations():
    value, count = np.array([-0.5, 1.0]), np.array([900.0, 100.0])
    decay, log_k = toxicity.extreme_value((value, count), np.array([2.0, 3.0, 0.0]), np.array([10.0, 20.0, 5.0]))
    assert math.isclose((count / 1000 * np.exp(decay * value)).sum(), 1, rel_tol=1e-9)
    assert math.isclose(log_k, np.mean([2 * decay - math.log(10), 3 * decay - math.log(20)]) - np.euler_gamma)


def _tables(spark, docs, n=1200):
    rng = random.Random(5)
    plain = [f"{a}{b}" for a in ("lo", "mi", "ra", "te") for b in ("na", "vu", "ke", "so", "dip")]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 90))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(5):
                words.insert(rng.randrange(len(words)), rng.choice(["vileword", f"grimst{rng.choice(plain)}"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic) if i % 97 else None))
    return docs(rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_documents_and_plain_scores(spark, docs):
    table, labels = _tables(spark, docs)
    model = toxicity.fit(table, labels)
    got = {r["doc_id"]: r for r in toxicity.score(table, model).collect()}
    texts = {r["doc_id"]: r["text"] for r in table.collect()}
    held = [i for i in got if got[i]["held_out"]]
    assert 150 < len(held) < 350
    assert sum(got[i]["predicted"] == (i % 6 == 0) for i in held) >= 0.97 * len(held)
    for i in list(got)[:150]:
        words = re.findall(r"[^\W\d_]+", texts[i].lower())
        odds = []
        for w in words:
            names = [w + "$", *(w[:k] for k in (7, 6, 5, 4, 3) if k <= len(w))]
            odds.append(next((model.odds[f] for f in names if f in model.odds), 0.0))
        found = brute_segments([x - model.drift for x in odds])
        shares = [model.decay * s - model.log_k - math.log(len(words)) for *_, s in found]
        x = sum(s for s in shares if s > 0)
        assert math.isclose(got[i]["score"], 1 / (1 + math.exp(-model.intercept - model.slope * x)), rel_tol=1e-9)
        assert got[i]["passages"] == [p for (b, e, _), s in zip(found, shares, strict=True) if s > 0 for p in (b, e)]


def test_counts_are_those_of_a_plain_version(spark, docs):
    table, labels = _tables(spark, docs, 60)
    rows = table.select("doc_id", "text").join(labels.na.drop(), "doc_id").select("text", "toxic")
    want = {}
    for text, toxic in rows.collect():
        words = text.split()
        for f in {"", *(f for w in words for f in toxicity.features_of(w))}:
            n = len(words) if not f else sum(f in toxicity.features_of(w) for w in words)
            entry = want.setdefault(f, [0, 0, 0, 0])
            entry[1 - toxic] += 1
            entry[3 - toxic] += n
    got = {r[0]: [r[1], r[2], r[3], r[4]] for r in toxicity.count_features(rows).collect()}
    assert got == want


def test_awkward_documents(spark, docs):
    table, labels = _tables(spark, docs, 600)
    model = toxicity.fit(table, labels.unionByName(labels).unionByName(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int")))
    odd = docs([None, "", " \n ", "123 $$", (None, "vileword " * 3), "vileword grimstlona " * 4, "vileword grimstlona " * 4, "lona mivu " * 60_000 + "vileword " * 8])
    rows = toxicity.score(odd, model).collect()
    scores = [r["score"] for r in rows]
    assert len(rows) == 8 and len(set(scores[:4])) == 1 and scores[0] < 0.5
    assert rows[4]["held_out"] and rows[4]["doc_id"] is None
    assert rows[5]["predicted"] == rows[6]["predicted"] == rows[7]["predicted"] == 1 and scores[5] == scores[6]
    assert rows[7]["passages"][-2:] == [120_000, 120_008]
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_without_labels_of_both_sorts(spark, docs):
    table = docs([f"some words {i}" for i in range(40)])
    schema = "doc_id long, toxic int"
    for labels, want in (([], 0), ([(i, 0) for i in range(40)], 0), ([(i, 1) for i in range(40)], 1)):
        model = toxicity.fit(table, spark.createDataFrame(labels, schema))
        assert {round(r["score"]) for r in toxicity.score(table, model).collect()} == {want}
    wordless = docs([""] * 40)  # one distinct text
    model = toxicity.fit(wordless, spark.createDataFrame([(i, i % 4 == 0) for i in range(40)], "doc_id long, toxic boolean"))
    assert toxicity.score(table, model).first()["score"] in (0, 1)
    few = docs(["one text", "other text"])  # of both sorts, too few to count
    model = toxicity.fit(few, spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, toxic int"))
    assert 0 <= toxicity.score(table, model).first()["score"] <= 1


def test_sample_is_bounded_and_whole_below_the_bound(spark):
    labels = spark.range(4000).selectExpr("id doc_id", "0 toxic")
    whole = toxicity._labelled(labels, "doc_id", "toxic", 10_000).count()
    assert 3000 < whole < 3400
    assert 300 < toxicity._labelled(labels, "doc_id", "toxic", 400).count() < 520


def test_near_copies_are_counted_once(spark, docs):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    texts = [" ".join([*words[:150], f"edit{chr(97 + i)}", *words[150:]]) for i in range(12)] + ["", None, "own text of few words"]
    rows = docs(texts).join(spark.range(15).selectExpr("id doc_id", "1 toxic"), "doc_id")
    kept = {r["doc_id"] for r in toxicity._distinct(rows).collect()}
    assert 0 in kept and {12, 14} <= kept and 13 not in kept and len(kept) <= 7


def test_common_word_does_not_inherit_from_a_toxic_stem(spark):
    rows = [("los", 300, 300, 900, 900), ("loser", 290, 10, 800, 10), ("loser$", 290, 10, 800, 10), ("los$", 30, 270, 100, 880), ("many$", 100, 900, 1000, 9000)]
    counts = spark.createDataFrame(rows, "feature string, toxic long, clean long, toxic_uses long, clean_uses long")
    odds = toxicity.kept_odds(counts, 0.1, (10_000, 90_000))
    assert set(odds) == {"los", "loser", "loser$", "los$"}
    assert odds["los$"] < 0.2 and odds["los"] > 2 and odds["loser"] > 5
    assert toxicity.token_odds("los", odds) < 0.2 < toxicity.token_odds("losers", odds) == odds["loser"]
