"""Hard negatives against brute force over all pairs."""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest

from tabularium.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, row long, packed string, score double, r int"


def table(spark, rows):
    """Rows ``(vec_id, vector, label)`` with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, 1, "x", 0.5, 7) for r in rows], SCHEMA)


def brute(rows, every=50):
    def usable(r):
        return None not in r and not any(x is None or not math.isfinite(x) for x in r[1])

    def label(r):
        return int(math.fmod(r[2] + 1, 10)) if r[0] % 7 == 0 else r[2]

    kept = [(r[0], [math.floor(256 * x) for x in r[1]], label(r)) for r in rows if usable(r)]
    out = Counter()
    for a_id, a, a_label in kept:
        if a_id % every:
            continue
        found = sorted((-sum(p * q for p, q in zip(a, v, strict=False)), i, k) for i, v, k in kept)
        positives = [(i, -s) for s, i, k in found if k == a_label and i != a_id][:5]
        for p, ps in positives:
            hard = [(i, -s) for s, i, k in found if k != a_label and 50 * ps <= -100 * s <= 95 * ps][:3]
            for rank, (i, s) in enumerate(hard, 1):
                out[a_id, p, rank, i, ps, s] += 1
    return out


def mined(frame):
    return Counter(tuple(r) for r in hard_negatives.mine(frame).collect())


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, 20))
    rows = [(i, (centre[i % 4] * rng.uniform(0, 1) + rng.normal(size=20) * 0.4).tolist(), int(rng.integers(0, 4))) for i in range(600)]
    want = brute(rows)
    assert len(want) > 50
    assert mined(table(spark, rows).repartition(5)) == want


def test_awkward_rows(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), rng.integers(-3, 4, 8).astype(float).tolist(), int(rng.integers(-2, 3))) for i in range(300)]
    rows += [(1000 + i, [1.0] * 8, 1) for i in range(40)] + [(2000 + i, [0.9] * 8, 2) for i in range(40)]  # ties
    rows += [(50, [1.0] * 8, 1), (51, [0.9] * 8, 2), (51, [0.9] * 8, 2)]  # repeated ids and rows
    rows += [(350, [2.0**20, 1.0, -(2.0**24)], 1), (353, [2.0**20], 3), (356, [2.0**21], 1), (400, [], 1), (401, [], 2)]  # lengths, sizes
    rows += [(None, [1.0] * 8, 1), (450, None, 1), (500, [1.0] * 8, None), (550, [1.0, None], 1), (600, [float("nan")], 1), (650, [float("inf")], 1)]
    want = brute(rows)
    assert any(k[0] == 350 for k in want) and any(k[4] == 0 for k in want)
    assert mined(table(spark, rows).repartition(3)) == want
    assert mined(table(spark, rows).limit(0)) == Counter()
    assert mined(table(spark, [(50, [1.0], 1)])) == Counter()


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=12).round(1).tolist(), int(rng.integers(0, 3))) for i in range(500)]
    monkeypatch.setattr(hard_negatives, "CANDIDATES", 90)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    monkeypatch.setattr(hard_negatives, "_CHUNK", 16)
    assert mined(table(spark, rows)) == brute(rows)


def test_scores_are_exact_for_every_width():
    rng = np.random.default_rng(1)
    for top, width in ((1, 3), (130, 64), (40_000, 17), (1 << 27, 9)):
        x, y = rng.integers(-top, top, (50, width)), rng.integers(-top, top, (7, width))
        planes = int(hard_negatives._planes_needed(x).max())
        got = hard_negatives.scores(hard_negatives.subset_sums(y), hard_negatives.bit_planes(x, planes))
        assert (got == x @ y.T).all()
