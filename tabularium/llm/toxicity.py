"""Toxicity by maximum-scoring segments: token log-odds, every maximal passage of a text, extreme-value calibration.

*Log-odds.* Features are lower-case words and their first three to seven letters. Of each the labelled
documents that hold it are counted, and its occurrences in them. Features whose share of toxic documents
differs significantly from that of all documents are kept, so a burst in one text does not count, and those
that differ from a shorter kept one (as a common word from a toxic stem). Their log-odds are of occurrences in
toxic against clean text, under a Dirichlet prior with the mean of all text; a token has those of its longest
kept feature, less a drift that makes clean text score below zero. Of near copies one document is counted.

*Passages.* One pass over the scored tokens of a text finds all maximal scoring segments (Ruzzo and
Tompa): those no extension or cut of which scores more, and which do not overlap.

*Calibration.* In clean text the best segment of ``n`` tokens follows an extreme-value law: more than
``K n exp(-decay S)`` segments of score ``S`` are not expected. Both parameters come from clean labelled documents that
took no part in the counts. A text's evidence is the sum of ``-ln E`` over its significant segments (``E``
below 1); a logistic curve fitted on the same documents turns it into the score.

The classifier is fitted on at most about ``SAMPLE`` labelled documents, chosen by the hash of their id;
their labels are broadcast, and their texts stay where they are read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import arrow_schema, map_batches, remainder, stage, text_slices

HELD_OUT = (5, 0)
#: Remainder of the documents for calibration; those with other remainders are counted.
CALIBRATION = 4
#: Labelled documents to fit on, and features to keep, at most.
SAMPLE = 200_000
FEATURES = 50_000
#: Letters of the word beginnings that are features.
PREFIXES = range(3, 8)
#: Documents of the prior, documents a feature must occur in, and standard errors it must differ by.
PRIOR = 5.0
LEAST = 5
SIGMAS = 4.0
#: Kept features at least double or halve the odds.
EFFECT = math.log(2)
#: What every token costs, beside the mean log-odds of clean tokens if that is positive.
DRIFT = 0.02
#: Features a task counts before it hands the counts on.
_HELD = 400_000
_WORD = re.compile(r"[^\W\d_]+")
#: Ends a feature that is a whole word.
_END = "$"


def words_of(text: str | None) -> list[str]:
    """Runs of letters of a text, in lower case."""
    return _WORD.findall(text.lower()) if text else []


def features_of(word: str) -> list[str]:
    """The features of a word from the longest to the shortest."""
    return [word + _END, *(word[:k] for k in reversed(PREFIXES) if k <= len(word))]


@dataclass(frozen=True)
class Model:
    """Log-odds of the kept features, the extreme-value parameters and the logistic curve."""

    odds: dict[str, float]
    drift: float
    decay: float
    log_k: float
    slope: float
    intercept: float

    def score(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        """The chance that a text of ``n`` tokens with these segments is toxic."""
        return _logistic(self.intercept + self.slope * evidence(n, [s for _, _, s in segments], self.decay, self.log_k))


def _logistic(x: float) -> float:
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def evidence(n: int, scores: list[float], decay: float, log_k: float) -> float:
    """Sum of ``-ln E`` over the segments with fewer than one expected."""
    least = log_k + math.log(max(n, 1))
    return sum(max(0.0, decay * s - least) for s in scores)


def token_odds(word: str, odds: dict[str, float]) -> float:
    """The log-odds of the longest kept feature of a word, 0 without one."""
    for feature in features_of(word):
        found = odds.get(feature)
        if found is not None:
            return found
    return 0.0


def maximal_segments(scores: Iterator[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(begin, end, score)`` by linear scan.

    ``scores`` are ``(position, log-odds)`` of the tokens with log-odds, in order; every token costs ``drift``.
    Each segment on the stack has the sums before and after it. ``below`` links a segment to the nearest one
    that begins lower, so no segment is looked at twice.
    """
    stack: list[list] = []
    total, seen = 0.0, 0
    for at, odds in scores:
        before = total - drift * (at - seen)
        after = before + odds - drift
        total, seen = after, at + 1
        if after <= before:
            continue
        begin = at
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                break
            begin, before = stack[j][0], stack[j][2]
            del stack[j:]
            j = len(stack) - 1
        stack.append([begin, at + 1, before, after, j])
    return [(begin, end, after - before) for begin, end, before, after, _ in stack]


class _Reader:
    """Segments of texts under one model; remembers the log-odds of words it has met, up to a number."""

    def __init__(self, odds: dict[str, float], drift: float):
        self.odds, self.drift, self.known = odds, drift, {}

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        known, words = self.known, words_of(text)
        if len(known) > _HELD:
            known.clear()
        hits = []
        for at, word in enumerate(words):
            x = known.get(word)
            if x is None:
                x = known[word] = token_odds(word, self.odds)
            if x:
                hits.append((at, x))
        return len(words), maximal_segments(hits, self.drift)


# Fitting ---------------------------------------------------------------------------------------------


def _labelled(labels: DataFrame, id_col: str, label: str, sample: int) -> DataFrame:
    """One row of ``doc_id, toxic`` for each of at most about ``sample`` documents with a label outside the held-out rows."""
    modulus, rest = HELD_OUT
    rows = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    rows = rows.where("doc_id is not null and toxic is not null").where(remainder("doc_id", modulus) != rest)
    n = rows.count()
    kept = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < math.ceil((1 << 20) * min(1.0, sample / max(n, 1))))
    return kept.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def sketch(words: list[str]) -> int:
    """The smallest crc32 of a text's runs of four words; near copies mostly share it."""
    return min((zlib.crc32(" ".join(words[i : i + 4]).encode("utf-8", "surrogatepass")) for i in range(max(len(words) - 3, 1))), default=0)


def _distinct(rows: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the first of the documents with one sketch."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"), "sketch": [sketch(words_of(t.as_py())) for t in batch.column("text")]}

    sketched = map_batches(rows.select("doc_id", "text", F.col("toxic").cast("long").alias("toxic")), run, "doc_id long, toxic long, sketch long")
    first = sketched.groupBy("sketch").agg(F.min("doc_id").alias("doc_id"), F.min_by("toxic", "doc_id").alias("toxic"))
    return stage(first.select("doc_id", "toxic"), "labelled")


def count_features(docs: DataFrame) -> DataFrame:
    """``feature, toxic, clean, toxic_uses, clean_uses``: documents of each sort that hold a feature, and its
    occurrences in them. The feature ``''`` stands for all documents and tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            names = list(counts)
            for i in range(0, len(names), 50_000):
                part = names[i : i + 50_000]
                columns = zip(*(counts[f] for f in part), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(c, pa.int64()) for c in columns)], schema=target)
            counts.clear()

        for batch in text_slices(batches):
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                words = Counter(words_of(text.as_py()))
                held = Counter({"": words.total()})
                for word, n in words.items():
                    for feature in features_of(word):
                        held[feature] += n
                for feature, n in held.items():
                    entry = counts.get(feature)
                    if entry is None:
                        entry = counts[feature] = [0, 0, 0, 0]
                    entry[1 - toxic] += 1
                    entry[3 - toxic] += n
                if len(counts) > _HELD:
                    yield from out()
        yield from out()

    names = ["toxic", "clean", "toxic_uses", "clean_uses"]
    target = pa.schema([("feature", pa.string()), *((c, pa.int64()) for c in names)])
    parts = docs.select("text", "toxic").mapInArrow(run, "feature string, " + ", ".join(f"{c} long" for c in names))
    return parts.groupBy("feature").agg(*(F.sum(c).alias(c) for c in names))


def log_odds(counts: dict[str, tuple[int, int]], whole: tuple[int, int], prior: float = PRIOR) -> dict[str, float]:
    """Log-odds of the features' toxic and clean occurrences against those of ``whole`` text, under a Dirichlet prior.

    They are rounded to hundredths, so that there are few different ones.
    """
    base = whole[0] / sum(whole)
    share = {f: (toxic + prior * base) / (toxic + clean + prior) for f, (toxic, clean) in counts.items()}
    return {f: round(math.log(p / (1 - p)) - math.log(base / (1 - base)), 2) for f, p in share.items()}


def _sigmas(share: Column | float) -> Column:
    """Standard errors between the share of toxic documents of a feature and another share."""
    n = F.col("toxic") + F.col("clean")
    return (F.col("toxic") - n * share) / F.sqrt(n * share * (1 - share))


def kept_odds(counts: DataFrame, base: float, whole: tuple[int, int]) -> dict[str, float]:
    """The log-odds of the kept features; at most twice ``FEATURES``, the most significant, reach the driver."""

    def gathered(rows: DataFrame) -> dict[str, tuple[int, int, int, int]]:
        best = rows.where(F.abs("sigmas") >= SIGMAS).orderBy(F.desc(F.abs("sigmas")), "feature").limit(FEATURES)
        return {r["feature"]: (r["toxic"], r["clean"], r["toxic_uses"], r["clean_uses"]) for r in best.collect()}

    def odds_of(found: dict[str, tuple[int, int, int, int]]) -> dict[str, float]:
        return log_odds({f: x[2:] for f, x in found.items()}, whole)

    own = gathered(counts.withColumn("sigmas", _sigmas(base)))
    odds = {f: x for f, x in odds_of(own).items() if abs(x) >= EFFECT}
    shares = {f: (own[f][0] + PRIOR * base) / (own[f][0] + own[f][1] + PRIOR) for f in odds if not f.endswith(_END)}

    def run(batch: pa.RecordBatch) -> dict:
        share = []
        for feature in batch.column("feature").to_pylist():
            word = feature.removesuffix(_END)
            shorter = (word[:k] for k in reversed(PREFIXES) if k < len(feature) and k <= len(word))
            share.append(None if feature in odds else next((shares[p] for p in shorter if p in shares), None))
        return {c: batch.column(c) for c in names} | {"share": share}

    names = ["feature", "toxic", "clean", "toxic_uses", "clean_uses"]
    longer = map_batches(counts.select(*names), run, "feature string, toxic long, clean long, toxic_uses long, clean_uses long, share double")
    longer = longer.where("share is not null").withColumn("sigmas", _sigmas(F.col("share")))
    return odds | odds_of(gathered(longer))


def _clean_mean(words: DataFrame, odds: dict[str, float], tokens: int) -> float:
    """The mean log-odds of clean tokens, over the counted words."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"x": [token_odds(f.removesuffix(_END), odds) * n for f, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]}

    return (map_batches(words.select("feature", "clean_uses"), run, "x double").agg(F.sum("x")).first()[0] or 0.0) / max(tokens, 1)


def extreme_value(token_scores: tuple[np.ndarray, np.ndarray] | np.ndarray, best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """``decay`` and ``ln K`` from the scores of clean tokens (``value, count`` rows) and the best segments of clean texts.

    ``decay`` is the positive root of ``E[exp(decay s)] = 1``; ``ln K`` makes the mean of
    ``decay S - ln n`` that of the standard extreme-value law, Euler's constant.
    """
    value, count = token_scores
    if not count.sum():
        return 1.0, 0.0
    weight = count / count.sum()
    low, high = 0.0, 1.0
    while (weight * np.exp(np.minimum(700.0, high * value))).sum() < 1 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (weight * np.exp(np.minimum(700.0, middle * value))).sum() < 1 else (low, middle)
    held = best > 0
    if not held.any():
        return high, 0.0
    return high, float((high * best[held] - np.log(np.maximum(n[held], 1))).mean() - np.euler_gamma)


def logistic_curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope (not below 0) and intercept of a logistic regression on one number, lightly pulled to 0, by Newton's steps."""
    scale = max(1.0, float(np.abs(x).max(initial=0.0)))
    design = np.stack((x / scale, np.ones_like(x)), axis=1)
    w = np.array([0.0, math.log((y.sum() + 0.5) / (y.size - y.sum() + 0.5))])
    pull = np.diag([1e-3 / scale, 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -700, 700)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + pull, design.T @ (p - y) + pull @ w)
        w -= np.clip(step, -scale, scale)
        if np.abs(step).max() < 1e-10:
            break
    return max(0.0, float(w[0] / scale)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """The classifier from labelled documents whose id's crc32 does not leave 0 by 5.

    A document with several labels counts as toxic if one says so; null labels and null ids teach nothing.
    Where all labelled documents are of one sort or none has a word, every text scores the share of toxic ones, 0 without labels.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = texts.join(F.broadcast(_labelled(labels, id_col, label, sample)), "doc_id")
    distinct = _distinct(rows)
    n, n_toxic = distinct.agg(F.count("*"), F.sum("toxic")).first()
    if not n_toxic or n_toxic == n:
        return Model({}, DRIFT, 1.0, 0.0, 0.0, math.inf if n_toxic else -math.inf)
    rows = texts.join(F.broadcast(distinct), "doc_id")
    modulus = HELD_OUT[0]
    counts = stage(count_features(rows.where(remainder("doc_id", modulus) != CALIBRATION)).where(f"toxic + clean >= {LEAST} or feature = ''"), "features")
    whole = counts.where("feature = ''").first()
    if not whole or not all(whole[1:]):
        return Model({}, DRIFT, 1.0, 0.0, 0.0, math.log(n_toxic / (n - n_toxic)))
    base = whole["toxic"] / (whole["toxic"] + whole["clean"])
    odds = kept_odds(counts.where("feature <> ''"), base, (whole["toxic_uses"], whole["clean_uses"]))
    drift = DRIFT + max(0.0, _clean_mean(counts.where(F.col("feature").endswith(_END)), odds, whole["clean_uses"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, tokens = _Reader(odds, drift), Counter()
        for batch in text_slices(batches):
            found = []
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                n, segments = reader.segments(text.as_py())
                found.append((toxic, n, [s for _, _, s in segments], None, None))
                if not toxic:
                    tokens.update(reader.known[w] for w in words_of(text.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*found, strict=True), target, strict=True)], schema=target)
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((None, None, None, list(tokens), list(tokens.values())), target, strict=True)], schema=target)

    schema = "toxic long, n long, scores array<double>, value array<double>, count array<long>"
    target = arrow_schema(schema)
    held = stage(rows.where(remainder("doc_id", modulus) == CALIBRATION).select("text", "toxic").mapInArrow(run, schema), "calibration")
    return calibrate(odds, drift, held, base)


def calibrate(odds: dict[str, float], drift: float, held: DataFrame, base: float) -> Model:
    """The model from the scored calibration documents, a bounded sample: a short row of segment scores each, and from
    each task a row with the log-odds of its clean tokens (in hundredths) and their counts."""
    tokens = held.where("toxic is null").select(F.explode(F.arrays_zip("value", "count")).alias("t"))
    values = dict(tokens.groupBy("t.value").agg(F.sum("t.count")).collect())
    rows = held.where("toxic is not null").select("toxic", "n", "scores").toArrow()
    n = rows.column("n").to_numpy().astype(float)
    y = rows.column("toxic").to_numpy().astype(float)
    if not y.size or y.min() == y.max():
        return Model(odds, drift, 1.0, 0.0, 1.0, math.log(base / (1 - base)))
    scores = rows.column("scores").to_pylist()
    best = np.array([max(x, default=0.0) for x in scores])
    table = np.array([[v - drift for v in values], list(values.values())], float)
    decay, log_k = extreme_value(table, best[y == 0], n[y == 0])
    x = np.array([evidence(int(m), s, decay, log_k) for m, s in zip(n, scores, strict=True)])
    slope, intercept = logistic_curve(x, y)
    return Model(odds, drift, decay, log_k, slope, intercept)


# Scoring ---------------------------------------------------------------------------------------------


def score(docs: DataFrame, model: Model, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, score, predicted, passages, passage_scores`` of every row.

    ``passages`` are the significant segments as ``begin, end`` pairs of word numbers (end exclusive),
    ``passage_scores`` their log-odds. Null and empty texts have no word and so no evidence: they get the
    score of clean text. Null ids count as empty text when held-out rows are chosen. Repeated rows are
    scored each; an empty table gives an empty one. Other columns of ``docs`` are not read.
    """
    modulus, rest = HELD_OUT
    reader = _Reader(model.odds, model.drift)

    def run(batch: pa.RecordBatch) -> dict:
        found = [reader.segments(t.as_py()) for t in batch.column("text")]
        scores = [model.score(n, x) for n, x in found]
        strong = [[s for s in x if evidence(n, [s[2]], model.decay, model.log_k) > 0] for n, x in found]
        return {
            "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": scores, "predicted": [int(s >= 0.5) for s in scores],
            "passages": [[p for s in x for p in s[:2]] for x in strong], "passage_scores": [[s[2] for s in x] for x in strong],
        }

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (remainder(id_col, modulus) == rest).alias("held_out"), F.col(text).alias("text"))
    return map_batches(rows, run, "doc_id long, held_out boolean, score double, predicted int, passages array<long>, passage_scores array<double>")
