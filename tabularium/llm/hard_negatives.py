"""Hard negatives by exact scores with the method of the Four Russians.

Components become integers. Each candidate is indexed once as bit planes: for every eight dimensions
and every bit of their two's complement, one byte holds that bit of the eight components. For an anchor
and eight dimensions, a table of 256 entries holds the sum of every subset of the anchor's components.
A score is then one lookup for each byte, planes added up from the highest (which counts negative) by
doubling: whole inner products, without a multiplication.

Anchors are met with all candidates in blocks: candidates are dealt to blocks of at most about
``CANDIDATES`` rows by their place in the staged index, anchors to blocks of about ``ANCHORS``, and one
task scores one pair of blocks in chunks. It returns only the best few rows of each anchor, which are
merged by anchor. The first round looks for positives among rows of the anchor's label, the second for
negatives among all others, so that every pair of rows is scored at most once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.llm.common import arrow_schema, stage, text_slices

#: Rows of a block of candidates and of a block of anchors, at most about.
CANDIDATES = 65_536
ANCHORS = 4_096
#: Candidates and anchors that are scored together in one array.
_CHUNK, _LANES = 1_024, 128
#: Integer components are kept within this; scores that fit 64 bits are exact.
_LIMIT = float(1 << 62)
_GROUP = 8


# Index -----------------------------------------------------------------------------------------------


def bit_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """``planes`` times one byte for every eight dimensions, from the lowest plane up, of each integer vector."""
    n, width = vectors.shape
    groups = -(-width // _GROUP)
    padded = np.zeros((n, groups * _GROUP), np.int64)
    padded[:, :width] = vectors
    bits = (padded[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.reshape(n, planes, groups, _GROUP).astype(np.uint8), axis=3, bitorder="little")[..., 0]


def _planes_needed(vectors: np.ndarray) -> np.ndarray:
    """Bits of the two's complement of each vector's largest component."""
    most = np.where(vectors < 0, ~vectors, vectors).max(axis=1, initial=0)
    return np.array([int(m).bit_length() + 1 for m in most.tolist()], np.int64)


def index(rows: DataFrame, vector: str) -> DataFrame:
    """``row, vec_id, label, planes, packed, vector``: rows with their planes; ``vector`` holds the integers of anchors."""
    schema = "row long, vec_id long, label long, planes int, packed binary, vector binary"
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 4096):
            lists = batch.column(4).to_pylist()
            length = np.array([len(x) for x in lists])
            planes, packed, whole = np.zeros(len(lists), np.int64), [b""] * len(lists), [None] * len(lists)
            anchor = batch.column(3).to_pylist()
            for width in np.unique(length):
                at = np.flatnonzero(length == width)
                x = np.array([lists[i] for i in at], np.float64).reshape(at.size, width)
                v = np.clip(np.floor(256.0 * x), -_LIMIT, _LIMIT).astype(np.int64)
                planes[at] = _planes_needed(v)
                for p in np.unique(planes[at]):
                    some = np.flatnonzero(planes[at] == p)
                    for i, data in zip(at[some], bit_planes(v[some], p), strict=True):
                        packed[i] = data.tobytes()
                for i, row in zip(at, v, strict=True):
                    whole[i] = row.astype("<i8").tobytes() if anchor[i] else None
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip((batch.column(0), batch.column(1), batch.column(2), planes, packed, whole), target, strict=True)],
                schema=target,
            )

    return rows.select("row", "vec_id", "label", "anchor", vector).mapInArrow(run, schema)


# Scores ----------------------------------------------------------------------------------------------


def subset_sums(vectors: np.ndarray) -> np.ndarray:
    """For each eight dimensions the sum of every subset of them: groups x 256 x anchors."""
    n, width = vectors.shape
    groups = -(-width // _GROUP)
    padded = np.zeros((n, groups * _GROUP), vectors.dtype)
    padded[:, :width] = vectors
    parts = padded.reshape(n, groups, _GROUP)
    table = np.zeros((groups, 1 << _GROUP, n), vectors.dtype)
    for k in range(_GROUP):
        table[:, 1 << k : 2 << k] = table[:, : 1 << k] + parts[:, :, k].T[:, None, :]
    return table


def scores(table: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Inner products of candidates (rows x planes x groups of bytes) with the anchors of a table."""
    rows, planes, groups = packed.shape
    groups = min(groups, table.shape[0])
    total = np.zeros((rows, table.shape[2]), table.dtype)
    part, found = np.empty_like(total), np.empty_like(total)
    for plane in range(planes - 1, -1, -1):
        part[:] = 0
        for g in range(groups):
            np.take(table[g], packed[:, plane, g], axis=0, out=found, mode="clip")
            part += found
        total *= 2
        if plane == planes - 1:
            total -= part
        else:
            total += part
    return total


def _tables(anchors: pd.DataFrame) -> Iterator[tuple[slice, np.ndarray, int]]:
    """Slices of the anchors with their tables; the integer type is the narrowest that holds every score of ``planes`` bits."""
    vectors = [np.array(memoryview(x).cast("q") if x else [], "<i8") for x in anchors["vector"]]
    width = max((v.size for v in vectors), default=0)
    for begin in range(0, len(vectors), _LANES):
        part = slice(begin, min(begin + _LANES, len(vectors)))
        block = np.zeros((part.stop - begin, max(width, 1)), np.int64)
        for i, v in enumerate(vectors[part]):
            block[i, : v.size] = v
        yield part, block, int(min(np.abs(block).astype(float).sum(axis=1).max(), 2.0**62))


def _chunks(candidates: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of candidates, in order, with equally many planes and bytes, and their bytes as an array."""
    sizes = candidates["packed"].str.len().to_numpy()
    planes = candidates["planes"].to_numpy()
    for p, size in sorted(set(zip(planes.tolist(), sizes.tolist(), strict=True))):
        at = np.flatnonzero((planes == p) & (sizes == size))
        for begin in range(0, at.size, _CHUNK):
            some = at[begin : begin + _CHUNK]
            data = np.array(memoryview(b"".join(candidates["packed"].iloc[some])), np.uint8)
            yield some, data.reshape(some.size, p, size // p)


def _scored(anchors: pd.DataFrame, candidates: pd.DataFrame) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Slices of anchors, rows of candidates, and the scores of all of these with each other."""
    chunks = list(_chunks(candidates))
    for part, block, size in _tables(anchors):
        tables = {}
        for rows, packed in chunks:
            kind = np.int32 if size << packed.shape[1] < 1 << 31 else np.int64
            if kind not in tables:
                tables[kind] = subset_sums(block.astype(kind))
            yield part, rows, scores(tables[kind], packed)


def _best(score: np.ndarray, fits: np.ndarray, ids: np.ndarray, begin: int, k: int) -> pd.DataFrame:
    """The best ``k`` fitting candidates of each column: place of the anchor, id and score. Ids rise with the rows."""
    column = np.flatnonzero(fits.any(axis=0))
    fits, score = fits[:, column], score[:, column].astype(np.int64)
    if score.shape[0] > k and np.abs(score).max(initial=0) < 1 << 50:
        key = np.where(fits, score * _CHUNK + np.arange(_CHUNK - 1, _CHUNK - 1 - score.shape[0], -1)[:, None], np.iinfo(np.int64).min)
        row = np.argpartition(key, score.shape[0] - k, axis=0)[-k:]
        row, at = row.ravel(), np.tile(np.arange(column.size), k)
        row, at = row[fits[row, at]], at[fits[row, at]]
    else:
        row, at = np.nonzero(fits)
    return _first(pd.DataFrame({"at": begin + column[at], "vec_id": ids[row], "score": score[row, at]}), k)


def _first(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best ``k`` rows of each anchor."""
    return found.sort_values(["at", "score", "vec_id"], ascending=[True, False, True], kind="stable").groupby("at", sort=False).head(k)


def positives_of(anchors: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """``row, vec_id, score``: the best ``k`` of the candidates with the anchor's label but another id, for each anchor."""
    out = []
    candidates = candidates.sort_values("vec_id")
    same_label = candidates.groupby("label").indices
    for label, at in anchors.groupby("label").indices.items():
        if label not in same_label:
            continue
        same, own = candidates.iloc[same_label[label]], anchors.iloc[at]
        ids, mine, row = same["vec_id"].to_numpy(), own["vec_id"].to_numpy(), own["row"].to_numpy()
        held: dict[int, list[pd.DataFrame]] = {}
        for part, rows, score in _scored(own, same):
            fits = ids[rows][:, None] != mine[part][None, :]
            held.setdefault(part.start, []).append(_best(score, fits, ids[rows], part.start, k))
        for parts in held.values():
            best = _first(pd.concat(parts), k)
            out.append(pd.DataFrame({"row": row[best["at"]], "vec_id": best["vec_id"].to_numpy(), "score": best["score"].to_numpy()}))
    return pd.concat(out) if out else pd.DataFrame({"row": [], "vec_id": [], "score": []}, dtype=np.int64)


def negatives_of(anchors: pd.DataFrame, candidates: pd.DataFrame, k: int, least: int, most: int) -> pd.DataFrame:
    """``row, positive_score, vec_id, score``: the best ``k`` of the candidates with another label whose score is between
    ``least`` and ``most`` hundredths of a positive's, for each anchor and each of its different positive scores."""
    candidates = candidates.sort_values("vec_id")
    ids, labels = candidates["vec_id"].to_numpy(), candidates["label"].to_numpy()
    mine, own = anchors["label"].to_numpy(), anchors["row"].to_numpy()
    wanted = [sorted(set(x), reverse=True) for x in anchors["positive_scores"]]
    slots = max((len(x) for x in wanted), default=0)
    # Bounds are worked out in Python's integers; where the upper is below the lower (negative positives) nothing fits.
    low = np.array([[-(-least * p // 100) for p in x] + [1] * (slots - len(x)) for x in wanted], object).reshape(len(wanted), slots)
    high = np.array([[most * p // 100 for p in x] + [0] * (slots - len(x)) for x in wanted], object).reshape(len(wanted), slots)
    low, high = low.astype(np.int64), high.astype(np.int64)
    held: dict[tuple[int, int], pd.DataFrame] = {}
    for part, rows, score in _scored(anchors, candidates):
        other = labels[rows][:, None] != mine[part][None, :]
        for slot in range(slots):
            bottom = low[part, slot].copy()
            before = held.get((part.start, slot))
            if before is not None:  # nothing below the worst of an anchor's best k can be among them
                full = before.groupby("at")["score"].agg(["size", "min"])
                full = full[full["size"] == k]
                at = full.index.to_numpy() - part.start
                bottom[at] = np.maximum(bottom[at], full["min"].to_numpy())
            fits = (score >= bottom[None, :]) & (score <= high[part, slot][None, :]) & other
            if fits.any():
                best = _best(score, fits, ids[rows], part.start, k)
                held[part.start, slot] = best if before is None else _first(pd.concat([before, best]), k)
    out = [
        pd.DataFrame({
            "row": own[best["at"]], "positive_score": [wanted[a][slot] for a in best["at"]],
            "vec_id": best["vec_id"].to_numpy(), "score": best["score"].to_numpy(),
        })
        for (_, slot), best in held.items()
    ]
    columns = ["row", "positive_score", "vec_id", "score"]
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in columns}, dtype=np.int64)


# Jobs ------------------------------------------------------------------------------------------------


def _cells(df: DataFrame, own: str, other: str, blocks: int) -> DataFrame:
    """The rows once for each block of the other side; ``own`` is the column of their own block."""
    return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))


def _top(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` rows of each group; Spark cuts groups down before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    embeddings: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str | Column | None = None,
    anchors_every: int = 50, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``label`` is an integer column; the default is ``label``, moved to ``(label + 1) % 10`` where the id is
    divisible by 7. Anchors are the rows whose id is divisible by ``anchors_every``. Of rows with the anchor's label
    the best ``positives`` are taken; for each, the best ``negatives`` rows with another label whose score is at least
    ``least`` and at most ``most`` hundredths of the positive's (none if that is negative). Ties go by smaller id.

    Rows with a null id, label or vector, or with a null or non-finite component take no part. Vectors of
    different length are filled up with zeros. A row with the anchor's id is the anchor itself and never its
    positive. Other repeated rows count each, and so do repeated anchors; copies of a result row are then
    returned as often. Components are kept within 62 bits; scores must fit 64. An empty table gives an empty one.
    """
    if label is None:
        label = F.when(F.col(id_col) % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    label = F.col(label) if isinstance(label, str) else label
    rows = embeddings.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        (F.col(id_col) % anchors_every == 0).alias("anchor"), F.col(vector).cast("array<double>").alias("vector"),
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.where("vec_id is not null and label is not null and vector is not null").where(~odd)
    indexed = stage(index(rows, "vector"), "planes")
    n, n_anchors = indexed.agg(F.count("*"), F.count("vector")).first()
    tasks = 4 * embeddings.sparkSession.sparkContext.defaultParallelism
    blocks, lanes = -(-n // CANDIDATES), -(-n_anchors // ANCHORS)
    blocks = max(blocks, min(tasks // max(lanes, 1), n // _CHUNK), 1)
    lanes = max(lanes, 1)

    def block(name: str, salt: int, number: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(number)).cast("int").alias(name)

    candidates = indexed.select(block("r", 1, blocks), *(F.col(c).alias(c) for c in ("vec_id", "label", "planes", "packed")))
    anchors = indexed.where("vector is not null").select(block("s", 2, lanes), "row", "vec_id", "label", "vector")

    def met(left: DataFrame, function, schema: str) -> DataFrame:
        sides = _cells(left, "s", "r", blocks).groupBy("r", "s"), _cells(candidates, "r", "s", lanes).groupBy("r", "s")
        return sides[0].cogroup(sides[1]).applyInPandas(function, schema)

    found = met(anchors, lambda a, c: positives_of(a, c, positives), "row long, vec_id long, score long")
    best = stage(_top(found, ["row"], positives).select("row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    wanted = best.groupBy("row").agg(F.collect_set("positive_score").alias("positive_scores"))
    found = met(anchors.join(wanted, "row"), lambda a, c: negatives_of(a, c, negatives, least, most), "row long, positive_score long, vec_id long, score long")
    hard = _top(found, ["row", "positive_score"], negatives)
    named = best.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.join(hard, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
