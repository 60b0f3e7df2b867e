"""SimHash near-duplicates found with vantage-point trees.

Every text becomes a 64-bit fingerprint. Equal fingerprints are one node. Linked nodes are found by
partitioning the fingerprints by Hamming distance from vantage points:

* The bits are cut into ``blocks`` blocks. Two fingerprints at ``d`` or fewer differing bits differ
  in at most ``r = d // blocks`` bits of one block at least, so one tree per block, searched at
  radius ``r`` under the Hamming distance of that block, meets every pair. The smaller radius is
  what makes the triangle bound prune: at radius 4 on 64 bits two thirds of the fingerprints
  lie within the bound of any median, at radius 1 on 21 bits one third does.
* A tree node holds a vantage point and a median distance. A fingerprint lives in one leaf, its
  home, and is sent as a query to every other leaf that the triangle bound leaves open, which are
  those across a boundary that is within ``r``.
* The leaves are the shards of the search. Inside a shard the same partitioning goes on in memory
  down to small blocks, which are compared in full on all 64 bits. A shard returns a spanning
  forest of its links, never all pairs.
* Shards that grow past their bounds (tight groups cannot be parted by distance, and the sample ends
  the trees at some depth) are cut into a grid of cells: homes are dealt out over its rows, queries over its
  columns, so each pair meets in one cell and no cell holds more than a stated number of either.

The components of the links then run over distinct fingerprints only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import join_sized, map_batches, stage
from tabularium.llm.components import components

SHINGLE = 4
MAX_DISTANCE = 4
BLOCKS = 3
#: Homes of a shard, on which the depth of the trees rests.
SHARD_ROWS = 32_768
#: A cell of the grid of a shard has about this many times ``shard_rows`` homes and queries at most: 131,072 and 524,288.
CELL_HOMES = 4
CELL_QUERIES = 16
#: Distinct fingerprints from which vantage points and medians are taken; all are indexed.
SAMPLE = 16_384

#: Ids of documents are broadcast up to this size, else shuffled.
MAX_BROADCAST_BYTES = 32 << 20
_ID_BYTES = 16
_SEED = 42
_BRUTE = 1 << 20
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased (A to Z) word shingles of a text, repeats included, as a signed 64-bit number.

    Fewer words than ``shingle`` make one shingle; no word (or null) makes fingerprint zero. A bit is 1
    if it is set in more than half of the shingles' hashes.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, _SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: -shingle] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], _SEED) for s, e in zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _HASHES_AT_ONCE):
        part = np.array(hashes[i : i + _HASHES_AT_ONCE], "<u8")
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", id_col: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (signed) of every row."""

    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0), "fp": [fingerprint(x.as_py(), shingle) for x in batch.column(1)]}

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text)), run, "doc_id long, fp long")


def hex_digits(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# Trees ------------------------------------------------------------------------------------------


def block_masks(blocks: int = BLOCKS) -> list[int]:
    """Masks that cut 64 bits into blocks of nearly equal width."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]


def _distance(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask)


def fit_tree(sample: np.ndarray, mask: int, depth: int) -> dict:
    """A vantage-point tree of ``depth`` levels; leaves are numbered from 0."""
    mask, leaves = np.uint64(mask), iter(range(1 << (depth + 1)))

    def grow(points: np.ndarray, left: int) -> dict:
        if left and points.size > 1:
            # Of a few candidates, the vantage point that spreads the distances most.
            options = points[:: max(1, points.size // 8)][:8]
            vantage = max(options, key=lambda v: float(np.var(_distance(points, v, mask))))
            d = _distance(points, vantage, mask)
            radius = int(np.median(d))
            radius = radius if (d > radius).any() else radius - 1
            near = d <= radius
            if near.any() and not near.all():
                return {"vantage": vantage, "radius": radius, "near": grow(points[near], left - 1), "far": grow(points[~near], left - 1)}
        return {"leaf": next(leaves)}

    return grow(sample, depth)


def route(points: np.ndarray, tree: dict, mask: int, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each leaf: its number, the indexes of the points that search it, and which of them live there."""
    mask = np.uint64(mask)

    def walk(node: dict, index: np.ndarray, home: np.ndarray) -> Iterator:
        if not index.size:
            return
        if "leaf" in node:
            yield node["leaf"], index, home
            return
        d = _distance(points[index], node["vantage"], mask).astype(np.int16)
        near, lives = d - reach <= node["radius"], d <= node["radius"]
        yield from walk(node["near"], index[near], (home & lives)[near])
        far = d + reach > node["radius"]
        yield from walk(node["far"], index[far], (home & ~lives)[far])

    yield from walk(tree, np.arange(points.size), np.ones(points.size, bool))


# Search inside a shard ---------------------------------------------------------------------------


def _roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    root = parent[x]
    while True:
        up = parent[root]
        if np.array_equal(up, root):
            return root
        root = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while a.size:
        ra, rb = _roots(parent, a), _roots(parent, b)
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def spanning_links(points: np.ndarray, home: np.ndarray, query: np.ndarray, mask: int, reach: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the graph of all (home, query) pairs at ``limit`` or fewer differing bits."""
    parent = np.arange(points.size)
    block, random = np.uint64(mask), np.random.default_rng(7)
    todo = [(np.flatnonzero(home), np.flatnonzero(query))]
    while todo:
        homes, queries = todo.pop()
        if homes.size * queries.size > _BRUTE:
            d = _distance(points[homes], points[homes[random.integers(homes.size)]], block).astype(np.int16)
            vantage = points[homes[int(np.argmin(d))]]
            radius = int(np.median(d))
            radius = radius if (d > radius).any() else radius - 1
            near = d <= radius
            if near.any() and not near.all():
                e = _distance(points[queries], vantage, block).astype(np.int16)
                todo.append((homes[near], queries[e - reach <= radius]))
                todo.append((homes[~near], queries[e + reach > radius]))
                continue
        step = max(1, _BRUTE // max(1, queries.size))
        for i in range(0, homes.size, step):
            part = homes[i : i + step]
            x, y = np.nonzero(np.bitwise_count(points[part][:, None] ^ points[queries][None, :]) <= limit)
            a, b = part[x], queries[y]
            other = a != b
            _unite(parent, a[other], b[other])
    root = _roots(parent, np.arange(points.size))
    moved = np.flatnonzero(root != np.arange(points.size))
    return points[moved], points[root[moved]]


# The search over all fingerprints ------------------------------------------------------------------


def deal(routed: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``shard, row, column, fp, home, query``: the rows of each shard over a grid of cells.

    Every home meets every row of its shard, as a query, in exactly one cell. Cells have about
    ``CELL_HOMES * shard_rows`` homes and ``CELL_QUERIES * shard_rows`` queries at most.
    """
    # Two numbers per shard: as many rows as there are shards, n / shard_rows for each block.
    cut = [F.greatest(F.lit(1), F.ceil(F.col(c) / F.lit(k * shard_rows))).cast("int").alias(c) for c, k in (("homes", CELL_HOMES), ("queries", CELL_QUERIES))]
    sizes = routed.groupBy("shard").agg(F.count_if("home").alias("homes"), F.count("*").alias("queries"))
    rows = routed.join(sizes.select("shard", *cut), "shard").withColumns({
        "own_row": F.pmod(F.xxhash64("fp"), F.col("homes")).cast("int"), "own_column": F.pmod(F.xxhash64("fp", F.lit(1)), F.col("queries")).cast("int"),
    })

    def cell(row: Column, column: Column, home: Column, query: Column) -> Column:
        return F.struct(row.alias("row"), column.alias("column"), home.alias("home"), query.alias("query"))

    # As a query in all cells of its column, as a home in the other cells of its row.
    asks = F.transform(
        F.sequence(F.lit(0), F.col("homes") - 1), lambda i: cell(i, F.col("own_column"), F.col("home") & (F.col("own_row") == i), F.lit(True))
    )
    others = F.filter(F.sequence(F.lit(0), F.col("queries") - 1), lambda j: F.col("home") & (j != F.col("own_column")))
    lives = F.transform(others, lambda j: cell(F.col("own_row"), j, F.lit(True), F.lit(False)))
    return rows.select("shard", "fp", F.inline(F.concat(asks, lives)))


def links(
    distinct: DataFrame,
    max_distance: int = MAX_DISTANCE,
    blocks: int = BLOCKS,
    shard_rows: int = SHARD_ROWS,
    sample: int = SAMPLE,
) -> DataFrame:
    """``a`` and ``b``: links between the distinct values of ``fp`` that span every component of the full link graph.

    All links returned join fingerprints of one component; no component of the graph of all pairs
    at ``max_distance`` or fewer bits is left in parts. An empty table gives an empty one.
    """
    n = distinct.count()
    reach, masks = max_distance // blocks, block_masks(blocks)
    depth = max(0, math.ceil(math.log2(max(1, n) / shard_rows)))
    chosen = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample if depth else 0)
    seen = np.array([r[0] for r in chosen.collect()], np.int64).view(np.uint64)
    trees = [fit_tree(seen, mask, depth) for mask in masks]
    width = 1 << (depth + 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, (tree, mask) in enumerate(zip(trees, masks, strict=True)):
                for leaf, index, home in route(points, tree, mask, reach):
                    yield pa.RecordBatch.from_pydict({
                        "shard": np.full(index.size, k * width + leaf, np.int64), "fp": points[index].view(np.int64), "home": home,
                    })

    routed = stage(distinct.select("fp").mapInArrow(send, "shard long, fp long, home boolean"), "shards")
    dealt = deal(routed, shard_rows)

    def search(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        points = frame["fp"].to_numpy(np.int64).view(np.uint64)
        a, b = spanning_links(points, frame["home"].to_numpy(bool), frame["query"].to_numpy(bool), masks[int(key[0]) // width], reach, max_distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("shard", "row", "column").applyInPandas(search, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    shingle: int = SHINGLE,
    max_distance: int = MAX_DISTANCE,
    blocks: int = BLOCKS,
    shard_rows: int = SHARD_ROWS,
    sample: int = SAMPLE,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``, one row per row of ``docs``.

    ``component_id`` is the smallest id that can be reached over links of ``max_distance`` or fewer
    differing bits, the document's own included. Null and empty texts have fingerprint zero and link
    like any other. Repeated rows each get a row. A null id gets the component of its fingerprint
    (null if no document of the component has an id). An empty table gives an empty one.
    """
    hashed = stage(fingerprints(docs, text, id_col, shingle), "fingerprints")
    distinct = stage(hashed.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "distinct")
    found = components(links(distinct, max_distance, blocks, shard_rows, sample), "a", "b")
    member = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    member = stage(member, "members")
    # A group of copies and a component may hold a large part of all rows.
    least = member.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("prints"))
    classes = join_sized(member.select("fp", "root", "copies"), least, "root", "prints", member.count())
    classes = stage(classes.select("fp", "component_id", "copies"), "classes")
    named = join_sized(hashed, classes, "fp", "copies", hashed.count())
    return named.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of one document of each class, the one with the smallest id; columns as in ``docs``.

    A document whose rows are repeated keeps one of them. Rows without an id cannot be told apart by
    it; they are left alone.

    Only ids of documents that go or have several rows are joined, so texts stay where they are read while
    these ids may be broadcast.
    """
    verdict = classes.where("doc_id is not null").groupBy(F.col("doc_id").alias("__id")).agg(
        F.min("component_id").alias("__least"), F.count("*").alias("__rows")
    )
    stays = F.col("__id") == F.col("__least")
    settled = stage(verdict.where(~stays | (F.col("__rows") > 1)).select("__id", stays.alias("__stays")), "settled")
    size = settled.agg(F.count("*").alias("ids"), F.count_if("__stays").alias("repeated")).first()
    if size["ids"] * _ID_BYTES <= MAX_BROADCAST_BYTES:
        settled = F.broadcast(settled)
    kept = docs.join(settled, docs["doc_id"] == settled["__id"], "left_anti")
    if not size["repeated"]:
        return kept
    repeated = docs.join(settled.where("__stays"), docs["doc_id"] == F.col("__id"), "left_semi")
    return kept.unionByName(repeated.dropDuplicates(["doc_id"]))
