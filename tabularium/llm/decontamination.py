"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Tokens are runs of letters, marks and digits, lower-cased, as 64-bit hashes; in scripts without spaces
each character is one. Fixed masks look at some of
the tokens from a position on and ignore the others, so a seed still hits where a token was
substituted. Seeds of the documents are joined to those of the benchmark; each hit names an
alignment of a document and an item. Along every alignment the densest window of ``WINDOW`` tokens
(the whole item if that is shorter) is found, and the overlap counts if at least ``SIMILARITY`` of
the window's tokens agree. The masks are chosen so that every pattern of substitutions
that such a window allows leaves at least one seed intact, for windows of eight tokens and more. Shorter
items must occur whole, without a substitution; a mask without gaps finds them.

The positions of a document are unfolded and hashed within one stage of generated code, and meet
the benchmark's seeds there; only hits are shuffled. Texts are read a second time for the documents
that have hits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import stage

WINDOW = 15
SIMILARITY = 0.8
#: Token positions that a seed looks at.
MASKS = ((0, 1, 2, 3, 5), (0, 1, 4, 5, 6), (0, 1, 3, 6, 7))
#: Items with fewer tokens than this must occur token by token, found by the mask for short items.
EXACT_BELOW = 8
SHORT_MASK = (0, 1, 2, 3, 4)
#: Items with fewer tokens are not searched: any text holds such phrases by chance.
MIN_TOKENS = 5
#: A side is broadcast up to this many bytes, by count and width of its rows, else it is shuffled.
MAX_BROADCAST_BYTES = 32 << 20

# Scripts that are written without spaces.
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_TOKEN = rf"[{_UNSPACED}]\p{{M}}*+|(?:[\p{{L}}&&[^{_UNSPACED}]]|[\p{{N}}\p{{M}}])++"


def tokens(text: Column) -> Column:
    """Hashes of the tokens of a text; null gives none."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    # The same tokens; splitting is several times faster and enough where no character needs the pattern.
    plain = F.filter(F.split(lower, r"[^\p{L}\p{N}]+"), lambda w: w != "")
    rare = lower.rlike(r"[\x{300}-\x{10FFFF}]") & lower.rlike(rf"[{_UNSPACED}\p{{M}}]")
    words = F.when(rare, F.regexp_extract_all(lower, F.lit(_TOKEN), F.lit(0))).otherwise(plain)
    return F.transform(words, lambda w: F.xxhash64(w))


def _small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    return F.broadcast(df) if rows * row_bytes <= MAX_BROADCAST_BYTES else df


def _seed(at: Column, mask: Sequence[int], number: int) -> Column:
    """Hash of the masked tokens from position ``at`` of ``h``; null where the mask does not fit."""
    parts = [F.get("h", at + k) for k in mask]
    return F.when(at + mask[-1] < F.size("h"), F.xxhash64(F.lit(number), *parts))


def _seeds(df: DataFrame, masks: Sequence[Sequence[int] | None]) -> DataFrame:
    """A row for each position and mask: the columns of ``df``, ``at`` and ``seed``."""
    unfolded = df.where("size(h) > 0").select("*", F.explode(F.sequence(F.lit(0), F.size("h") - 1)).alias("at"))
    hashes = F.array(*[_seed(F.col("at"), mask, i) for i, mask in enumerate(masks) if mask])
    return unfolded.select("*", F.explode(hashes).alias("seed")).where("seed is not null")


def _matches(items: Column, shift: Column) -> Column:
    """1 or 0 for every token of the item: does the document have the same one at its place?"""
    return F.transform(items, lambda t, i: F.when(F.get("h", i + shift) == t, 1).otherwise(0))


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
    similarity: float = SIMILARITY,
    masks: Sequence[Sequence[int]] = MASKS,
    min_tokens: int = MIN_TOKENS,
) -> DataFrame:
    """One row per document and benchmark item that overlap: ``doc_id, item_id, n_window, n_equal``.

    ``n_window`` is the length of the compared window, ``n_equal`` the most tokens that agree in one
    window. Items of fewer than ``EXACT_BELOW`` tokens count where all their tokens follow each other in a document.
    Null or empty texts overlap with nothing, nor do items of fewer than ``min_tokens`` tokens. Rows without an id count as one document, so do rows of one id; the same holds for
    items. Empty tables give an empty result.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), tokens(F.col(item_text)).alias("h")).where(F.size("h") >= min_tokens)
    items = stage(items, "items")
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("h")), F.lit(0)).alias("tokens")).first()
    short = items.where(F.size("h") < EXACT_BELOW)
    own = _seeds(items.where(F.size("h") >= EXACT_BELOW), masks)
    if short.limit(1).count():
        # The mask of short items has the last number; documents get seeds of it as of the others.
        own = own.unionByName(_seeds(short, [*[None] * len(masks), SHORT_MASK]))
        masks = [*masks, SHORT_MASK]
    own = own.select("seed", "item_id", F.col("at").alias("item_at")).distinct()
    own = _small(own, size["tokens"] * len(masks), 32)

    hashed = docs.select(F.col(id_col).alias("doc_id"), tokens(F.col(text)).alias("h"))
    hits = _seeds(hashed, masks).select("doc_id", "at", "seed").join(own, "seed")
    alignments = stage(hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct(), "alignments")

    touched = alignments.select(F.col("doc_id").alias("hit_id")).distinct()
    touched = _small(touched, alignments.count(), 16)
    again = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    again = again.join(touched, again["doc_id"].eqNullSafe(touched["hit_id"]), "left_semi").select("doc_id", tokens(F.col("text")).alias("h"))
    known = _small(items.select(F.col("item_id").alias("known_id"), F.col("h").alias("item")), size["tokens"], 8)
    pairs = (
        again.join(alignments.withColumnRenamed("doc_id", "hit_id"), F.col("doc_id").eqNullSafe(F.col("hit_id")))
        .join(known, F.col("item_id").eqNullSafe(F.col("known_id")))
        .select("doc_id", "item_id", F.size("item").alias("n"), _matches(F.col("item"), F.col("shift")).alias("m"))
    )
    width = F.least(F.lit(window), F.col("n"))
    starts = F.sequence(F.lit(1), F.col("n") - width + 1)
    sums = F.transform(starts, lambda i: F.aggregate(F.slice("m", i, width), F.lit(0), lambda a, x: a + x))
    best = pairs.select("doc_id", "item_id", width.alias("n_window"), F.array_max(sums).alias("n_equal"))
    least = F.ceil(F.col("n_window") * F.lit(similarity) - F.lit(1e-9))
    enough = best.where(F.col("n_equal") >= F.when(F.col("n_window") < EXACT_BELOW, F.col("n_window")).otherwise(least))
    return enough.groupBy("doc_id", "item_id").agg(F.max("n_window").alias("n_window"), F.max("n_equal").alias("n_equal"))


def keep_clean(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of documents without an overlap, with all their columns."""
    found = stage(found.select(F.col("doc_id").alias("__leaked")).distinct(), "leaked")
    found = _small(found, found.count(), 16)
    return docs.join(found, docs[id_col].eqNullSafe(found["__leaked"]), "left_anti")
