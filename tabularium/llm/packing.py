"""Packing of token sequences by exact-complement hashing.

Documents become token ids and are cut only where they are longer than the capacity. Packing needs
lengths alone, and there are at most ``capacity`` different ones, so the plan is made from the
histogram of lengths, whose size does not depend on the data:

* The largest remaining length opens a sequence. Its gap is looked up among the single lengths,
  the sums of pairs and the sums of triples that are still available; a combination that fills the
  gap exactly is consumed as many times as its availability counts allow, all at once.
* Without an exact filling the largest length that fits is placed (best fit), and the smaller gap
  is looked up again.

Each step empties at least one length, so the plan has few patterns. Pieces then get a rank within
their length (counted in two levels, so that no task holds a whole length) and find their pattern
by binary search in the plan, without any shuffle of the ids.
"""

from __future__ import annotations

import functools
import math
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.llm.common import arrow_schema, stage, text_slices

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"

#: Words that a worker remembers, in each of two generations. Forgotten words are encoded again, which costs time only.
CACHE = 300_000

# Tokenising -----------------------------------------------------------------------------------

# Characters for which the pieces of a word can be found by this expression alone; others go to the tokenizer.
_PLAIN = regex.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# ASCII characters that are neither letters nor digits: a run of them behind a word is one piece.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Python's str.split also breaks at these, the tokenizer does not.
_ODD_SPACE = regex.compile("[\x1c-\x1f]")


class WordEncoder:
    """Ids of texts by a vocabulary whose pre-tokenizer drops white space, with a cache of words and of their pieces.

    ``encode`` returns the little-endian 32-bit ids that ``Tokenizer.encode`` gives without special tokens.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Known words; when they are many they become the older generation, from which used ones come back.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # The byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.byte_map = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _run(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else "".join([self.byte_map[b] for b in piece.encode()])
        return array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()

    def _word(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if "<|" in word or not (word.isascii() or _PLAIN.fullmatch(word)):
                ids = self.whole(word)
            elif word.isalpha():
                lower = word.lower()
                ids = self._run(word) if lower == word else self.known.get(lower) or self._word(lower)
            else:
                stem = word.rstrip(_MARKS)
                if stem.isalpha() and len(stem) < len(word):
                    found = [stem, word[len(stem) :]]
                else:
                    found = _PIECES.findall(word.lower())
                ids = b"".join([self.known.get(p) or self._word(p) for p in found]) if len(found) > 1 else self._run(found[0])
        if len(word) <= 64:
            if len(self.known) >= CACHE:
                self.older, self.known = self.known, {}
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):
            return self.whole(text)
        get, word = self.known.get, self._word
        return b"".join([get(w) or word(w) for w in text.split()])


@functools.lru_cache(maxsize=1)
def encoder(vocabulary: str) -> WordEncoder:
    """One encoder in each Python worker. ``vocabulary`` is a path, or a name of the public tokenizers."""
    import os

    if not os.path.exists(vocabulary):
        import public_tokenizers

        vocabulary = public_tokenizers.path(vocabulary)
    return WordEncoder(vocabulary)


def pieces(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    capacity: int = CAPACITY,
    vocabulary: str = VOCABULARY,
    ids: bool = False,
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece, with its ``ids`` if asked for.

    A document is its ids and the end id. Only longer ones are cut, into pieces of ``capacity``
    ids; the last may be shorter. A null text counts as empty: one piece with the end id alone.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    target = arrow_schema(schema)
    end, step = np.array([END_ID], "<u4").tobytes(), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in text_slices(batches, 500):
            rows: list[tuple] = []
            for doc_id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = encode(value.as_py() or "") + end
                for k in range(0, len(data), step):
                    part = data[k : k + step]
                    row = (doc_id, k // step, k // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").astype(np.int32)) if ids else row)
            columns = zip(*rows, strict=True) if rows else [[] for _ in target]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text)).mapInArrow(run, schema)


# The plan ---------------------------------------------------------------------------------------


def _pair(free: np.ndarray, gap: int) -> tuple[int, int] | None:
    """The available pair of lengths with sum ``gap`` and the largest longer part."""
    if gap < 2:
        return None
    low = np.arange(1, gap // 2 + 1)
    fits = (free[low] > 0) & (free[gap - low] > 0)
    if gap % 2 == 0 and free[gap // 2] < 2:
        fits[-1] = False
    found = np.flatnonzero(fits)
    return (gap - int(low[found[0]]), int(low[found[0]])) if found.size else None


def _triple(free: np.ndarray, gap: int) -> tuple[int, ...] | None:
    for longest in np.flatnonzero(free[: max(0, gap - 1)])[::-1].tolist():
        if 3 * longest < gap:
            return None
        free[longest] -= 1
        rest = _pair(free, gap - longest)
        free[longest] += 1
        if rest:
            return (longest, *rest)
    return None


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """How often to build which combination of lengths: ``(times, lengths)``, using every piece exactly once."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] += n
    patterns = []
    for top in range(capacity, 0, -1):
        while left[top]:
            chosen, gap = [top], capacity - top
            free = left.copy()
            free[top] -= 1
            while gap:
                exact = (gap,) if free[gap] else _pair(free, gap) or _triple(free, gap)
                if not exact:
                    fitting = np.flatnonzero(free[1 : gap + 1])
                    if not fitting.size:
                        break
                    exact = (int(fitting[-1]) + 1,)
                for length in exact:
                    chosen.append(length)
                    free[length] -= 1
                    gap -= length
            used = {length: chosen.count(length) for length in set(chosen)}
            times = int(min(left[length] // n for length, n in used.items()))
            for length, n in used.items():
                left[length] -= times * n
            patterns.append((times, tuple(chosen)))
    return patterns


def _slots(patterns: Sequence[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Rows ``length, first rank, first sequence, repeats in a sequence, offset``, sorted by length and rank."""
    rows, taken, sequence = [], {}, 0
    for times, lengths in patterns:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            repeats = lengths.count(length)
            first = taken.get(length, 0)
            rows.append((length, first, sequence, repeats, offset))
            taken[length] = first + times * repeats
            offset += length * repeats
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


#: Ranks of a length stay below this.
_RANKS = 1 << 48


def pack(cut: DataFrame, capacity: int = CAPACITY, rows_per_task: int = 500_000) -> DataFrame:
    """The rows of ``cut`` (as from ``pieces``) with ``sequence_id`` and ``offset``; sequences hold at most ``capacity`` ids.

    Read ``cut`` from a table, not from a plan that would tokenise again: it is read twice.
    Repeated rows are packed as often as they occur. An empty table gives an empty one.
    """
    counts: dict[int, int] = {}
    groups = cut.groupBy("length").agg(F.count("*").alias("n"))  # at most ``capacity`` rows
    for length, n in groups.collect():
        counts[length] = n
    buckets = max(16, math.ceil(sum(counts.values()) / rows_per_task))
    slots = _slots(plan_patterns(counts, capacity))
    keys = slots[:, 0] * _RANKS + slots[:, 1]

    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets))
    split = cut.withColumn("__bucket", bucket)
    sizes = split.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece")
    ranked = split.withColumn("__rank", F.row_number().over(within).cast("long")).join(starts, ["length", "__bucket"])
    ranked = ranked.select(*cut.columns, (F.col("__rank") + F.col("__first") - 1).alias("__rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("__rank")
            rank = batch.column(at).to_numpy(zero_copy_only=False)
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            slot = slots[np.searchsorted(keys, length * _RANKS + rank, side="right") - 1]
            turn = rank - slot[:, 1]
            columns = [*batch.columns[:at], *batch.columns[at + 1 :], pa.array(slot[:, 2] + turn // slot[:, 3]), pa.array(slot[:, 4] + turn % slot[:, 3] * length)]
            names = [*(n for n in batch.schema.names if n != "__rank"), "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema.fields)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, text: str = "text", id_col: str = "doc_id", capacity: int = CAPACITY, vocabulary: str = VOCABULARY, ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its place, and its ids if asked for."""
    return pack(stage(pieces(docs, text, id_col, capacity, vocabulary, ids), "pieces"), capacity)
