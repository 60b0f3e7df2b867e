"""Language identification by rank-order profiles of character n-grams.

Every language gets a profile: its most frequent n-grams of one to three letters (with word
boundaries), in order of frequency. A document's own most frequent n-grams are compared to each
profile by the out-of-place distance: the sum of the differences of ranks, with the largest
difference for n-grams that the profile lacks. The nearest profile wins.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.llm.common import map_batches, remainder, text_slices

#: Length of the profiles of languages and documents.
TOP = 300
UNKNOWN = "und"
HELD_OUT = (4, 2)

_NONE = (1 << 21) - 1  # stands before shorter n-grams; no code point is that large
_WINDOW = 1 << 20
_SALTS = 32


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of one to three letters (or a word boundary) of the lower-cased text, as numbers, and their counts."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.concatenate(([0], np.where(_letters()[codes], codes, 0), [0]))
    codes = codes[(codes != 0) | np.concatenate(([True], codes[:-1] != 0))]
    keys = np.zeros(0, np.int64)
    counts = np.zeros(0, np.int64)
    for i in range(0, codes.size, _WINDOW):
        part = codes[i : i + _WINDOW + 2]
        one = part[:_WINDOW]
        two = part[: _WINDOW + 1]
        # A single boundary and n-grams across one are left out.
        grams = [
            (_NONE << 42 | _NONE << 21) + one[one != 0],
            ((_NONE << 42) + (two[:-1] << 21) + two[1:])[(two[:-1] != 0) | (two[1:] != 0)],
            ((part[:-2] << 42) + (part[1:-1] << 21) + part[2:])[part[1:-1] != 0],
        ]
        keys, counts = _merge(keys, counts, *np.unique(np.concatenate(grams), return_counts=True))
    return keys, counts


def _merge(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not a.size:
        return b, m
    keys, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    return keys, np.bincount(place, np.concatenate((n, m)), keys.size).astype(np.int64)


def ranked(keys: np.ndarray, counts: np.ndarray, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties in order of their numbers."""
    if keys.size > 4 * top:
        least = np.partition(counts, keys.size - top)[keys.size - top]
        keep = counts >= least
        keys, counts = keys[keep], counts[keep]
    return keys[np.lexsort((keys, -counts))][:top]


@dataclass(frozen=True)
class Profiles:
    """Languages in order of their names; for each the sorted n-grams of its profile and their ranks."""

    languages: tuple[str, ...]
    keys: tuple[np.ndarray, ...]
    ranks: tuple[np.ndarray, ...]
    top: int = TOP

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and ``1 - distance / largest possible distance``.

        ``und`` with score 0 if the text is null or has no letter, or no language was learned. Of
        languages at the same distance the first by name wins.
        """
        keys, counts = ngrams(text) if text else (np.zeros(0, np.int64),) * 2
        if not keys.size or not self.languages:
            return UNKNOWN, 0.0
        own = ranked(keys, counts, self.top)
        place = np.arange(own.size)
        best, name = None, UNKNOWN
        for language, known, rank in zip(self.languages, self.keys, self.ranks, strict=True):
            at = np.minimum(np.searchsorted(known, own), known.size - 1)
            gap = np.where(known[at] == own, np.minimum(np.abs(rank[at] - place), self.top), self.top)
            distance = int(gap.sum())
            if best is None or distance < best:
                best, name = distance, language
        return name, 1.0 - best / (own.size * self.top)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", where: Column | None = None, top: int = TOP) -> Profiles:
    """Profiles of every language in ``lang``, from all rows (or those ``where`` holds) with a text and a language.

    Counts are combined in each task before they move. At most ``top`` n-grams of each language
    reach the driver; the number of languages is taken to be small.
    """
    rows = docs if where is None else docs.where(where)
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        fresh: dict[str, list] = {}

        def settle(name: str) -> None:
            keys, counts = zip(*fresh.pop(name), strict=True)
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.bincount(place, np.concatenate(counts), distinct.size).astype(np.int64)
            total[name] = _merge(*total.get(name, (np.zeros(0, np.int64),) * 2), distinct, sums)

        for batch in text_slices(batches):
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                fresh.setdefault(name, []).append(ngrams(value.as_py()))
                if len(fresh[name]) >= 400:
                    settle(name)
        for name in list(fresh):
            settle(name)
        for name, (keys, counts) in total.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([name] * keys.size, pa.string()), "gram": keys, "n": counts})

    counted = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = [F.desc("n"), F.asc("gram")]
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(_SALTS)))
    near = salted.withColumn("k", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("k") <= top)
    best = near.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("k") <= top)
    found: dict[str, list[tuple[int, int]]] = {}
    for name, gram, k in best.select("lang", "gram", "k").collect():
        found.setdefault(name, []).append((gram, k - 1))
    names = tuple(sorted(found))
    tables = [np.array(sorted(found[name]), np.int64) for name in names]
    return Profiles(names, tuple(t[:, 0].copy() for t in tables), tuple(t[:, 1].copy() for t in tables), top)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row; the prediction sees nothing but the whole text.

    Repeated rows each get a row; an empty table gives an empty one.
    """
    modulus, rest = HELD_OUT

    def run(batch: pa.RecordBatch) -> dict:
        found = [profiles.predict(x.as_py()) for x in batch.column(2)]
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "lang_pred": [f[0] for f in found], "score": [f[1] for f in found]}

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (remainder(id_col, modulus) == rest).alias("held_out"), F.col(text))
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double")


def training(id_col: str = "doc_id") -> Column:
    """Rows that profiles may be learned from."""
    return remainder(id_col, HELD_OUT[0]) != HELD_OUT[1]


def keep_known(docs: DataFrame, profiles: Profiles, text: str = "text", lang: str | None = None) -> DataFrame:
    """The rows whose text gets a language, with all their columns; ``und`` rows are dropped.

    ``lang`` names a column of strings into which the predicted language is written, whatever it held. Null and
    empty texts, and those without a letter, are dropped. Repeated rows get the same verdict; an empty table gives an empty one.
    """
    at = docs.columns.index(text)
    told = None if lang is None else docs.columns.index(lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = [profiles.predict(x.as_py())[0] for x in batch.column(at)]
            if told is not None:
                field = batch.schema.field(told)
                batch = batch.set_column(told, field, pa.array(found, field.type))
            yield batch.filter(pa.array([name != UNKNOWN for name in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
