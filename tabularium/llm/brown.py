"""Language-model scores by Brown class-based bigrams.

Every word belongs to a class. A text's probability is the product of class transitions and of word
emissions within classes. The classes come from exchange clustering: words are moved between
classes, always to the class that raises the likelihood of the class bigrams most.

The start is made on the driver: the most frequent words and the hashed endings of all others are units
of a table of fixed size, which are moved one at a time. From there every training word is moved by its
own neighbours, in distributed sweeps: the chunks of the corpus count which classes stand before and
after each word, buckets of words add these counts up and choose each word's best class against the
class bigrams of all text, and the chunks get the new classes back. A sweep moves the words in parts,
so that words do not all chase each other; a part that lowers the likelihood is taken back, and the next
sweep has twice as many parts. Sweeps go on until one gains no more than ``TOLERANCE``. Only a word
that training never saw has the class of its ending.

Texts are read and encoded once, in chunks with a local dictionary each. What is shuffled are places and counts
per distinct word of a chunk, and the line of its training words (one compressed row) to meet them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm.common import arrow_schema, remainder, stage, text_slices
from tabularium.session import remove_path

#: For the start: frequent words that are units of their own, and units for all other words. Then the classes.
TOP = 768
ENDINGS = 255
CLASSES = 48
SWEEPS = 6
HELD_OUT = (5, 1)
#: UTF-8 bytes of the words that share a dictionary.
CHUNK_BYTES = 16 << 20
#: Entries of chunk dictionaries that share a bucket.
BUCKET_ENTRIES = 200_000
#: Sweeps end with one that raises the likelihood by less than this, in nats a token.
TOLERANCE = 1e-2

_BOUNDARY = TOP + ENDINGS
UNITS = _BOUNDARY + 1
#: Weight of the class frequencies in the smoothed transitions.
_PRIOR = 10.0


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A to Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def ending_unit(word: bytes) -> int:
    """The unit of a word that is not among the frequent ones."""
    return TOP + zlib.crc32(word[-3:]) % ENDINGS


# Counting ------------------------------------------------------------------------------------------


def encode(docs: DataFrame, text: str = "text", id_col: str = "doc_id", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Rows of two sorts: the documents of a slice of a chunk, and ``chunk, words, counts, line`` of a whole chunk.

    ``ids`` are the places of the documents' words in the chunk's dictionary ``words`` (32 bit, little-endian, zstd),
    ``lengths`` the words of each document, ``flags`` 1 for a held-out document plus 2 for a null id. ``line`` has the
    places of all training documents in a row, with -1 before, between and after them, and ``counts`` how often
    each word occurs there; ``n_train`` is the number of training documents. A chunk ends with the text that fills it,
    so it has less than ``chunk_bytes`` and one text.
    """
    schema = "chunk long, n_train long, doc_ids binary, flags binary, lengths binary, ids binary, words array<string>, counts array<long>, line binary"
    target = arrow_schema(schema)

    def batch_of(row: tuple) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, target, strict=True)], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, local = TaskContext.get().partitionId() << 24, 0, {}
        line, rows = [np.array([-1], "<i4")], []
        for batch in text_slices(batches):
            for doc_id, held, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = words_of(value.as_py())
                ids = np.array([local.setdefault(w, len(local)) for w in words], "<i4")
                size += sum(map(len, words)) + len(words)
                rows.append((doc_id or 0, held + 2 * (doc_id is None), ids))
                if not held:
                    line += [ids, np.array([-1], "<i4")]
                if size >= chunk_bytes:
                    yield documents(chunk, rows)
                    yield dictionary(chunk, local, line)
                    chunk, size, local = chunk + 1, 0, {}
                    line, rows = [np.array([-1], "<i4")], []
            if rows:
                yield documents(chunk, rows)
                rows = []
        if local:
            yield dictionary(chunk, local, line)

    def documents(chunk: int, rows: list[tuple]) -> pa.RecordBatch:
        doc_ids, flags, lines = zip(*rows, strict=True)
        lengths = np.array([x.size for x in lines], "<i8")
        ids = pa.compress(np.concatenate(lines).tobytes(), "zstd", asbytes=True)
        n_train = sum(not f & 1 for f in flags)
        return batch_of((chunk, n_train, np.array(doc_ids, "<i8").tobytes(), np.array(flags, np.uint8).tobytes(), lengths.tobytes(), ids, None, None, None))

    def dictionary(chunk: int, local: dict[bytes, int], line: list[np.ndarray]) -> pa.RecordBatch:
        whole = np.concatenate(line)
        counts = np.bincount(whole[whole >= 0], minlength=len(local)).astype(np.int64)
        words = [w.decode("utf-8", "replace") for w in local]
        return batch_of((chunk, None, None, None, None, None, words, counts, pa.compress(whole.tobytes(), "zstd", asbytes=True)))

    modulus, rest = HELD_OUT
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (remainder(id_col, modulus) == rest).alias("held_out"), F.col(text))
    return rows.mapInArrow(run, schema)


def _line(data: bytes) -> np.ndarray:
    """The places of a chunk's training documents."""
    return np.frombuffer(pa.input_stream(pa.BufferReader(data), compression="zstd").read(), "<i4")


def _documents(slices: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, flags, ends and words of the documents of each slice."""
    for doc_ids, flags, lengths, data in zip(slices["doc_ids"], slices["flags"], slices["lengths"], slices["ids"], strict=True):
        ends = np.cumsum(np.frombuffer(lengths, "<i8"))
        ids = np.frombuffer(pa.decompress(data, int(ends[-1]) * 4, "zstd", asbytes=True), "<i4") if ends[-1] else np.zeros(0, "<i4")
        yield np.frombuffer(doc_ids, "<i8"), np.frombuffer(flags, np.uint8), ends, ids


def unit_bigrams(coded: DataFrame, units: dict[bytes, int]) -> np.ndarray:
    """Counts of neighbouring units in the training documents, with the boundary before and after each; a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, known = np.zeros(UNITS * UNITS, np.int64), units.get
        for batch in batches:
            for words, line in zip(batch.column(0), batch.column(1), strict=True):
                own = [w.encode("utf-8", "surrogatepass") for w in words.as_py()]
                unit = np.array([ending_unit(w) if (u := known(w)) is None else u for w in own] + [_BOUNDARY], np.int64)
                code = unit[_line(line.as_py())]
                total += np.bincount(code[:-1] * UNITS + code[1:], minlength=UNITS * UNITS)
        found = np.flatnonzero(total)
        for i in range(0, found.size, 100_000):
            part = found[i : i + 100_000]
            yield pa.RecordBatch.from_pydict({"pair": part, "n": total[part]})

    rows = coded.where("words is not null").select("words", "line")
    pairs = rows.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(UNITS * UNITS)
    table[pairs.column("pair").to_numpy()] = pairs.column("n").to_numpy()
    return table.reshape(UNITS, UNITS)


# Clustering ----------------------------------------------------------------------------------------


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each unit. Units are visited by frequency until a sweep moves none; the last unit, the boundary, stays alone in class 0."""
    units = bigrams.shape[0]
    order = np.argsort(-bigrams.sum(axis=1)[:-1], kind="stable")
    label = np.zeros(units, np.int64)
    label[order] = 1 + np.arange(units - 1) % (classes - 1)
    member = np.zeros((units, classes))
    member[np.arange(units), label] = 1
    grid = member.T @ bigrams @ member
    for _ in range(sweeps):
        moved = 0
        for w in order[bigrams.sum(axis=1)[order] > 0].tolist():
            a, own = int(label[w]), bigrams[w, w]
            after = np.bincount(label, bigrams[w], classes)
            before = np.bincount(label, bigrams[:, w], classes)
            grid[a] -= after
            grid[:, a] -= before
            grid[a, a] += own
            after[a] -= own
            before[a] -= own
            held = _h(grid)
            out, into = _h(grid + after[None, :]) - held, _h(grid + before[:, None]) - held
            diagonal = np.diagonal(grid)
            gain = out.sum(axis=1) - np.diagonal(out) + into.sum(axis=0) - np.diagonal(into)
            gain += _h(diagonal + after + before + own) - _h(diagonal)
            rows, columns = grid.sum(axis=1), grid.sum(axis=0)
            gain -= _h(rows + after.sum() + own) - _h(rows) + _h(columns + before.sum() + own) - _h(columns)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            b = a if gain[b] <= gain[a] + 1e-9 else b
            grid[b] += after
            grid[:, b] += before
            grid[b, b] += own
            label[w] = b
            moved += a != b
        if not moved:
            break
    return label


# Distributed sweeps ----------------------------------------------------------------------------------

#: The entries of one chunk's dictionary whose words are in one bucket; ``word`` is the number of the word in the bucket.
_PLACED = "bucket int, chunk long, place binary, word binary, class binary"
#: What a word's neighbours count: ``n_codes`` pairs of ``code, n`` an entry. A code is the class before, CLASSES + the
#: class after, or 2 * CLASSES for the word itself. Rows without a bucket hold the class bigrams of a chunk in ``grid``.
_COUNTED = _PLACED + ", n_codes binary, code binary, n binary, grid array<long>"


def _joined(parts: pd.Series, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype)


def _members(coded: DataFrame) -> DataFrame:
    """The dictionaries dealt to buckets of words: placed entries (without class), and a row without chunk with the words and counts of a bucket."""
    entries = coded.where("words is not null").agg(F.sum(F.size("words"))).first()[0] or 0
    buckets = 64 + entries // BUCKET_ENTRIES

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["chunk", "place"])
        number, words = pd.factorize(rows["word"])
        number, place, chunk = number.astype("<i4"), rows["place"].to_numpy("<i4"), rows["chunk"].to_numpy()
        bucket = int(rows["bucket"].iloc[0])
        counts = np.bincount(number, rows["n"], len(words)).astype(np.int64)
        out = [(bucket, None, None, None, list(words), counts)]
        begin = np.flatnonzero(np.diff(chunk, prepend=chunk[0] - 1))
        for b, e in zip(begin, [*begin[1:], chunk.size], strict=True):
            out.append((bucket, int(chunk[b]), place[b:e].tobytes(), number[b:e].tobytes(), None, None))
        return pd.DataFrame(out, columns=["bucket", "chunk", "place", "word", "words", "counts"]).astype({"chunk": "Int64"})

    rows = coded.where("words is not null").select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "entry"))
    rows = rows.select("chunk", "place", F.col("entry.words").alias("word"), F.col("entry.counts").alias("n"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(buckets)).cast("int"))
    return rows.groupBy("bucket").applyInPandas(run, "bucket int, chunk long, place binary, word binary, words array<string>, counts array<long>")


def _start(members: DataFrame, units: dict[bytes, int], label: np.ndarray) -> DataFrame:
    """The placed entries with the classes of the words' units."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        words = [w.encode("utf-8", "surrogatepass") for w in rows.loc[rows["chunk"].isna(), "words"].iloc[0]]
        classes = label[[units[w] if w in units else ending_unit(w) for w in words]].astype("<u2")
        rows = rows[rows["chunk"].notna()]
        return rows[["bucket", "chunk", "place", "word"]].assign(**{"class": [classes[np.frombuffer(w, "<i4")].tobytes() for w in rows["word"]]})

    return members.groupBy("bucket").applyInPandas(run, _PLACED)


def neighbour_counts(coded: DataFrame, placed: DataFrame, classes: int, part: int = 0, parts: int = 1) -> DataFrame:
    """The classes before and after one part of the words in each chunk's training documents, and the class bigrams of all of them."""
    codes = 2 * classes + 1

    def run(lines: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        place = _joined(rows["place"], "<i4")
        label = np.zeros(place.size + 1, np.uint8 if classes <= 256 else np.uint16)
        label[place] = _joined(rows["class"], "<u2")
        rank = np.full(place.size + 1, place.size, np.uint32 if (place.size + 1) * codes < 1 << 32 else np.int64)
        rank[place] = np.arange(place.size, dtype=rank.dtype)
        wanted = np.zeros(place.size + 1, bool)
        wanted[place] = _joined(rows["word"], "<i4") % parts == part
        line = _line(lines["line"].iloc[0])  # -1 is the boundary, the last entry of each table
        kind, mine = label[line], wanted[line]
        grid = np.bincount(kind[:-1].astype(np.int64) * classes + kind[1:], minlength=classes * classes)
        own = line[:-1] == line[1:]
        after, before, own = np.flatnonzero(mine[:-1] & ~own), np.flatnonzero(mine[1:] & ~own), np.flatnonzero(mine[:-1] & own)
        key = np.concatenate((
            rank[line[1:][before]] * codes + kind[:-1][before], rank[line[:-1][after]] * codes + classes + kind[1:][after],
            rank[line[:-1][own]] * codes + 2 * classes,
        ))
        key, n = np.unique(key, return_counts=True)
        entry, code, n = key // codes, (key % codes).astype("<u2"), n.astype("<i4")
        n_codes = np.bincount(entry.astype(np.int64), minlength=place.size).astype("<u2")
        sizes = np.array([len(p) // 4 for p in rows["place"]], np.int64)
        ends = np.cumsum(sizes)
        stops = np.searchsorted(entry, ends)
        out = rows[["bucket", "chunk", "place", "word", "class"]].assign(
            n_codes=[n_codes[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)],
            code=[code[b:e].tobytes() for b, e in zip([0, *stops[:-1]], stops, strict=True)],
            n=[n[b:e].tobytes() for b, e in zip([0, *stops[:-1]], stops, strict=True)],
            grid=None,
        )
        last = pd.DataFrame([(None, None, None, None, None, None, None, None, grid)], columns=out.columns)
        return pd.concat([out.astype({"bucket": "Int64", "chunk": "Int64"}), last.astype({"bucket": "Int64", "chunk": "Int64"})])

    lines = coded.where("words is not null").select(F.col("chunk").alias("part"), "line")
    return lines.groupBy("part").cogroup(placed.groupBy("chunk")).applyInPandas(run, _COUNTED)


def best_classes(grid: np.ndarray, label: np.ndarray, word: np.ndarray, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The class of each word that raises the likelihood of the class bigrams most if it alone moves.

    ``label`` has the words' classes; ``word, code, n`` are their counts, sorted by word and without repeats.
    """
    classes = grid.shape[0]
    best = label.copy()
    rows, columns = grid.sum(axis=1), grid.sum(axis=0)
    whole_held = _h(grid)
    held = np.diagonal(whole_held)
    seen = np.flatnonzero(np.bincount(word, minlength=label.size))
    for first in range(0, seen.size, 2048):
        chosen = seen[first : first + 2048]
        at, m = slice(*np.searchsorted(word, [chosen[0], chosen[-1] + 1])), chosen.size
        w, k, x = np.searchsorted(chosen, word[at]), code[at], n[at].astype(float)
        table = np.zeros((m, 2 * classes + 1))
        table[w, k] = x
        before, after, own = table[:, :classes], table[:, classes:-1], table[:, -1]
        a, every = label[chosen], np.arange(m)
        gain = np.zeros((m, classes))
        for side, other, toward in ((after, before, True), (before, after, False)):
            e = (k >= classes) & (k < 2 * classes) if toward else k < classes
            v, j, c = w[e], k[e] - classes * toward, x[e]
            cells, old = (grid.T if toward else grid)[j], (whole_held.T if toward else whole_held)[j]
            home = a[v]
            back, row = j == home, np.arange(v.size)
            cells[back] -= other[v[back]]
            cells[row, home] -= c + back * own[v]
            old[back], old[row, home] = _h(cells[back]), _h(cells[row, home])
            terms = _h(cells + c[:, None]) - old
            terms[np.arange(v.size), j] = 0
            some, begin = np.unique(v, return_index=True)
            gain[some] += np.add.reduceat(terms, begin, axis=0) if v.size else 0
        whole = after + before + own[:, None]
        diagonal = np.repeat(np.diagonal(grid)[None, :], m, axis=0)
        old = np.repeat(held[None, :], m, axis=0)
        diagonal[every, a] -= whole[every, a]
        old[every, a] = _h(diagonal[every, a])
        gain += _h(diagonal + whole) - old
        for margin, tokens in ((rows, after.sum(axis=1) + own), (columns, before.sum(axis=1) + own)):
            sums = np.repeat(margin[None, :], m, axis=0)
            sums[every, a] -= tokens
            gain -= _h(sums + tokens[:, None]) - _h(sums)
        gain[:, 0] = -np.inf
        b = gain.argmax(axis=1)
        best[chosen] = np.where(gain[every, b] > gain[every, a] + 1e-9, b, a)
    return best


def _moved(counted: DataFrame, grid: np.ndarray, part: int, parts: int) -> DataFrame:
    """The placed entries with the best classes of one part of the words, of all others the old ones."""
    classes = grid.shape[0]
    codes = 2 * classes + 1

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        number, old = _joined(rows["word"], "<i4"), _joined(rows["class"], "<u2").astype(np.int64)
        label = np.zeros(number.max() + 1, np.int64)
        label[number] = old
        key = np.repeat(number.astype(np.int64), _joined(rows["n_codes"], "<u2")) * codes + _joined(rows["code"], "<u2")
        mine = key // codes % parts == part
        key, place = np.unique(key[mine], return_inverse=True)
        n = np.bincount(place, _joined(rows["n"], "<i4")[mine], key.size)
        best = best_classes(grid, label, key // codes, key % codes, n).astype("<u2")
        return rows[["bucket", "chunk", "place", "word"]].assign(**{"class": [best[np.frombuffer(w, "<i4")].tobytes() for w in rows["word"]]})

    return counted.where("bucket is not null").drop("grid").groupBy("bucket").applyInPandas(run, _PLACED)


def likelihood(grid: np.ndarray) -> float:
    """Log likelihood of the class bigrams, up to what does not depend on the classes."""
    return float(_h(grid).sum() - _h(grid.sum(axis=0)).sum() - _h(grid.sum(axis=1)).sum())


def _forget(spark: SparkSession) -> None:
    """Let the driver's collector find past jobs unused: Spark then deletes their shuffle files on all executors."""
    spark.sparkContext._jvm.System.gc()


def sweep(coded: DataFrame, placed: DataFrame, classes: int) -> tuple[DataFrame, np.ndarray]:
    """The placed entries with the classes after the last sweep, and the class bigrams under them."""

    spark = coded.sparkSession

    def count(entries: DataFrame, part: int, parts: int) -> tuple[DataFrame, np.ndarray]:
        counted = stage(neighbour_counts(coded, entries, classes, part, parts), "neighbours")
        grid = np.zeros(classes * classes)
        cells = counted.where("bucket is null").select(F.posexplode("grid").alias("cell", "n")).groupBy("cell").agg(F.sum("n"))
        for cell, n in cells.collect():
            grid[cell] = n
        _forget(spark)
        return counted, grid.reshape(classes, classes)

    def drop(counted: DataFrame) -> None:
        for folder in {f.rpartition("/")[0] for f in counted.inputFiles()}:
            remove_path(spark, folder)

    def placed_of(counted: DataFrame) -> DataFrame:
        return counted.where("bucket is not null").select("bucket", "chunk", "place", "word", "class")

    parts, gain = 2, np.inf
    counted, grid = count(placed, 0, parts)
    while gain > TOLERANCE * grid.sum():
        gain, fell = 0.0, False
        for part in range(parts):
            following = (part + 1) % parts
            new, new_grid = count(_moved(counted, grid, part, parts), following, parts)
            more = likelihood(new_grid) - likelihood(grid)
            if more < 0:
                fell = True
                drop(new)
                new, new_grid, more = *count(placed_of(counted), following, parts), 0.0
            drop(counted)
            counted, grid, gain = new, new_grid, gain + more
        # Part 0 of twice as many parts lies within the part 0 that was counted.
        parts *= 1 + fell
    return placed_of(counted), grid


def _final(members: DataFrame, placed: DataFrame, unit_class: np.ndarray) -> DataFrame:
    """``chunk, place, class, c`` of placed entries, and rows without chunk with ``words, counts, classes`` of the training words."""

    def run(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        first = own.iloc[0]
        counts, words = np.asarray(first["counts"], np.int64), list(first["words"])
        label = np.zeros(counts.size, np.int64)
        label[_joined(rows["word"], "<i4")] = _joined(rows["class"], "<u2")
        for i in np.flatnonzero(counts == 0):
            label[i] = unit_class[ending_unit(words[i].encode("utf-8", "surrogatepass"))]
        known = np.flatnonzero(counts)
        out = [(None, None, None, None, [words[i] for i in known], counts[known], label[known])]
        for chunk, place, word in zip(rows["chunk"], rows["place"], rows["word"], strict=True):
            i = np.frombuffer(word, "<i4")
            out.append((chunk, place, label[i].astype("<u2").tobytes(), counts[i].astype("<i8").tobytes(), None, None, None))
        return pd.DataFrame(out, columns=["chunk", "place", "class", "c", "words", "counts", "classes"]).astype({"chunk": "Int64"})

    schema = "chunk long, place binary, class binary, c binary, words array<string>, counts array<long>, classes array<long>"
    return members.where("chunk is null").groupBy("bucket").cogroup(placed.groupBy("bucket")).applyInPandas(run, schema)


@dataclass(frozen=True)
class Model:
    """Units and classes, log10 transitions between classes, and the sizes of the emission tables."""

    units: dict[bytes, int]
    label: np.ndarray
    transitions: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    distinct: int
    documents: int


def _transitions(grid: np.ndarray) -> np.ndarray:
    share = (grid.sum(axis=0) + 0.5) / (grid.sum() + 0.5 * grid.shape[0])
    return np.log10((grid + _PRIOR * share[None, :]) / (grid.sum(axis=1, keepdims=True) + _PRIOR))


# Fitting and scoring ---------------------------------------------------------------------------------


def _fit(coded: DataFrame, classes: int, sweeps: int) -> tuple[Model, DataFrame]:
    members = stage(_members(coded), "members")
    _forget(coded.sparkSession)
    vocabulary = members.where("chunk is null").select(F.explode(F.arrays_zip("words", "counts")).alias("w")).where("w.counts > 0")
    top = vocabulary.select(F.col("w.words").alias("word"), F.col("w.counts").alias("c")).orderBy(F.desc("c"), "word").limit(TOP).collect()
    units = {r["word"].encode("utf-8", "surrogatepass"): i for i, r in enumerate(top)}
    bigrams = unit_bigrams(coded, units)
    _forget(coded.sparkSession)
    label = exchange(bigrams, classes, sweeps)
    placed, grid = sweep(coded, _start(members, units, label), classes)
    final = stage(_final(members, placed, label), "classes")
    class_tokens, class_words = np.zeros(classes), np.zeros(classes)
    for k, tokens, words in _words(final).groupBy("class").agg(F.sum("c"), F.count("*")).collect():
        class_tokens[k], class_words[k] = tokens, words
    documents = coded.agg(F.sum("n_train")).first()[0] or 0
    model = Model(
        units, label, _transitions(grid), class_tokens, class_words,
        int(class_tokens.sum()) + documents, int(class_words.sum()) + (documents > 0), documents,
    )
    return model, final


def _words(final: DataFrame) -> DataFrame:
    rows = final.where("words is not null").select(F.explode(F.arrays_zip("words", "counts", "classes")).alias("w"))
    return rows.select(F.col("w.words").alias("word"), F.col("w.counts").alias("c"), F.col("w.classes").cast("int").alias("class"))


def fit(coded: DataFrame, classes: int = CLASSES, sweeps: int = SWEEPS) -> tuple[Model, DataFrame]:
    """The model and the table ``word, c, class`` of all words of the training documents (``coded`` is from ``encode``).

    ``sweeps`` bounds those of the start on the driver; the distributed ones go on until they gain no more.
    """
    model, final = _fit(coded, classes, sweeps)
    return model, _words(final)


def score(docs: DataFrame, text: str = "text", id_col: str = "doc_id", classes: int = CLASSES, sweeps: int = SWEEPS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every row.

    ``score`` is the log10 probability of the text and its end; ``perplexity`` is per token. Held-out rows
    teach nothing. A null text counts as empty: one token, its end. A null id counts as empty text when
    the held-out rows are chosen. Without any training row all base probabilities are 1. An empty table
    gives an empty one.
    """
    coded = stage(encode(docs, text, id_col, chunk_bytes), "encoded")
    model, final = _fit(coded, classes, sweeps)
    tokens, distinct, documents = model.tokens, model.distinct, model.documents
    steps, class_tokens, class_words = model.transitions, model.class_tokens, model.class_words
    scale = np.log10(tokens + 0.5 * (distinct + 1))

    def run(slices: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        place = _joined(words["place"], "<i4")
        c, k = np.zeros(place.size), np.zeros(place.size, np.int64)
        c[place], k[place] = _joined(words["c"], "<i8"), _joined(words["class"], "<u2")
        base = np.log10(c + 0.5) - scale
        emission = np.log10(c + 0.5) - np.log10(class_tokens[k] + 0.5 * (class_words[k] + 1))
        out = []
        for doc_ids, flags, ends, texts in _documents(slices):
            for doc_id, flag, begin, end in zip(doc_ids.tolist(), flags.tolist(), [0, *ends[:-1]], ends, strict=True):
                ids = texts[begin:end]
                line = np.concatenate(([0], k[ids], [0]))
                n_known = int((c[ids] > 0).sum()) + (documents > 0)
                first = float(base[ids].sum() + np.log10(documents + 0.5) - scale)
                whole = float(steps[line[:-1], line[1:]].sum() + emission[ids].sum())
                out.append((None if flag & 2 else doc_id, bool(flag & 1), ids.size + 1, n_known, tokens, first, whole, 10 ** min(300.0, -whole / (ids.size + 1))))
        frame = pd.DataFrame(out, columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
        return frame.assign(doc_id=pd.array([r[0] for r in out], "Int64"))

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    slices = coded.where("ids is not null").select(F.col("chunk").alias("part"), "doc_ids", "flags", "lengths", "ids")
    return slices.groupBy("part").cogroup(final.where("chunk is not null").groupBy("chunk")).applyInPandas(run, schema)
