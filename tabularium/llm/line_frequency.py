"""Quality rules from line frequencies across documents, in DataFrame operations only.

Lines are normalised and hashed. A line that occurs in more than ``max_documents`` documents of a
host is taken for boilerplate and removed; a document that loses more than ``max_removed`` of its
characters is depleted and rejected. Counts cover all documents and are combined before they move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import WORD_BREAK, stage

MAX_DOCUMENTS = 20
MAX_REMOVED = 0.5
MIN_WORDS = 50
#: Frequent lines are broadcast up to this many bytes, by their number, else they are shuffled.
MAX_BROADCAST_BYTES = 16 << 20


def words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def _base(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """``doc_id`` and the counts of every row. Each step that is used more than once is a column of its own."""
    content = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    cut = content.select(
        "doc_id", words(F.col("t")).alias("w"), lines.alias("lines"), F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols")
    )
    # A window's hash with its position in the low bits: sorting brings equal windows together.
    n = F.size("w")
    counted = cut.select(
        "doc_id", "w", "n_symbols", n.cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.conv(n.cast("string"), 10, 2))).alias("span"),
    )
    windows = F.when(
        F.col("n_words") >= 3,
        F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size("w") - 3),
            lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).bitwiseAND(F.negative(F.col("span"))).bitwiseOR(i.cast("long")),
        )),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = counted.withColumn("s", windows)

    def same(x: Column, j: Column) -> Column:
        # The low bits of a hash are lost to the position, so windows with equal bits are compared word by word.
        other = F.get("s", j)
        a, b = (v.bitwiseAND(F.col("span") - 1).cast("int") for v in (x, other))
        equal = F.lit(True)
        for k in range(3):
            equal = equal & (F.get("w", a + k) == F.get("w", b + k))
        return F.coalesce(x.bitwiseXOR(other).between(0, F.col("span") - 1) & equal, F.lit(False))

    def twin(x: Column, i: Column) -> Column:
        # Two places on either side: another window with the same bits may lie between twins.
        return same(x, i + 1) | same(x, i - 1) | same(x, i + 2) | same(x, i - 2)

    repeated = F.sort_array(F.transform(F.filter("s", twin), lambda x: x.bitwiseAND(F.col("span") - 1)))
    found = hashed.withColumn("r", repeated)
    # Windows overlap: each adds the words that the one before it has not covered.
    covered = F.aggregate(
        F.transform("r", lambda p, i: F.when(i == 0, F.lit(3).cast("long")).otherwise(F.least(F.lit(3).cast("long"), p - F.get("r", i - 1)))),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"))


def _normal_line(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\x0b\x0c\r"))


def lines_of(docs: DataFrame, text: str = "text", id_col: str = "doc_id", host: str = "source") -> DataFrame:
    """``doc_id, row, host, lines``: hash and length of every normalised line that has a word.

    Normalised: lower case, runs of digits as one 0, white space at the ends removed.
    """
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), "[0-9]+", "0")
    trimmed = F.filter(F.transform(F.split(plain, "\n"), _normal_line), lambda x: x != "")
    # Rows without an id are documents of their own.
    own = F.when(F.col(id_col).isNull(), F.monotonically_increasing_id())
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), own.alias("row"), F.col(host).cast("string").alias("host"),
        F.transform(trimmed, lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("chars"))).alias("lines"),
    )


def _sized(df: DataFrame) -> DataFrame:
    """A staged table of lines, to be broadcast if it is small by its counted rows."""
    return F.broadcast(df) if df.count() * 64 <= MAX_BROADCAST_BYTES else df


def _occurrences(lines: DataFrame, max_documents: int) -> DataFrame:
    """``doc_id, row, host, h, chars`` of every line that is in more than ``max_documents`` rows of a host, once for each time."""
    once = lines.select("host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    often = once.groupBy("host", "h").agg(F.count("*").alias("rows")).where(F.col("rows") > max_documents)
    often = _sized(stage(often.select(F.col("host").alias("often_host"), F.col("h").alias("often_h")), "often"))
    each = lines.select("doc_id", "row", "host", F.inline("lines"))
    return stage(each.join(often, F.col("host").eqNullSafe(F.col("often_host")) & (F.col("h") == F.col("often_h")), "left_semi"), "occurrences")


def frequent_lines(occurrences: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """``host, h, documents`` of the lines in more than ``max_documents`` documents of a host. Null is a host like any other.

    Rows of one id are one document, each row without an id is one.
    """
    once = occurrences.select("host", "h", "doc_id", "row").distinct()
    return once.groupBy("host", "h").agg(F.count("*").alias("documents")).where(F.col("documents") > max_documents)


def _removed(lines: DataFrame, max_documents: int) -> DataFrame:
    """``doc_id, own, chars`` of every occurrence of a frequent line."""
    found = _occurrences(lines, max_documents)
    frequent = frequent_lines(found, max_documents).select(F.col("host").alias("line_host"), F.col("h").alias("line_h"))
    frequent = _sized(stage(frequent, "frequent"))
    kept = found.join(frequent, F.col("host").eqNullSafe(F.col("line_host")) & (F.col("h") == F.col("line_h")), "left_semi")
    return kept.select("doc_id", F.col("h").alias("own"), "chars")


def judge(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    max_removed: float = MAX_REMOVED,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The counts of each row, ``base_failed``, ``removed_chars``, ``line_chars`` and ``kept``.

    Null texts count as empty; with fewer than ``min_words`` words they fail. Rows of one id are one document
    when lines are counted, rows without an id are one each; both share the verdict on their lines. An empty
    table gives an empty result.
    """
    lines = lines_of(docs, text, id_col, host)
    removed = _removed(lines, max_documents)
    totals = lines.select("doc_id", F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + x["chars"]).alias("line_chars"))
    lost = (
        totals.select("doc_id", "line_chars", F.lit(0).cast("long").alias("removed_chars"))
        .unionByName(removed.select("doc_id", F.lit(0).cast("long").alias("line_chars"), F.col("chars").cast("long").alias("removed_chars")))
        .groupBy(F.col("doc_id").alias("line_id"))
        .agg(F.sum("line_chars").alias("line_chars"), F.sum("removed_chars").alias("removed_chars"))
    )
    # Written, so that a filter on the verdict is not pushed into the counts, where it would repeat their work.
    base = stage(_base(docs, text, id_col), "counts")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    joined = base.join(lost, F.col("doc_id").eqNullSafe(F.col("line_id")))
    depleted = F.col("removed_chars") > F.col("line_chars") * F.lit(max_removed)
    return joined.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"), "line_chars", "removed_chars",
    )


def clean(docs: DataFrame, text: str = "text", id_col: str = "doc_id", host: str = "source", max_documents: int = MAX_DOCUMENTS, **limits) -> DataFrame:
    """The kept documents with their frequent lines taken out of ``text``; columns as in ``docs``."""
    gone = _removed(lines_of(docs, text, id_col, host), max_documents)
    gone = gone.groupBy(F.col("doc_id").alias("__gone_id")).agg(F.collect_set("own").alias("__gone"))  # of one document: at most its own lines
    kept = judge(docs, text, id_col, host, max_documents, **limits).where("kept").select(F.col("doc_id").alias("__id")).distinct()
    joined = docs.join(kept, docs[id_col].eqNullSafe(kept["__id"])).join(gone, docs[id_col].eqNullSafe(gone["__gone_id"]), "left")

    def stays(line: Column) -> Column:
        return ~F.coalesce(F.array_contains("__gone", F.xxhash64(_normal_line(F.regexp_replace(F.lower(line), "[0-9]+", "0")))), F.lit(False))

    left = F.array_join(F.filter(F.split(docs[text], "\n"), stays), "\n")
    return joined.select(*[left.alias(c) if c == text else docs[c] for c in docs.columns])
