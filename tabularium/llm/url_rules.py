"""URL rules by a sort-merge range join, in DataFrame operations only.

The host of a rule or URL is turned into a canonical key: its labels in reverse order, each followed
by a dot. All hosts under a rule's host then lie in one interval of keys. Intervals are nested or
apart, so a sweep over the sorted keys needs a stack: a rule is pushed where its interval starts and
popped where it ends. Starts and ends are events that carry the stack behind them; URLs and events
are sorted together and every URL takes the stack of the last event before it (a running window).
Of the rules on the stack, the longest whose path begins the URL's path wins.

The sorted order is cut into ranges of keys, each opened by an event with the stack at its start.
Keys that hold many rows are dealt out over several copies of their range.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabularium.llm.common import lower_ascii, stage

#: Rows (URLs) that one sorted range should hold.
ROWS_PER_RANGE = 200_000
#: Cuts are literals of the plan, so their number is fixed; with more rows a range is dealt out over more copies.
MAX_RANGES = 1024
DEFAULT = "allow"

_STACK = "array<struct<host:string,path:string,verdict:string>>"


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A to Z in lower case; empty without ``://``."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def key_of(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _end(key: Column) -> Column:
    """The first key behind all keys that begin with ``key``: its last dot becomes the next character."""
    return F.concat(F.expr("left(key, length(key) - 1)"), F.lit("/"))


def _prefixes(key: Column) -> Column:
    """Every key that ``key`` lies under, itself included."""
    labels = F.split(F.expr("left(key, length(key) - 1)"), r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))


def _events(rules: DataFrame) -> DataFrame:
    """``key, stack``: the active rules from each start or end of an interval on."""
    own = rules.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("host", "path", "verdict"))).alias("own"))
    under = own.select(F.col("key").alias("inner"), F.explode(_prefixes(F.col("key"))).alias("key"))
    nested = under.join(own, "key").groupBy("inner").agg(F.flatten(F.array_sort(F.collect_list("own"))).alias("stack"))
    start = nested.select(F.col("inner").alias("key"), "stack")
    # Behind the end of an interval those rules stay active that lie around it: the stack without its own rules.
    left = nested.withColumnRenamed("inner", "key").join(own, "key").select(_end(F.col("key")).alias("key"), F.array_except("stack", "own").alias("stack"))
    # Intervals that end together: the outermost counts. A start at the same key counts before any end.
    ends = left.groupBy("key").agg(F.min_by("stack", F.size("stack")).alias("stack"))
    return start.unionByName(ends.join(start.select("key"), "key", "left_anti"))


def _range_number(key: Column, cuts: list[str]) -> Column:
    known = F.array(*[F.lit(c) for c in cuts]).cast("array<string>")
    return F.size(F.filter(known, lambda c: c <= key))


def _literal(spark: SparkSession, rows: list[Column], kind: str) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*rows).cast(kind)))


def match(
    urls: DataFrame,
    rules: Iterable[tuple[str, str, str]] | DataFrame,
    url: str = "url",
    id_col: str = "page_id",
    rows_per_range: int = ROWS_PER_RANGE,
    default: str = DEFAULT,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row. ``rules`` are ``(verdict, host, path)``.

    A rule fits its host and all subdomains if the URL's path starts with the rule's; the longest wins
    (host and path together, then the smaller text). Null URLs and those without ``://`` have an empty
    host and path, which no rule fits. Without a rule the verdict is ``default`` and ``rule`` is null.
    Repeated rows each get a row; an empty table gives an empty one.
    """
    spark = urls.sparkSession
    if not isinstance(rules, DataFrame):
        listed = [F.struct(*[F.lit(v).cast("string").alias(n) for v, n in zip(r, ("verdict", "host", "path"), strict=True)]) for r in rules]
        rules = _literal(spark, listed, "array<struct<verdict:string,host:string,path:string>>")
    rules = rules.select("host", "path", "verdict").where("host is not null and path is not null and host <> ''").withColumn("key", key_of(F.col("host")))
    events = stage(_events(rules), "rule-events")

    rows = urls.select(F.col(id_col).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    rows = stage(rows.withColumn("key", key_of(F.col("host"))), "url-keys")
    # Ranges of about equal numbers of rows, by keys that are drawn evenly from the sorted order of a sample of fixed size.
    hosts = rows.groupBy("key").agg(F.count("*").alias("n"))
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = min(MAX_RANGES, max(1, math.ceil(total / rows_per_range)))
    draw = hosts.orderBy(F.desc(F.col("n") >= total / ranges / 4), F.xxhash64("key"), "key").limit(50 * ranges if ranges > 1 else 0)
    drawn = sorted(r["key"] for r in draw.select("key").collect())
    cuts = sorted({drawn[len(drawn) * i // ranges] for i in range(1, ranges)}) if drawn else []

    placed = rows.withColumn("range", _range_number(F.col("key"), cuts))
    sizes = placed.groupBy("range").agg(F.count("*").alias("n"))  # a row for each range
    copies = F.broadcast(sizes.select("range", F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(2 * rows_per_range))).cast("int").alias("copies")))
    dealt = placed.join(copies, "range").withColumn("copy", F.pmod(F.xxhash64("page_id", "path"), F.col("copies")).cast("int"))

    # The stack at the start of a range is that of the last event at or before it.
    listed = [F.struct(F.lit(i).alias("range"), F.lit(c).alias("key")) for i, c in enumerate(["", *cuts])]
    opening = _literal(spark, listed, "array<struct<range:int,key:string>>")
    before = opening.select("range", "key", F.explode(F.when(F.col("key") == "", F.array(F.lit(""))).otherwise(_prefixes(F.col("key")))).alias("prefix"))
    own = rules.groupBy(F.col("key").alias("prefix")).agg(F.sort_array(F.collect_set(F.struct("host", "path", "verdict"))).alias("own"))
    first = before.join(own, "prefix", "left").groupBy("range", "key").agg(F.flatten(F.array_sort(F.collect_list("own"))).alias("stack"))
    opened = first.select("range", "key", F.col("stack").cast(_STACK).alias("stack"), F.lit(0).alias("turn"))
    changes = events.select(_range_number(F.col("key"), cuts).alias("range"), "key", F.col("stack").cast(_STACK).alias("stack"), F.lit(1).alias("turn"))
    changes = opened.unionByName(changes).join(copies, "range").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")

    marks = changes.select("range", "copy", "key", "turn", "stack", F.lit(None).cast(urls.schema[id_col].dataType).alias("page_id"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"))
    points = dealt.select("range", "copy", "key", F.lit(2).alias("turn"), F.lit(None).cast(_STACK).alias("stack"), "page_id", "host", "path")
    sweep = Window.partitionBy("range", "copy").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = marks.unionByName(points).withColumn("active", F.last("stack", ignorenulls=True).over(sweep)).where("turn = 2")

    fitting = F.filter("active", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(F.transform(fitting, lambda r: F.struct((F.length(r["host"]) + F.length(r["path"])).alias("n"), F.concat(r["host"], r["path"]).alias("rule"), r["verdict"].alias("verdict"))))
    won = swept.withColumn("won", best)
    return won.select("page_id", "host", "path", F.col("won.rule").alias("rule"), F.coalesce("won.verdict", F.lit(default)).alias("verdict"))


#: The rules of the registered query, ``(verdict, host, path)``.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def filter_allowed(urls: DataFrame, judged: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The rows whose verdict is not ``block``."""
    blocked = judged.where("verdict = 'block'").select(F.col("page_id").alias("__blocked")).distinct()
    return urls.join(blocked, urls[id_col].eqNullSafe(blocked["__blocked"]), "left_anti")
