"""Filters, null handling, lookup joins, the consolidation join, dedup and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium import functions as fn
from tabularium import operators as op
from tabularium.plans.star_schema import StarSchema
from tabularium.registered.book import registered


@registered("select o_orderkey from orders where o_orderstatus = 'F'")
def status_filter(t: StarSchema) -> DataFrame:
    return op.active_only(t.table("orders"), "o_orderstatus", "F").select("o_orderkey")


@registered("""
select doc_id, coalesce(case when doc_id % 3 <> 0 then source end, '-') src, quality, coalesce(toxic, 105) toxic
from documents left join labels using (doc_id)
where quality is not null
""")
def fill_drop(t: StarSchema) -> DataFrame:
    # The order matters: `src` is filled before rows are dropped, so it drops none.
    df = t.table("documents").join(t.table("labels"), "doc_id", "left")
    df = df.select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("src"), "quality", "toxic")
    return op.drop_missing(op.fill_text(op.fill_code(df, "toxic")), ["src", "quality"])


@registered("select c_custkey, n_name from customer join nation on c_nationkey = n_nationkey")
def lookup_join(t: StarSchema) -> DataFrame:
    nation = t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return op.join_lookup(t.table("customer"), nation, "c_nationkey").select("c_custkey", "n_name")


@registered("""
select o_orderkey, c_name, c_mktsegment from orders left join customer
    on o_custkey = c_custkey and c_mktsegment <> 'HOUSEHOLD'
""")
def lookup_join_shuffled(t: StarSchema) -> DataFrame:
    """The same lookup join where the lookup is over the size that may be broadcast."""
    known = t.table("customer").where("c_mktsegment <> 'HOUSEHOLD'")
    lookup = known.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    joined = op.join_lookup(t.table("orders"), lookup, "o_custkey", how="left", max_bytes=0)
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@registered("""
select c_custkey from customer where c_nationkey in (
  select n_nationkey from nation join region on n_regionkey = r_regionkey where r_name in ('AFRICA', 'AMERICA'))
""")
def lookup_membership(t: StarSchema) -> DataFrame:
    regions = t.table("region").where("r_name in ('AFRICA', 'AMERICA')")
    nations = t.table("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_regionkey").alias("r_regionkey")
    )
    known = op.join_lookup(nations, regions, "r_regionkey").select("c_nationkey")
    twice = known.unionAll(known)
    return op.keep_known(t.table("customer"), twice, "c_nationkey").select("c_custkey")


@registered("""
select case when o_orderkey % 5 <> 0 then o_custkey % 30 end code, count(*) n_rows
from orders
where o_orderkey % 5 = 0 or o_custkey % 30 not in (select n_nationkey from nation)
group by 1
""")
def lookup_misses(t: StarSchema) -> DataFrame:
    code = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey") % 30)
    lookup = t.table("nation").select(F.col("n_nationkey").cast("bigint").alias("code"), "n_name")
    return op.lookup_misses(t.table("orders").select(code.alias("code")), lookup, "code")


@registered("""
select c_custkey, concat_ws(' - ', n_name, r_name) place
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def place_line(t: StarSchema) -> DataFrame:
    line = fn.place_line(F.col("city"), F.col("state"))
    return _companies(t, "c_custkey").select("c_custkey", line.alias("place"))


def _companies(t: StarSchema, *names: str) -> DataFrame:
    nation = t.table("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_regionkey", F.col("n_name").alias("city")
    )
    region = t.table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("state"))
    placed = op.join_lookups(t.table("customer"), [(nation, "c_nationkey"), (region, "n_regionkey")])
    return placed.select(*names, "city", "state")


def consolidation_inputs(t: StarSchema) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Finished orders as establishments, customers as companies, events as partners; kinds without a label get none."""
    order, owner = F.col("o_orderkey"), F.col("o_custkey")
    est = op.active_only(t.table("orders"), "o_orderstatus", "F").select(
        fn.pad_key(owner, 8).alias("key8"),
        fn.compose_key([owner, order % 10000, order % 97]).alias("key14"),
        F.col("o_orderdate").cast("date").alias("start"),
    )
    com = _companies(t, "c_custkey", "c_name").select(
        fn.pad_key(F.col("c_custkey"), 8).alias("key8"), F.col("c_name").alias("company"), "city", "state"
    )
    par = t.table("events").select(
        fn.pad_key(F.col("user_id"), 8).alias("key8"),
        fn.label_code(F.col("event_type"), {"signup": "PF", "purchase": "PJ"}).alias("kind"),
        F.col("ts").cast("date").alias("since"),
    )
    return est, com, par


_CONSOLIDATED = """
with est as (select lpad(cast(o_custkey as varchar), 8, '0') key8,
       lpad(cast(o_custkey as varchar), 8, '0') || lpad(cast(o_orderkey % 10000 as varchar), 4, '0')
         || lpad(cast(o_orderkey % 97 as varchar), 2, '0') key14,
       cast(o_orderdate as date) "start" from orders where o_orderstatus = 'F'),
     com as (select lpad(cast(c_custkey as varchar), 8, '0') key8, c_name company, n_name city,
       r_name state from customer join nation on c_nationkey = n_nationkey
       join region on n_regionkey = r_regionkey),
     par as (select lpad(cast(user_id as varchar), 8, '0') key8,
       case event_type when 'signup' then 'PF' when 'purchase' then 'PJ' end kind,
       cast(ts as date) since from events)
"""
_INNER = " from est join com using (key8) join par using (key8)"
_COLUMNS = 'select key14, key8, "start", company, city, state, kind, since'
_SPREAD = [["key14"], ["company"], ["kind", "since"]]
CONSOLIDATED_COLUMNS = ["key14", "key8", "start", "company", "city", "state", "kind", "since"]


@registered(_CONSOLIDATED + _COLUMNS + _INNER)
def flagship_consolidate(t: StarSchema) -> DataFrame:
    return op.consolidate(*consolidation_inputs(t), "key8", spread=_SPREAD).select(*CONSOLIDATED_COLUMNS)


@registered(_CONSOLIDATED + _COLUMNS + _INNER)
def skewed_consolidate(t: StarSchema) -> DataFrame:
    """The same join with so small a share per task that most keys are spread over several."""
    joined = op.consolidate(*consolidation_inputs(t), "key8", spread=_SPREAD, rows_per_task=4)
    return joined.select(*CONSOLIDATED_COLUMNS)


@registered(_CONSOLIDATED + _COLUMNS + " from est left join com using (key8) left join par using (key8)")
def left_consolidate(t: StarSchema) -> DataFrame:
    """Establishments without partners stay; keys spread over tasks here too."""
    joined = op.consolidate(*consolidation_inputs(t), "key8", "left", _SPREAD, rows_per_task=8)
    return joined.select(*CONSOLIDATED_COLUMNS)


@registered(
    _CONSOLIDATED + "select state, city, count(*) n_rows, count(distinct key14) n_est" + _INNER + " group by all"
)
def partition_profile(t: StarSchema) -> DataFrame:
    profile = op.consolidation_profile(*consolidation_inputs(t), "key8", ["state", "city"], "key14")
    return profile.select("state", "city", F.col("n_rows").cast("bigint"), "n_est")


@registered("""
select user_id, event_id from (
  select *, row_number() over (partition by user_id order by ts, event_id) rn from events) where rn = 1
""")
def dedup_first(t: StarSchema) -> DataFrame:
    return op.dedup_first(t.table("events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id")


@registered("select count(distinct o_custkey) n from orders")
def dedup_count(t: StarSchema) -> DataFrame:
    return op.dedup_count(t.table("orders"), "o_custkey")


@registered("select distinct o_orderpriority from orders")
def distinct_values(t: StarSchema) -> DataFrame:
    return op.distinct_values(t.table("orders"), "o_orderpriority")


@registered("""
with t as (select quality, toxic, lang from documents left join labels using (doc_id))
select 'quality' col, count(*) filter (quality is null) n_null from t
union all select 'toxic', count(*) filter (toxic is null) from t
union all select 'lang', count(*) filter (lang is null) from t
""")
def null_audit(t: StarSchema) -> DataFrame:
    df = t.table("documents").join(t.table("labels"), "doc_id", "left")
    return op.null_audit(df, ["quality", "toxic", "lang"])


@registered("select user_id, arg_max(value, (ts, event_id)) v from events group by 1")
def last_wins(t: StarSchema) -> DataFrame:
    return op.last_wins(t.table("events"), "user_id", ["ts", "event_id"]).select("user_id", F.col("value").alias("v"))


@registered("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10")
def preview_top(t: StarSchema) -> DataFrame:
    top = op.preview(t.table("orders"), 10, [F.col("o_totalprice").desc(), "o_orderkey"])
    return top.select("o_orderkey", "o_totalprice")


@registered("select lang, source, count(*) n_rows from documents group by all")
def row_counts(t: StarSchema) -> DataFrame:
    return op.row_counts(t.table("documents"), ["lang", "source"])


@registered("""
with d as (select 1 part, o_orderstatus kind, o_custkey id from orders where o_orderpriority <> '1-URGENT'
           union all select 2, o_orderstatus, o_custkey from orders where o_orderpriority < '3')
select kind, count(*) n_rows, count(distinct id) n_exact, true "close" from d group by 1
union all select 'all', count(*), count(distinct id), true from d
""")
def sketch_profile(t: StarSchema) -> DataFrame:
    """Two overlapping deliveries are sketched apart and merged; are the estimates within 4 % of the exact counts?"""
    orders = t.table("orders").select(F.col("o_orderstatus").alias("kind"), F.col("o_custkey").alias("id"), "o_orderpriority")
    deliveries = [orders.where("o_orderpriority <> '1-URGENT'"), orders.where("o_orderpriority < '3'")]
    sketched = [op.count_sketches(df, "kind", "id") for df in deliveries]
    per_kind = op.merge_sketches(sketched, "kind")
    whole = op.merge_sketches([per_kind]).select(F.lit("all").alias("kind"), "n_rows", "sketch")
    exact = deliveries[0].unionByName(deliveries[1]).rollup("kind").agg(F.count_distinct("id").alias("n_exact"))
    exact = exact.select(F.coalesce("kind", F.lit("all")).alias("kind"), "n_exact")
    found = op.estimated_counts(per_kind.unionByName(whole)).join(F.broadcast(exact), "kind")
    return found.select("kind", "n_rows", "n_exact", (F.abs(F.col("n_distinct") - F.col("n_exact")) <= F.col("n_exact") * 0.04).alias("close"))
