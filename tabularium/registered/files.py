"""Scans and sinks: each query writes tables to a fresh scratch folder and reads them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium import functions as fn
from tabularium import operators as op
from tabularium import sources as src
from tabularium.plans.star_schema import StarSchema
from tabularium.registered.book import registered
from tabularium.session import scratch_path

_DUMP = "`key` bigint, `place` smallint, `name` string, `note` string, `amount` double"


def _dump(df: DataFrame, path: str, key: str, place: str, name: str, amount: str) -> None:
    """Write a headerless Latin-1 file; some places are no number, some notes are missing."""
    df.select(
        F.col(key).cast("string"),
        F.when(F.col(place) == 3, "S/N").otherwise(F.col(place).cast("string")),
        F.concat(F.lit("Praça; "), F.col(name)),
        F.when(F.col(place) != 4, "órgão \"A\""),
        F.col(amount).cast("string"),
    ).write.option("sep", ";").option("encoding", "ISO-8859-1").option("escape", '"').csv(path)


def _dumps(t: StarSchema, rejects: bool = False) -> DataFrame:
    root = scratch_path(t.spark, "dumps")
    _dump(t.table("customer"), f"{root}/customer", "c_custkey", "c_nationkey", "c_name", "c_acctbal")
    _dump(t.table("supplier"), f"{root}/supplier", "s_suppkey", "s_nationkey", "s_name", "s_acctbal")
    paths = [f"{root}/customer", f"{root}/supplier"]
    return src.read_delimited(t.spark, paths, _DUMP, escape='"', rejects=rejects)


@registered("""
with t as (
  select c_custkey "key", c_nationkey place, c_name "name", c_acctbal amount from customer
  union all select s_suppkey, s_nationkey, s_name, s_acctbal from supplier)
select "key", cast(case when place <> 3 then place end as smallint) place, 'Praça; ' || "name" "name",
       case when place <> 4 then 'órgão "A"' else '-' end note, amount
from t
""")
def delimited_scan(t: StarSchema) -> DataFrame:
    return op.fill_text(_dumps(t))


@registered("""
select "table", count(*) n_rows, count(*) filter (place = 3) n_rejected from (
  select 'customer' "table", c_nationkey place from customer union all select 'supplier', s_nationkey from supplier)
group by 1
""")
def rejected_rows(t: StarSchema) -> DataFrame:
    name = F.regexp_extract("file", "/(customer|supplier)/", 1)
    per_file = src.reject_counts(_dumps(t, rejects=True))
    return per_file.groupBy(name.alias("table")).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_rejected").alias("n_rejected")
    )


@registered("""
select lpad(cast(p_partkey as varchar), 7, '0') code, upper(p_name) description, p_brand sector_code,
       p_type || ', x' sector
from part
""")
def activity_lookup(t: StarSchema) -> DataFrame:
    """A comma-delimited lookup with a header row and a quoted comma."""
    path = scratch_path(t.spark, "activities")
    t.raw_activities.withColumn("SETOR", F.concat("SETOR", F.lit(", x"))).write.option("header", True).csv(path)
    lookup = src.read_lookup(t.spark, path, src.schemas.ACTIVITIES, sep=",", encoding="UTF-8", header=True)
    names = ["code", "description", "sector_code", "sector"]
    return lookup.withColumn("DESCRICAO", F.upper("DESCRICAO")).toDF(*names)


@registered("""
select cast(p_partkey as varchar) p_partkey, cast(p_size as varchar) p_size, p_name || chr(10) || '"x", y' p_name
from part
""")
def headed_csv(t: StarSchema) -> DataFrame:
    path = scratch_path(t.spark, "headed")
    part = t.table("part").select("p_size", F.concat("p_name", F.lit('\n"x", y')).alias("p_name"), "p_partkey")
    src.write_headed_csv(part, path, key="p_partkey")
    return src.read_headed_csv(t.spark, path).select("p_partkey", "p_size", "p_name")


@registered("""
select cast(page_id as varchar) page_id,
       cast(to_json(regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1)) as varchar) links
from pages
""")
def csv_sink(t: StarSchema) -> DataFrame:
    """Arrays leave as JSON text."""
    path = scratch_path(t.spark, "links")
    links = fn.extract_links(F.col("html"), '<a [^>]*href="([^"]*)"')
    src.write_headed_csv(t.table("pages").select(links.alias("links"), "page_id"), path, key="page_id")
    return src.read_headed_csv(t.spark, path)


_INVENTORY = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


@registered(" union all ".join(f"select '{n}' \"table\", count(*) n_rows from {n}" for n in _INVENTORY))
def file_inventory(t: StarSchema) -> DataFrame:
    """Rows per table, added up over its files."""
    files = src.parquet_inventory(t.spark, [f"{t.folder}/{n}.parquet" for n in _INVENTORY])
    name = F.regexp_extract("file", r"/([a-z]+)\.parquet(/|$)", 1)
    return files.where("bytes > 0").groupBy(name.alias("table")).agg(F.sum("n_rows").alias("n_rows"))


@registered("""
select n_name city, count(*) n
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where r_name = 'ASIA' group by 1
""")
def partition_roundtrip(t: StarSchema) -> DataFrame:
    """Write customers by state and city twice, read one state back."""
    path = scratch_path(t.spark, "customers")
    nation = t.table("nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_regionkey", F.col("n_name").alias("city")
    )
    region = t.table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("state"))
    placed = op.join_lookups(t.table("customer"), [(nation, "c_nationkey"), (region, "n_regionkey")])
    for _ in range(2):
        src.write_partitioned(placed, path, ["state", "city"])
    return op.row_counts(src.read_partition(t.spark, path, state="ASIA"), "city").toDF("city", "n")


@registered("""
select o_orderstatus, o_orderkey, o_custkey, o_totalprice from orders
where o_custkey in (select o_custkey from orders group by 1 order by count(*) desc, 1 limit 12)
""")
def key_lookup(t: StarSchema) -> DataFrame:
    """Write orders by status for look-ups by customer, then look up the twelve customers with the most orders."""
    path = scratch_path(t.spark, "lookup")
    orders = t.table("orders")
    src.write_partitioned(orders, path, "o_orderstatus", lookup="o_custkey")
    most = op.preview(op.row_counts(orders, "o_custkey"), 12, [F.desc("n_rows"), "o_custkey"])
    found = src.read_keys(t.spark, path, "o_custkey", [r["o_custkey"] for r in most.collect()])
    return found.select("o_orderstatus", "o_orderkey", "o_custkey", "o_totalprice")


@registered("""
select r_name state, n_name city, count(*) n, max(c_acctbal) highest
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where r_name in ('ASIA', 'EUROPE') and (n_name <> 'FRANCE' or c_custkey % 2 = 0) or n_name = 'BRAZIL'
group by 1, 2
""")
def snapshot_publish(t: StarSchema) -> DataFrame:
    """Publish all customers, then fewer in their place, one city anew and one more; read the last state."""
    path = scratch_path(t.spark, "published")
    nation = t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey", F.col("n_name").alias("city"))
    region = t.table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("state"))
    placed = op.join_lookups(t.table("customer"), [(nation, "c_nationkey"), (region, "n_regionkey")])
    src.publish(placed, path, ["state", "city"])
    src.publish(placed.where("state in ('ASIA', 'EUROPE')"), path, ["state", "city"])
    src.publish(placed.where("city = 'FRANCE' and c_custkey % 2 = 0"), path, ["state", "city"], "overwrite_partitions")
    src.publish(placed.where("city = 'BRAZIL'"), path, ["state", "city"], "append")
    rows = src.read_snapshot(t.spark, path)
    return rows.groupBy("state", "city").agg(F.count("*").alias("n"), F.max("c_acctbal").alias("highest"))


@registered("""
select o_orderstatus, count(*) n, min(o_totalprice) lowest, max(o_totalprice) highest from orders group by 1
""")
def catalog_table(t: StarSchema) -> DataFrame:
    """Save orders as a partitioned catalog table, then ask it in SQL."""
    name = f"orders_{uuid.uuid4().hex}"
    src.save_table(t.table("orders"), name, "o_orderstatus", path=scratch_path(t.spark, "catalog"))
    return t.spark.sql(
        f"select o_orderstatus, count(*) n, min(o_totalprice) lowest, max(o_totalprice) highest from {name} group by 1"
    )
