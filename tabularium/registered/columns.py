"""Column functions: keys, lines, labels, dates, text."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium import functions as fn
from tabularium.plans.star_schema import StarSchema
from tabularium.registered.book import registered


@registered("select c_custkey, case when length(cast(c_custkey as varchar)) <= 8 then lpad(cast(c_custkey as varchar), 8, '0') end k8 from customer")
def key_lpad(t: StarSchema) -> DataFrame:
    return t.table("customer").select("c_custkey", fn.pad_key(F.col("c_custkey"), 8).alias("k8"))


@registered("""
select lpad(cast(l_orderkey as varchar), 8, '0')
         || case when length(cast(l_partkey as varchar)) <= 4 then lpad(cast(l_partkey as varchar), 4, '0') end
       || lpad(cast(l_linenumber as varchar), 2, '0') k14
from lineitem
""")
def key_compose(t: StarSchema) -> DataFrame:
    parts = [F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")]
    return t.table("lineitem").select(fn.compose_key(parts).alias("k14"))


@registered("""
select p_partkey, concat_ws(' - ', p_brand, case when p_size > 25 then p_type end) d from part
""")
def concat_ws_nullskip(t: StarSchema) -> DataFrame:
    kind = F.when(F.col("p_size") > 25, F.col("p_type"))
    return t.table("part").select("p_partkey", fn.activity_label(F.col("p_brand"), kind).alias("d"))


@registered("""
select o_orderkey, concat_ws(' ', o_orderpriority, case when o_orderstatus <> 'P' then 'das Flores' end,
       cast(o_custkey as varchar)) line
from orders
""")
def address_line(t: StarSchema) -> DataFrame:
    street = F.when(F.col("o_orderstatus") != "P", "das Flores")
    line = fn.address_line(F.col("o_orderpriority"), street, F.col("o_custkey"))
    return t.table("orders").select("o_orderkey", line.alias("line"))


@registered("""
select c_custkey,
       case c_custkey % 7 when 0 then 'MICROEMPREENDEDOR INDIVIDUAL (MEI)' when 1 then 'MICRO EMPRESA (ME)'
            when 3 then 'EMPRESA DE PEQUENO PORTE (EPP)' when 5 then 'DEMAIS' end size,
       case c_custkey % 7 when 0 then 'ATÉ 81 MIL' when 1 then 'ATÉ 360 MIL'
            when 3 then '360 MIL - 4,8 MILHOES' when 5 then 'MAIS DE 4,8 MILHOES' end revenue
from customer
""")
def code_label(t: StarSchema) -> DataFrame:
    code = F.col("c_custkey") % 7
    return t.table("customer").select(
        "c_custkey",
        fn.label_code(code, fn.COMPANY_SIZES).alias("size"),
        fn.label_code(code, fn.REVENUE_BANDS).alias("revenue"),
    )


@registered("""
select event_id, case event_type when 'purchase' then 'PESSOA JURIDICA' when 'signup' then 'PESSOA FISICA'
            when 'error' then 'ESTRANGEIRO' end kind,
       case event_id % 11 when 0 then 'NÃO SE APLICA' when 1 then '0 - 12 ANOS' when 2 then '13 - 20 ANOS'
            when 3 then '21 - 30 ANOS' when 4 then '31 - 40 ANOS' when 5 then '41 - 50 ANOS'
            when 6 then '51 - 60 ANOS' when 7 then '61 - 70 ANOS' when 8 then '71 - 80 ANOS'
            when 9 then 'MAIS DE 80 ANOS' end age
from events
""")
def partner_labels(t: StarSchema) -> DataFrame:
    kinds = {"purchase": 1, "signup": 2, "error": 3}
    code = F.coalesce(*[F.when(F.col("event_type") == name, kind) for name, kind in kinds.items()])
    return t.table("events").select(
        "event_id",
        fn.label_code(code, fn.PARTNER_KINDS).alias("kind"),
        fn.label_code(F.col("event_id") % 11, fn.AGE_BANDS).alias("age"),
    )


@registered("""
with t as (
  select o_orderkey, cast(try_strptime(
           case o_orderkey % 10 when 0 then '-' when 1 then '00000000' when 2 then '20200230' when 3 then null
                else strftime(o_orderdate, '%Y%m%d') end, '%Y%m%d') as date) d
  from orders)
select o_orderkey, d, cast(year(d) as int) y, cast(month(d) as int) m from t
""")
def date_parse(t: StarSchema) -> DataFrame:
    key = F.col("o_orderkey") % 10
    text = (
        F.when(key == 0, "-")
        .when(key == 1, "00000000")
        .when(key == 2, "20200230")
        .when(key > 3, F.date_format("o_orderdate", "yyyyMMdd"))
    )
    parsed = t.table("orders").select("o_orderkey", fn.parse_date(text).alias("d"))
    return parsed.select("*", fn.year_of(F.col("d")).alias("y"), fn.month_of(F.col("d")).alias("m"))


@registered("""
with t as (select o_orderkey, case when o_orderkey % 7 <> 0 then cast(o_orderdate as date) end d from orders)
select o_orderkey, case when d <= date '1997-01-01' then date '1997-01-01' else d end d,
       case when d > date '1997-01-01' then d end d_null
from t
""")
def date_floor(t: StarSchema) -> DataFrame:
    date = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate").cast("date"))
    floor = dt.date(1997, 1, 1)
    return t.table("orders").select(
        "o_orderkey",
        fn.floor_date(date, floor).alias("d"),
        fn.floor_date(date, floor, mode="null").alias("d_null"),
    )


@registered("select doc_id, upper(strip_accents(replace(text, 'ß', 'ss'))) t from documents")
def accent_fold(t: StarSchema) -> DataFrame:
    return t.table("documents").select("doc_id", F.upper(fn.fold_accents(F.col("text"))).alias("t"))


# German text with its umlauts and sharp s lost, and the stems that bring some words back.
_GERMAN_RULES = [
    fn.Repair("fr", "FUER", "word"),
    fn.Repair("ber", "UEBER"),
    fn.Repair("UEBERUEBER", "UEBER"),
]


@registered(r"""
with t as (select doc_id, replace(regexp_replace(text, '[äöüß]', chr(65533), 'g'), chr(65533), '') s from documents)
select doc_id,
       replace(replace(regexp_replace(s, '\bfr\b', 'FUER', 'g'), 'ber', 'UEBER'), 'UEBERUEBER', 'UEBER') t
from t
""")
def mojibake_repair(t: StarSchema) -> DataFrame:
    damaged = F.regexp_replace("text", "[äöüß]", "�")
    return t.table("documents").select("doc_id", fn.repair_text(damaged, _GERMAN_RULES).alias("t"))


@registered("select r_regionkey, replace(r_name, 'ASIA', 'BRASIL') n from region")
def relabel(t: StarSchema) -> DataFrame:
    name = fn.repair_text(F.col("r_name"), [fn.Repair("ASIA", "BRASIL")])
    return t.table("region").select("r_regionkey", name.alias("n"))


@registered("""
select p_partkey, p_name || ', ' || p_brand || ' - ' || p_type k, p_name "name"
from (select p_partkey, p_name, p_brand, case when p_size <> 7 then p_type end p_type from part)
where p_type is not null
union all
select p_partkey, null, null from part where p_size = 7
""")
def search_key(t: StarSchema) -> DataFrame:
    kind = F.when(F.col("p_size") != 7, F.col("p_type"))
    keyed = t.table("part").select(
        "p_partkey", fn.search_key(F.col("p_name"), F.col("p_brand"), kind).alias("k")
    )
    return keyed.select("*", fn.search_name(F.col("k")).alias("name"))
