"""Extraction from stored pages, and the enrichment of companies with it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium import functions as fn
from tabularium import operators as op
from tabularium.plans.enrichment import enrich, page_results
from tabularium.plans.star_schema import StarSchema
from tabularium.registered.book import registered

# The stored pages list their links as items of a navigation bar.
ITEM_LIST = fn.PageLayout(block=r"(?s)<li>(.*?)</li>")


def _decoded(sql: str) -> str:
    for entity, char in (("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&copy;", "©"), ("&middot;", "·")):
        sql = f"replace({sql}, '{entity}', '{char}')"
    return f"replace({sql}, '&amp;', '&')"


def _stripped(sql: str) -> str:
    return _decoded(f"regexp_replace({sql}, '<[^>]*>', '', 'g')")


@registered(f"""
with l as (select page_id, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) a from pages),
     u as (select page_id, unnest(generate_series(0, len(a) - 1)) pos, unnest(a) link from l)
select page_id, cast(pos as int) pos, {_decoded("link")} link from u
""")
def html_links(t: StarSchema) -> DataFrame:
    return t.table("pages").select("page_id", F.posexplode(fn.extract_links(F.col("html"))).alias("pos", "link"))


@registered(f"""
with b as (select page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) a from pages),
     u as (select page_id, unnest(a[1:len(a) - 1]) blk, unnest(generate_series(0, len(a) - 2)) pos from b)
select page_id, cast(pos as int) pos, nullif({_decoded("regexp_extract(blk, 'href=\"([^\"]*)\"', 1)")}, '') link,
       nullif({_stripped("blk")}, '') descr
from u
""")
def html_blocks(t: StarSchema) -> DataFrame:
    results = F.inline(fn.extract_results(F.col("html"), ITEM_LIST))
    return t.table("pages").select("page_id", results).withColumnRenamed("descricao", "descr")


@registered(f"""
with b as (select page_id, unnest(regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1)) blk,
                  unnest(generate_series(0, len(regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1)) - 1)) pos
           from pages)
select page_id, cast(pos as int) pos, nullif({_stripped("blk")}, '') descr from b
""")
def html_paragraphs(t: StarSchema) -> DataFrame:
    """Long blocks with nested tags and entities, none left out."""
    layout = fn.PageLayout(block=r"(?s)<p>(.*?)</p>")
    results = F.inline(fn.extract_results(F.col("html"), layout, drop_last=False))
    return t.table("pages").select("page_id", results).select("page_id", "pos", F.col("descricao").alias("descr"))


@registered("""
select page_id, coalesce(nullif(regexp_extract(html, 'href="tel:([^"]+)"', 1), ''), 'NAO DISPONIBILIZADO') tel
from pages
""")
def html_phone(t: StarSchema) -> DataFrame:
    return t.table("pages").select("page_id", fn.extract_phone(F.col("html")).alias("tel"))


@registered(f"""
select page_id, coalesce(nullif({_stripped("regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")}, ''),
                         'NAO DISPONIBILIZADO') tel
from pages
""")
def html_side_panel(t: StarSchema) -> DataFrame:
    """The phone rule on a part that the stored pages do have."""
    return t.table("pages").select("page_id", fn.extract_phone(F.col("html"), r"(?s)<footer>(.*?)</footer>").alias("tel"))


# Three customers share a name; every seventh is called by the part before the comma alone, and
# every tenth has no city and so no search key.
_COMPANIES = """
  select c_custkey, case when c_custkey % 7 = 0 then 'Loja, ' || c_custkey
                         else 'Loja ' || cast(floor(c_custkey / 3) as bigint) end trade,
         case when c_custkey % 10 <> 0 then n_name end city, r_name state
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""


@registered(f"""
with c as ({_COMPANIES}),
     k as (select c_custkey, trade || ', ' || city || ' - ' || state q from c),
     n as (select q, "name" from (
             select q, split_part(q, ',', 1) "name",
                    row_number() over (partition by split_part(q, ',', 1) order by c_custkey desc) rn from k)
           where rn = 1 and q is not null),
     p as (select q, html from (
             select q, html, row_number() over (partition by q order by page_id desc) rn
             from pages join k on c_custkey = page_id * 3 + 2 where q is not null) where rn = 1),
     b as (select q, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) a from p)
select "name" "NOME_EMPRESA", 'NAO DISPONIBILIZADO' tel,
       coalesce(array_to_string(list_transform(a[1:len(a) - 1],
         lambda x: {_decoded("regexp_extract(x, 'href=\"([^\"]*)\"', 1)")}), '|'), '') links,
       coalesce(array_to_string(list_transform(a[1:len(a) - 1], lambda x: {_stripped("x")}), '|'), '') texts
from n left join b using (q)
""")
def enrichment(t: StarSchema) -> DataFrame:
    """Customers with the links and texts of the page stored for their search key."""
    key = F.col("c_custkey")
    nation = t.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey", "n_name")
    region = t.table("region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("UF"))
    trade = F.when(key % 7 == 0, F.concat(F.lit("Loja, "), key.cast("string"))).otherwise(
        F.concat(F.lit("Loja "), F.floor(key / 3).cast("string"))
    )
    placed = op.join_lookups(t.table("customer"), [(nation, "c_nationkey"), (region, "n_regionkey")])
    companies = placed.select(
        key.alias("CNPJ"),
        trade.alias("NOME FANTASIA"),
        F.when(key % 10 != 0, F.col("n_name")).alias("MUNICIPIO"),
        "UF",
    )
    queries = companies.select(
        F.col("CNPJ").alias("owner"),
        fn.search_key(F.col("NOME FANTASIA"), F.col("MUNICIPIO"), F.col("UF")).alias("query"),
    )
    found = page_results(t.table("pages"), "page_id", ITEM_LIST)
    found = found.withColumn("owner", F.col("page_id") * 3 + 2).join(queries, "owner")
    # Every customer is listed twice; the copies go before names are compared.
    enriched = enrich(companies.unionAll(companies), found, ["CNPJ"])

    def text(name: str):
        return F.array_join(F.transform(name, lambda x: F.coalesce(x, F.lit(""))), "|")

    return enriched.select("NOME_EMPRESA", "tel", text("link").alias("links"), text("descricao").alias("texts"))
