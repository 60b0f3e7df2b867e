"""The composed datasets, on registry-shaped tables derived from the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium import operators as op
from tabularium.operators.names import cols
from tabularium.plans.job import COMPANY_KEY, PARTITION_COLUMNS, SPREAD, staged
from tabularium.plans.registry import COMPANY_COLUMNS, ESTABLISHMENT_COLUMNS, PARTNER_COLUMNS
from tabularium.plans.star_schema import StarSchema
from tabularium.plans.state import state_extract
from tabularium.registered.book import registered
from tabularium.session import scratch_path
from tabularium.sources import write_partitioned

_ESTABLISHMENTS = """
est as (
  select lpad(cast(o_custkey as varchar), 8, '0') || lpad(cast(o_orderkey % 10000 as varchar), 4, '0')
           || lpad(cast(o_orderkey % 97 as varchar), 2, '0') "CNPJ",
         lpad(cast(o_custkey as varchar), 8, '0') "CNPJ BASICO",
         lpad(cast(o_orderkey % 10000 as varchar), 4, '0') "CNPJ ORDEM",
         lpad(cast(o_orderkey % 97 as varchar), 2, '0') "CNPJ DV",
         case when o_orderkey % 6 <> 0 then 'Loja ' || o_orderkey else '-' end "NOME FANTASIA",
         case when o_orderkey % 10 = 2 then date '1900-01-01'
              when o_orderkey % 10 > 2 then cast(o_orderdate as date) end "INICIO ATIVIDADE",
         lpad(cast(o_orderkey % 3000 as varchar), 7, '0') "CNAE PRINCIPAL", '-' "CNAE SEGUNDARIO",
         case o_orderpriority when '1-URGENT' then 'PRACA' when '2-HIGH' then 'ESTACAO' when '3-MEDIUM' then 'AREA'
              when '4-NOT SPECIFIED' then 'SITIO' else '-' end "TIPO LOGRADOURO",
         'das "Flores"; ' || o_custkey "LOGRADOURO",
         try_cast(o_orderkey as smallint) "NUMERO", '-' "COMPLEMENTO", '-' "BAIRRO",
         o_orderkey + 80000000 "CEP",
         case o_custkey % 5 when 0 then 'PR' when 1 then 'SP' when 2 then 'RJ' when 3 then 'MG' else '-' end "UF",
         cast(41 as smallint) "DDD", o_orderkey + 30000000 "TELEFONE",
         case when o_orderkey % 4 <> 0 then 'LOJA' || o_orderkey || '@EXEMPLO.COM' else '-' end "EMAIL",
         cast(case when o_orderkey % 10 = 2 then 1890
                   when o_orderkey % 10 > 2 then year(o_orderdate) end as int) "ANO INICIO ATIVIDADE",
         cast(case when o_orderkey % 10 = 2 then 1
                   when o_orderkey % 10 > 2 then month(o_orderdate) end as int) "MES INICIO ATIVIDADE",
         case when c.n_nationkey = 5 then 'BRASIL' else c.n_name end "PAIS", m.n_name "MUNICIPIO",
         upper(p_name) "DESCRICAO", p_type "SETOR",
         lpad(cast(o_orderkey % 3000 as varchar), 7, '0') || ' - ' || upper(p_name) "CNAE DESCRICAO"
  from orders
  join nation c on c.n_nationkey + 100 = case when o_orderkey % 3 <> 0 then o_custkey % 30 + 100 else 105 end
  join nation m on m.n_nationkey = o_custkey % 25
  join part on p_partkey = o_orderkey % 3000
  where o_orderstatus = 'F' and o_orderkey % 13 <> 0)
"""
_COMPANIES = """
com as (
  select lpad(cast(c_custkey as varchar), 8, '0') "CNPJ BASICO",
         case when c_custkey % 11 <> 0 then c_name else '-' end "RAZAO SOCIAL",
         cast(floor(c_acctbal) as bigint) || ',00' "CAPITAL SOCIAL",
         case n_nationkey % 10 when 0 then 'SOCIEDADE EMPRESARIA LIMITADA' when 1 then 'ORGAO PUBLICO'
              when 2 then 'ORGAO PUBLICO' when 3 then 'FUNDACAO PRIVADA' when 4 then 'CARGO EM COMISSAO'
              else 'NATUREZA ' || (n_nationkey + 2000) end "NATUREZA JURIDICA",
         case c_custkey % 7 when 0 then 'MICROEMPREENDEDOR INDIVIDUAL (MEI)' when 1 then 'MICRO EMPRESA (ME)'
              when 3 then 'EMPRESA DE PEQUENO PORTE (EPP)' when 5 then 'DEMAIS' end "PORTE DA EMPRESA",
         case c_custkey % 7 when 0 then 'ATÉ 81 MIL' when 1 then 'ATÉ 360 MIL' when 3 then '360 MIL - 4,8 MILHOES'
              when 5 then 'MAIS DE 4,8 MILHOES' end "FATURAMENTO/ANO"
  from customer join nation on c_nationkey = n_nationkey
  where c_custkey % 60 in (select p_size from part))
"""
_PARTNERS = """
par as (
  select lpad(cast(user_id as varchar), 8, '0') "CNPJ BASICO",
         case when event_id % 5 <> 0 then props else '-' end "NOME SOCIO",
         '***' || event_id || '**' "CNPJ/CPF DO SOCIO",
         case when event_id % 9 = 1 then date '1900-01-01'
              when event_id % 9 > 2 then cast(ts as date) end "DT ENTRADA NA SOCIEDADE",
         case event_id % 55 % 10 when 0 then 'SOCIO-ADMINISTRADOR' when 1 then 'NAO INFORMADO'
              when 2 then 'NAO INFORMADO' when 3 then 'SOCIO PESSOA FISICA' when 4 then 'SECRETARIO'
              else 'DIRETOR ' || (event_id % 55) end "QUALIFICACAO DO SOCIO",
         case event_type when 'purchase' then 'PESSOA JURIDICA' when 'signup' then 'PESSOA FISICA'
              when 'error' then 'ESTRANGEIRO' end "TIPO SOCIO",
         case event_id % 11 when 0 then 'NÃO SE APLICA' when 1 then '0 - 12 ANOS' when 2 then '13 - 20 ANOS'
              when 3 then '21 - 30 ANOS' when 4 then '31 - 40 ANOS' when 5 then '41 - 50 ANOS'
              when 6 then '51 - 60 ANOS' when 7 then '61 - 70 ANOS' when 8 then '71 - 80 ANOS'
              when 9 then 'MAIS DE 80 ANOS' end "FAIXA ETARIA"
  from events where event_id % 55 in (select p_size from part))
"""
_ALL = f"with {_ESTABLISHMENTS}, {_COMPANIES}, {_PARTNERS} "
_MERGED = 'from est join com using ("CNPJ BASICO") join par using ("CNPJ BASICO")'


@registered(f"with {_ESTABLISHMENTS} select * from est")
def establishments_clean(t: StarSchema) -> DataFrame:
    return t.establishments


@registered(f"with {_COMPANIES} select * from com")
def companies_clean(t: StarSchema) -> DataFrame:
    return t.companies


@registered(f"with {_PARTNERS} select * from par")
def partners_clean(t: StarSchema) -> DataFrame:
    return t.partners


@registered("""
select lpad(cast(c_custkey as varchar), 8, '0') "CNPJ BASICO",
       case c_custkey % 3 when 0 then 'S' when 1 then 'N' else '-' end "OPCAO PELO MEI",
       case when c_custkey % 3 = 0 then date '2020-02-29' end "DATA DE OPCAO PELO MEI",
       case when c_custkey % 2 <> 0 then date '2021-12-31' end "DATA DE EXCLUSAO DO MEI"
from customer
""")
def regime_clean(t: StarSchema) -> DataFrame:
    return t.regime


def _merged(t: StarSchema) -> DataFrame:
    return op.consolidate(t.establishments, t.companies, t.partners, COMPANY_KEY, spread=SPREAD)


@registered(_ALL + "select * " + _MERGED)
def registry_consolidate(t: StarSchema) -> DataFrame:
    names = [*ESTABLISHMENT_COLUMNS, *COMPANY_COLUMNS[1:], *PARTNER_COLUMNS[1:]]
    return _merged(t).select(*cols(names))


@registered(
    _ALL
    + """
select "CNPJ", "RAZAO SOCIAL", "NOME SOCIO", "UF", "MUNICIPIO" from (
  select *, row_number() over (partition by "CNPJ" order by "NOME SOCIO", "CNPJ/CPF DO SOCIO", "CEP") rn
"""
    + _MERGED
    + " where \"UF\" = 'PR') where rn = 1"
)
def registry_state_extract(t: StarSchema) -> DataFrame:
    """Write the consolidation by state and city, read one state back, keep a row per establishment."""
    root = scratch_path(t.spark, "registry")
    names = ("establishments", "companies", "partners")
    frames = [staged(df, f"{root}-{name}") for name, df in zip(names, (t.establishments, t.companies, t.partners), strict=True)]
    merged = op.consolidate(*frames, COMPANY_KEY, spread=SPREAD)
    leaf_rows = op.consolidation_profile(*frames, COMPANY_KEY, PARTITION_COLUMNS, "CNPJ")
    write_partitioned(merged, root, PARTITION_COLUMNS, leaf_rows=leaf_rows)
    extract = state_extract(t.spark, root, "PR", ["NOME SOCIO", "CNPJ/CPF DO SOCIO", "CEP"])
    return extract.select("CNPJ", "RAZAO SOCIAL", "NOME SOCIO", "UF", "MUNICIPIO")


@registered(_ALL + 'select "UF", "MUNICIPIO", count(*) n_rows, count(distinct "CNPJ") n_est ' + _MERGED + " group by all")
def registry_profile(t: StarSchema) -> DataFrame:
    profile = op.consolidation_profile(
        t.establishments, t.companies, t.partners, COMPANY_KEY, PARTITION_COLUMNS, "CNPJ"
    )
    return profile.select(*PARTITION_COLUMNS, F.col("n_rows").cast("bigint"), "n_est")


@registered(
    f"with {_PARTNERS} select distinct \"QUALIFICACAO DO SOCIO\" from par"
)
def qualification_values(t: StarSchema) -> DataFrame:
    return op.distinct_values(t.partners, "QUALIFICACAO DO SOCIO")


@registered(
    f"with {_ESTABLISHMENTS} "
    + " union all ".join(
        f"select '{name}' col, count(*) filter (\"{name}\" is null) n_null from est" for name in ESTABLISHMENT_COLUMNS
    )
)
def establishments_null_audit(t: StarSchema) -> DataFrame:
    return op.null_audit(t.establishments)
