"""Raw registry tables to clean ones. Each function takes frames and returns a lazy frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium import functions as fn
from tabularium.operators.clean import active_only, drop_missing, fill_code, fill_text
from tabularium.operators.lookups import join_lookup, join_lookups, keep_known
from tabularium.operators.names import col, cols

# The columns each clean table is delivered with.
ESTABLISHMENT_COLUMNS = [
    "CNPJ", "CNPJ BASICO", "CNPJ ORDEM", "CNPJ DV", "NOME FANTASIA", "INICIO ATIVIDADE",
    "CNAE PRINCIPAL", "CNAE SEGUNDARIO", "TIPO LOGRADOURO", "LOGRADOURO", "NUMERO", "COMPLEMENTO",
    "BAIRRO", "CEP", "UF", "DDD", "TELEFONE", "EMAIL", "ANO INICIO ATIVIDADE",
    "MES INICIO ATIVIDADE", "PAIS", "MUNICIPIO", "DESCRICAO", "SETOR", "CNAE DESCRICAO",
]
COMPANY_COLUMNS = [
    "CNPJ BASICO", "RAZAO SOCIAL", "CAPITAL SOCIAL", "NATUREZA JURIDICA", "PORTE DA EMPRESA",
    "FATURAMENTO/ANO",
]
PARTNER_COLUMNS = [
    "CNPJ BASICO", "NOME SOCIO", "CNPJ/CPF DO SOCIO", "DT ENTRADA NA SOCIEDADE",
    "QUALIFICACAO DO SOCIO", "TIPO SOCIO", "FAIXA ETARIA",
]
# The two display lines that can be added to establishments.
ADDRESS_COLUMNS = ["ENDERECO", "LOCALIDADE"]


def countries(raw: DataFrame) -> DataFrame:
    return raw.withColumn("PAIS", fn.repair_text(F.col("PAIS"), fn.COUNTRY_RULES))


def cities(raw: DataFrame) -> DataFrame:
    return raw


def activities(raw: DataFrame) -> DataFrame:
    return raw.withColumn("DESCRICAO", F.upper("DESCRICAO"))


def legal_natures(raw: DataFrame) -> DataFrame:
    name = col("NATUREZA JURIDICA")
    return raw.withColumn("NATUREZA JURIDICA", F.upper(fn.clean_text(name, fn.LEGAL_NATURE_RULES)))


def qualifications(raw: DataFrame) -> DataFrame:
    """Partner qualifications, repaired the same way for every table that uses them."""
    name = col("QUALIFICACAO DO SOCIO")
    return raw.withColumn("QUALIFICACAO DO SOCIO", F.upper(fn.clean_text(name, fn.QUALIFICATION_RULES)))


def establishments(
    raw: DataFrame,
    country_lookup: DataFrame,
    city_lookup: DataFrame,
    activity_lookup: DataFrame,
    how: str = "inner",
    floor_mode: str = "clamp",
    address_lines: bool = False,
) -> DataFrame:
    """Active establishments with key, dates, street type, country, city and activity.

    Text is filled before rows are dropped, so a missing trade name is ``-`` and only a missing
    postal code drops a row. Year and month are those of the date before it is floored. With
    ``how="inner"`` a code that its lookup does not list drops the row.
    """
    df = fill_code(active_only(fill_text(raw), "SIT CADASTRAL"), "CODIGO_PAIS")
    df = drop_missing(df, ["NOME FANTASIA", "CEP"])
    start = F.col("__start")
    df = df.withColumn("__start", fn.parse_date(col("INICIO ATIVIDADE"))).withColumns(
        {
            "CNPJ": fn.compose_key(cols(["CNPJ BASICO", "CNPJ ORDEM", "CNPJ DV"])),
            "CNPJ BASICO": fn.pad_key(col("CNPJ BASICO"), 8),
            "CNPJ ORDEM": fn.pad_key(col("CNPJ ORDEM"), 4),
            "CNPJ DV": fn.pad_key(col("CNPJ DV"), 2),
            "EMAIL": F.upper("EMAIL"),
            "INICIO ATIVIDADE": fn.floor_date(start, mode=floor_mode),
            "ANO INICIO ATIVIDADE": fn.year_of(start),
            "MES INICIO ATIVIDADE": fn.month_of(start),
            "TIPO LOGRADOURO": fn.clean_text(col("TIPO LOGRADOURO"), fn.STREET_TYPE_RULES),
        }
    )
    df = join_lookups(
        df,
        [
            (countries(country_lookup), "CODIGO_PAIS"),
            (cities(city_lookup), "CODIGO_MUNICIPIO"),
            (activities(activity_lookup), "CNAE PRINCIPAL"),
        ],
        how,
    )
    df = df.withColumn("CNAE DESCRICAO", fn.activity_label(col("CNAE PRINCIPAL"), col("DESCRICAO")))
    names = list(ESTABLISHMENT_COLUMNS)
    if address_lines:
        names += ADDRESS_COLUMNS
        df = df.withColumns(
            {
                "ENDERECO": fn.address_line(*cols(["TIPO LOGRADOURO", "LOGRADOURO", "NUMERO"])),
                "LOCALIDADE": fn.place_line(col("MUNICIPIO"), col("UF")),
            }
        )
    return df.select(*cols(names))


def companies(
    raw: DataFrame, qualification_lookup: DataFrame, nature_lookup: DataFrame, how: str = "inner"
) -> DataFrame:
    """Companies of known qualification with legal nature, size label and revenue band."""
    df = fill_text(raw)
    if how == "inner":
        df = keep_known(df, qualification_lookup, "COD QUALIFICACAO SOCIO")
    df = fill_text(join_lookup(df, legal_natures(nature_lookup), "COD NATUREZA JURIDICA", how))
    size = col("COD PORTE DA EMPRESA")
    df = df.withColumns(
        {
            "CNPJ BASICO": fn.pad_key(col("CNPJ BASICO"), 8),
            "PORTE DA EMPRESA": fn.label_code(size, fn.COMPANY_SIZES),
            "FATURAMENTO/ANO": fn.label_code(size, fn.REVENUE_BANDS),
        }
    )
    return df.select(*cols(COMPANY_COLUMNS))


def partners(
    raw: DataFrame, qualification_lookup: DataFrame, how: str = "inner", floor_mode: str = "clamp"
) -> DataFrame:
    """Partners with qualification, entry date, kind and age band."""
    df = join_lookup(fill_text(raw), qualifications(qualification_lookup), "COD QUALIFICACAO SOCIO", how)
    entry = fn.parse_date(col("DT ENTRADA NA SOCIEDADE"))
    df = df.withColumns(
        {
            "CNPJ BASICO": fn.pad_key(col("CNPJ BASICO"), 8),
            "DT ENTRADA NA SOCIEDADE": fn.floor_date(entry, mode=floor_mode),
            "TIPO SOCIO": fn.label_code(col("ID DO SOCIO"), fn.PARTNER_KINDS),
            "FAIXA ETARIA": fn.label_code(col("COD FAIXA ETARIA"), fn.AGE_BANDS),
        }
    )
    return df.select(*cols(PARTNER_COLUMNS))


def regime(raw: DataFrame) -> DataFrame:
    """Companies of the simplified tax regime with the dates they joined and left."""
    return fill_text(raw).withColumns(
        {
            "CNPJ BASICO": fn.pad_key(col("CNPJ BASICO"), 8),
            "DATA DE OPCAO PELO MEI": fn.parse_date(col("DATA DE OPCAO PELO MEI")),
            "DATA DE EXCLUSAO DO MEI": fn.parse_date(col("DATA DE EXCLUSAO DO MEI")),
        }
    )
