"""Registry-shaped tables derived from a star schema of orders, customers and events.

The registered queries have no registry dumps to read, so they see orders as establishments,
customers as companies, events as partners, nations as cities, countries and legal natures, and
parts as activities and qualifications. Missing values, unreadable dates and damaged text are
planted on the way, so that the clean-up has something to do on every table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.plans import registry
from tabularium.sources import schemas

# Street types as they arrive, whole or damaged, per order priority.
STREET_TYPES = {
    "1-URGENT": "PRAÇA",
    "2-HIGH": "ESTA��O",
    "3-MEDIUM": "ÁREA",
    "4-NOT SPECIFIED": "S�TIO",
}
# Qualifications as they arrive, by last digit of the code; other digits read "Diretor <code>".
QUALIFICATIONS = {
    0: "S�cio-Administrador",
    1: "Não informada",
    2: "nan",
    3: "Sócio Pessoa Física",
    4: "Secret�rio",
}
# Legal natures as they arrive, by last digit of the code; other digits read "Natureza <code>".
LEGAL_NATURES = {
    0: "Sociedade Empres�ria Limitada",
    1: "Órgão Público",
    2: "�rg�o P�blico",
    3: "Funda��o Privada",
    4: "Cargo em Comissão",
}
STATES = {0: "PR", 1: "SP", 2: "RJ", 3: "MG"}
PARTNER_KINDS = {"purchase": 1, "signup": 2, "error": 3, "view": 4}


def _text(c: Column) -> Column:
    return c.cast("string")


def _pick(c: Column, values: dict, otherwise: Column | None = None) -> Column:
    out = None
    for key, value in values.items():
        out = F.when(c == key, value) if out is None else out.when(c == key, value)
    return out if otherwise is None else out.otherwise(otherwise)


def _as(df: DataFrame, schema: str, values: dict[str, Column]) -> DataFrame:
    """Columns of ``schema`` in order; a value that does not fit its type is null, as in a file scan."""
    missing = F.lit(None)
    return df.select(
        *[_text(values.get(f.name, missing)).try_cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema)]
    )


@dataclass(frozen=True)
class StarSchema:
    """The star schema's Parquet files in ``folder`` seen as registry tables."""

    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @property
    def raw_establishments(self) -> DataFrame:
        key, owner = F.col("o_orderkey"), F.col("o_custkey")
        start = (
            F.when(key % 10 == 0, "00000000")
            .when(key % 10 == 2, "18900101")
            .when(key % 10 != 1, F.date_format("o_orderdate", "yyyyMMdd"))
        )
        return _as(
            self.table("orders"),
            schemas.ESTABLISHMENTS,
            {
                "CNPJ BASICO": owner,
                "CNPJ ORDEM": key % 10000,
                "CNPJ DV": key % 97,
                "IDENTIFICADOR MATRIZ FILIAL": F.lit(1),
                "NOME FANTASIA": F.when(key % 6 != 0, F.concat(F.lit("Loja "), _text(key))),
                "SIT CADASTRAL": _pick(F.col("o_orderstatus"), {"F": 2, "O": 8}),
                "CODIGO_PAIS": F.when(key % 3 != 0, owner % 30 + 100),
                "INICIO ATIVIDADE": start,
                "CNAE PRINCIPAL": F.lpad(_text(key % 3000), 7, "0"),
                "TIPO LOGRADOURO": _pick(F.col("o_orderpriority"), STREET_TYPES),
                "LOGRADOURO": F.concat(F.lit('das "Flores"; '), _text(owner)),
                "NUMERO": F.when(key <= 32767, key),
                "CEP": F.when(key % 13 != 0, key + 80000000),
                "UF": _pick(owner % 5, STATES),
                "CODIGO_MUNICIPIO": owner % 25,
                "DDD": F.lit(41),
                "TELEFONE": key + 30000000,
                "EMAIL": F.when(key % 4 != 0, F.concat(F.lit("loja"), _text(key), F.lit("@exemplo.com"))),
            },
        )

    @property
    def raw_companies(self) -> DataFrame:
        key = F.col("c_custkey")
        return _as(
            self.table("customer"),
            schemas.COMPANIES,
            {
                "CNPJ BASICO": key,
                "RAZAO SOCIAL": F.when(key % 11 != 0, F.col("c_name")),
                "COD NATUREZA JURIDICA": F.col("c_nationkey") + 2000,
                "COD QUALIFICACAO SOCIO": key % 60,
                "CAPITAL SOCIAL": F.concat(_text(F.floor("c_acctbal")), F.lit(",00")),
                "COD PORTE DA EMPRESA": F.when(key % 7 != 6, key % 7),
            },
        )

    @property
    def raw_partners(self) -> DataFrame:
        key = F.col("event_id")
        entry = (
            F.when(key % 9 == 0, "00000000")
            .when(key % 9 == 1, "18500101")
            .when(key % 9 != 2, F.date_format("ts", "yyyyMMdd"))
        )
        return _as(
            self.table("events"),
            schemas.PARTNERS,
            {
                "CNPJ BASICO": F.col("user_id"),
                "ID DO SOCIO": _pick(F.col("event_type"), PARTNER_KINDS),
                "NOME SOCIO": F.when(key % 5 != 0, F.col("props")),
                "CNPJ/CPF DO SOCIO": F.concat(F.lit("***"), _text(key), F.lit("**")),
                "COD QUALIFICACAO SOCIO": key % 55,
                "DT ENTRADA NA SOCIEDADE": entry,
                "COD FAIXA ETARIA": key % 11,
            },
        )

    @property
    def raw_regime(self) -> DataFrame:
        key = F.col("c_custkey")
        return _as(
            self.table("customer"),
            schemas.REGIME,
            {
                "CNPJ BASICO": key,
                "OPCAO PELO MEI": _pick(key % 3, {0: "S", 1: "N"}),
                "DATA DE OPCAO PELO MEI": F.when(key % 3 == 0, "20200229").when(key % 3 == 1, "20200230"),
                "DATA DE EXCLUSAO DO MEI": F.when(key % 2 == 0, "00000000").otherwise("20211231"),
            },
        )

    @property
    def raw_countries(self) -> DataFrame:
        key = F.col("n_nationkey")
        name = F.when(key == 5, "COLIS POSTAUX").otherwise(F.col("n_name"))
        return _as(self.table("nation"), schemas.COUNTRIES, {"CODIGO_PAIS": key + 100, "PAIS": name})

    @property
    def raw_cities(self) -> DataFrame:
        values = {"CODIGO_MUNICIPIO": F.col("n_nationkey"), "MUNICIPIO": F.col("n_name")}
        return _as(self.table("nation"), schemas.CITIES, values)

    @property
    def raw_activities(self) -> DataFrame:
        return _as(
            self.table("part"),
            schemas.ACTIVITIES,
            {
                "CNAE PRINCIPAL": F.lpad(_text(F.col("p_partkey")), 7, "0"),
                "DESCRICAO": F.col("p_name"),
                "COD SETOR": F.col("p_brand"),
                "SETOR": F.col("p_type"),
            },
        )

    @property
    def raw_legal_natures(self) -> DataFrame:
        key = F.col("n_nationkey") + 2000
        name = _pick(key % 10, LEGAL_NATURES, F.concat(F.lit("Natureza "), _text(key)))
        return _as(
            self.table("nation"), schemas.LEGAL_NATURES, {"COD NATUREZA JURIDICA": key, "NATUREZA JURIDICA": name}
        )

    @property
    def raw_qualifications(self) -> DataFrame:
        key = F.col("p_size")
        name = _pick(key % 10, QUALIFICATIONS, F.concat(F.lit("Diretor "), _text(key)))
        return _as(
            self.table("part").select("p_size").distinct(),
            schemas.QUALIFICATIONS,
            {"COD QUALIFICACAO SOCIO": key, "QUALIFICACAO DO SOCIO": name},
        )

    @cached_property
    def establishments(self) -> DataFrame:
        return registry.establishments(
            self.raw_establishments, self.raw_countries, self.raw_cities, self.raw_activities, address_lines=False
        )

    @cached_property
    def companies(self) -> DataFrame:
        return registry.companies(self.raw_companies, self.raw_qualifications, self.raw_legal_natures)

    @cached_property
    def partners(self) -> DataFrame:
        return registry.partners(self.raw_partners, self.raw_qualifications)

    @property
    def regime(self) -> DataFrame:
        return registry.regime(self.raw_regime)
