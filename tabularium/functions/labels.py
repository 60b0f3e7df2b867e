"""Numeric codes to labels."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The registry's code tables.
COMPANY_SIZES = {
    0: "MICROEMPREENDEDOR INDIVIDUAL (MEI)",
    1: "MICRO EMPRESA (ME)",
    3: "EMPRESA DE PEQUENO PORTE (EPP)",
    5: "DEMAIS",
}
REVENUE_BANDS = {
    0: "ATÉ 81 MIL",
    1: "ATÉ 360 MIL",
    3: "360 MIL - 4,8 MILHOES",
    5: "MAIS DE 4,8 MILHOES",
}
PARTNER_KINDS = {1: "PESSOA JURIDICA", 2: "PESSOA FISICA", 3: "ESTRANGEIRO"}
AGE_BANDS = {
    0: "NÃO SE APLICA",
    1: "0 - 12 ANOS",
    2: "13 - 20 ANOS",
    3: "21 - 30 ANOS",
    4: "31 - 40 ANOS",
    5: "41 - 50 ANOS",
    6: "51 - 60 ANOS",
    7: "61 - 70 ANOS",
    8: "71 - 80 ANOS",
    9: "MAIS DE 80 ANOS",
}


def label_code(col: Column, mapping: Mapping[object, str]) -> Column:
    """Label of each code; null for a null or unlisted code."""
    labels = None
    for code, label in mapping.items():
        labels = F.when(col == F.lit(code), label) if labels is None else labels.when(col == F.lit(code), label)
    return F.lit(None).cast("string") if labels is None else labels
