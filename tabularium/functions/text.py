"""Repair of text whose accented letters were lost, and folding of text that still has them."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

REPLACEMENT_CHAR = "�"


class Repair(NamedTuple):
    """Put ``right`` for ``damaged``: anywhere, only as a whole word, or only as the whole value."""

    damaged: str
    right: str
    where: str = "anywhere"


# Damaged spellings and what they stand for, applied in this order.
# Stems serve inflected forms too, so most rules work anywhere in the text; the few whose
# damaged form is part of sound words are tied to a whole word or a whole value.
STREET_TYPE_RULES = [
    Repair("STIO", "SITIO"),
    Repair("PRAA", "PRACA"),
    Repair("ESTNCIA", "ESTANCIA"),
    Repair("CHCARA", "CHACARA"),
    Repair("CRREGO", "CORREGO"),
    Repair("PTIO", "PATIO"),
    Repair("REA", "AREA", "word"),
    Repair("CALADA", "CALCADA"),
    Repair("LIGAO", "LIGACAO"),
    Repair("MDULO", "MODULO"),
    Repair("ESTAO", "ESTACAO"),
    Repair("CONDOMNIO", "CONDOMINIO"),
    Repair("COLNIA", "COLONIA"),
    Repair("VIRIO", "VIARIO"),
    Repair("NCLEO", "NUCLEO"),
    Repair("ROTATRIA", "ROTATORIA"),
]
LEGAL_NATURE_RULES = [
    Repair("Empresria", "EMPRESARIA"),
    Repair("Associao", "Associacao"),
    Repair("rgo", "Orgao", "word"),
    Repair("Direo", "Direcao"),
    Repair("Fundao", "Fundacao"),
    Repair("Condomnio", "Condominio"),
    Repair("Inovao", "Inovacao"),
    Repair("Pblico", "Publico"),
    Repair("Cartrio", "Cartorio"),
    Repair("Participao", "Participacao"),
    Repair("Consrcio", "Consorcio"),
    Repair("Annima", "Anonima"),
    Repair("Servio", "Servico"),
    Repair("Edilcio", "Edilicio"),
    Repair("Municpio", "Municipio"),
    Repair("Organizao", "Organizacao"),
    Repair("Jurdico", "Juridico"),
    Repair("Representao", "Representacao"),
    Repair("Fsica", "Fisica"),
    Repair("Judicirio", "Judiciario"),
    Repair("Comit", "Comite", "word"),
    Repair("Poltico", "Politico"),
]
QUALIFICATION_RULES = [
    Repair("Scio", "SOCIO"),
    Repair("nan", "NAO INFORMADO", "value"),
    Repair("No informada", "NAO INFORMADO"),
    Repair("Nao informada", "NAO INFORMADO"),
    Repair("Fsica", "FISICA"),
    Repair("Indstria", "INDUSTRIA"),
    Repair("Comanditrio", "COMANDITARIO"),
    Repair("jurdica", "JURIDICA"),
    Repair("Administrao", "Administracao"),
    Repair("Secretrio", "Secretario"),
]
COUNTRY_RULES = [Repair("COLIS POSTAUX", "BRASIL")]


def strip_undecodable(col: Column) -> Column:
    """Drop the mark that a wrong decoding leaves where a letter was."""
    return F.replace(col, F.lit(REPLACEMENT_CHAR), F.lit(""))


def _apply(col: Column, rule: Repair) -> Column:
    if rule.where == "anywhere":
        return F.replace(col, F.lit(rule.damaged), F.lit(rule.right))
    bounds = {"word": (r"\b", r"\b"), "value": (r"\A", r"\z")}[rule.where]
    right = rule.right.replace("\\", r"\\").replace("$", r"\$")
    return F.regexp_replace(col, bounds[0] + re.escape(rule.damaged) + bounds[1], right)


def repair_text(col: Column, rules: Iterable[Repair]) -> Column:
    """Drop undecodable marks, then apply ``rules`` in order, all in one expression.

    Rules that work anywhere are plain substring replacement, not regular expressions, which
    keeps a chain of a score of them cheap on the fact side.
    """
    return reduce(_apply, rules, strip_undecodable(col))


def _accent_table() -> tuple[str, str]:
    # Latin letters with a mark go to their base letter; loose combining marks go away, as
    # translate drops every character that has no counterpart.
    letters, bases = [], []
    for char in map(chr, range(0x00C0, 0x0180)):
        parts = unicodedata.normalize("NFD", char)
        if len(parts) > 1:
            letters.append(char)
            bases.append(parts[0])
    marks = [chr(c) for c in range(0x0300, 0x0370)]
    return "".join(letters + marks), "".join(bases)


_ACCENTED, _BASE = _accent_table()


def fold_accents(col: Column) -> Column:
    """Accented Latin letters to their base letters, in one pass; ``ß`` becomes ``ss``.

    Plain ASCII text, which has as many bytes as letters, is passed through as it is.
    """
    folded = F.translate(F.replace(col, F.lit("ß"), F.lit("ss")), _ACCENTED, _BASE)
    return F.when(F.octet_length(col) == F.char_length(col), col).otherwise(folded)


def clean_text(col: Column, rules: Iterable[Repair] = ()) -> Column:
    """Fold what was decoded well and repair what was not, so both arrive at one spelling."""
    return repair_text(fold_accents(col), rules)
