from __future__ import annotations

import json

from pyspark.sql import functions as F

from tabularium import functions as fn
from tabularium import plans
from tabularium import sources as src
from test_columns import block, page


def found(df):
    return {r["NOME_EMPRESA"]: (r["tel"], r["link"], r["descricao"]) for r in df.collect()}


def test_whole_lookup(spark, tmp_path):
    (tmp_path / "c.csv").write_text(
        "CNPJ,NOME FANTASIA,MUNICIPIO,UF\n"
        "1,ALFA,LONDRINA,PR\n"
        "1,OUTRA,LONDRINA,PR\n"
        '2,"BETA, FILIAL",MARINGA,PR\n'
        "3,GAMA,,PR\n"
        "4,ALFA,MARINGA,PR\n"
        "5,DELTA,LONDRINA,PR\n"
        "6,EPSILON,LONDRINA,PR\n"
    )
    companies = src.read_headed_csv(spark, str(tmp_path / "c.csv")).withColumn(
        "line", F.monotonically_increasing_id()
    )
    pages = spark.createDataFrame(
        [
            (1, "ALFA, LONDRINA - PR", page(block("http://old", "velha"), block("x", "x"))),
            (2, "ALFA, MARINGA - PR", page(block("http://a", "um"), block("http://b"), block(None, "tres"), block("z", "z"), phones=["11", "22"])),
            (3, "BETA, FILIAL, MARINGA - PR", page(block("http://beta", "b &amp; c"), block("z", "z"))),
            (4, "DELTA, LONDRINA - PR", page(block("http://first", "1"), block("z", "z"))),
            (5, "DELTA, LONDRINA - PR", page(phones=["33"])),
            (6, None, page(block("http://null", "1"), block("z", "z"))),
        ],
        "page_id long, query string, html string",
    )
    results = plans.page_results(pages, ["query", "page_id"])
    got = found(plans.enrich(companies, results, ["line"]))
    assert got == {
        "ALFA": ("11", ["http://a", "http://b", None], ["um", None, "tres"]),
        "BETA": (fn.NO_PHONE, ["http://beta"], ["b & c"]),
        "DELTA": ("33", [], []),
        "EPSILON": (fn.NO_PHONE, [], []),
    }

    assert tuple(plans.unsearchable(companies).first()) == (1, 1)
    whole = str(tmp_path / "whole")
    plans.enrich_files(spark, str(tmp_path / "c.csv"), pages, whole)
    read = {r["NOME_EMPRESA"]: r for r in src.read_headed_csv(spark, whole).collect()}
    assert set(read) == set(got) and json.loads(read["ALFA"]["descricao"]) == ["um", None, "tres"]

    out = str(tmp_path / "out")
    src.write_headed_csv(plans.enrich(companies, results, ["line"]), out, key="NOME_EMPRESA")
    back = {r["NOME_EMPRESA"]: r for r in src.read_headed_csv(spark, out).collect()}
    assert json.loads(back["ALFA"]["link"]) == ["http://a", "http://b", None]
    assert back["EPSILON"]["tel"] == fn.NO_PHONE and json.loads(back["EPSILON"]["descricao"]) == []


def test_pages_are_reduced_before_they_are_shuffled(spark, plan, tmp_path):
    companies = spark.createDataFrame([("1", "A", "B", "PR")], "CNPJ string, `NOME FANTASIA` string, MUNICIPIO string, UF string")
    spark.createDataFrame([(1, "A, B - PR", "<html>")], "page_id long, query string, html string").write.parquet(str(tmp_path / "p"))
    results = plans.page_results(spark.read.parquet(str(tmp_path / "p")), ["query", "page_id"])
    df = plans.enrich(companies, results, ["CNPJ"])
    exchanges = [b for b in plan(df).split("\n\n") if "Exchange\n" in b]
    assert exchanges and all("html" not in b for b in exchanges)
