from __future__ import annotations

import json
import os
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tabularium import session as ses
from tabularium import sources as src

SCHEMA = "`k` bigint, `n` smallint, `name` string"


def write(path, text, encoding="ISO-8859-1"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_delimited_scan_of_several_latin_files(spark, tmp_path):
    a = write(tmp_path / "a.csv", '1;2;"PRAÇA; NOVA"\n2;S/N;""\n3;40000;x\n')
    b = write(tmp_path / "b.csv", "4;5\n6;7;y;extra\n")
    got = {r["k"]: (r["n"], r["name"]) for r in src.read_delimited(spark, [a, b], SCHEMA).collect()}
    assert got == {1: (2, "PRAÇA; NOVA"), 2: (None, None), 3: (None, "x"), 4: (5, None), 6: (7, "y")}
    one = src.read_delimited(spark, b, SCHEMA)
    assert one.count() == 2
    wrong = src.read_delimited(spark, a, SCHEMA, encoding="UTF-8")
    assert "�" in wrong.where("k = 1").first()["name"]


def test_rejected_rows_are_counted_per_file(spark, tmp_path):
    a = write(tmp_path / "a.csv", "1;2;x\n2;S/N;y\n3;40000;z\n")
    b = write(tmp_path / "b.csv", "4;5\n6;7;y;extra\n8;9;ok\n")
    df = src.read_delimited(spark, [a, b], SCHEMA, rejects=True)
    counts = {os.path.basename(r["file"]): (r["n_rows"], r["n_rejected"]) for r in src.reject_counts(df).collect()}
    assert counts == {"a.csv": (3, 2), "b.csv": (3, 2)}
    assert src.reject_counts(df).agg(F.sum("n_rejected")).first()[0] == 4
    lines = [r[src.REJECTED] for r in df.collect() if r[src.REJECTED]]
    assert sorted(lines) == ["2;S/N;y", "3;40000;z", "4;5", "6;7;y;extra"]


def test_a_missing_file_fails_the_scan(spark, tmp_path):
    a = write(tmp_path / "a.csv", "1;2;x\n")
    with pytest.raises(AnalysisException):
        src.read_delimited(spark, [a, str(tmp_path / "none.csv")], SCHEMA).collect()


def test_scan_reads_the_columns_it_needs_and_pushes_the_filter(spark, tmp_path, plan):
    a = write(tmp_path / "a.csv", "1;2;x\n")
    from tabularium import operators as op

    df = op.active_only(op.fill_text(src.read_delimited(spark, a, SCHEMA)), "n").select("name")
    text = plan(df)
    assert "ReadSchema: struct<n:smallint,name:string>" in text
    assert "PushedFilters: [IsNotNull(n), EqualTo(n,2)]" in text


def test_lookups(spark, tmp_path):
    city = write(tmp_path / "m.csv", "1;SANTA BÁRBARA D'OESTE\n2;A/B\n;none\n")
    got = src.read_lookup(spark, city, src.schemas.CITIES).collect()
    assert [tuple(r) for r in got] == [(1, "SANTA BÁRBARA D'OESTE"), (2, "A/B")]
    text = 'cnae,descricao,cod,setor\n0111301,"Cultivo de arroz, irrigado",A,Agro\n'
    path = write(tmp_path / "c.csv", text, "UTF-8")
    kept = src.read_lookup(spark, path, src.schemas.ACTIVITIES, sep=",", encoding="UTF-8").collect()
    assert [r[0] for r in kept] == ["cnae", "0111301"] and kept[1][1] == "Cultivo de arroz, irrigado"
    skipped = src.read_lookup(spark, path, src.schemas.ACTIVITIES, sep=",", encoding="UTF-8", header=True)
    assert [r[0] for r in skipped.collect()] == ["0111301"]


def test_headed_csv_is_all_text(spark, tmp_path):
    path = write(tmp_path / "h.csv", 'CNPJ,NOME FANTASIA\n007,"A ""B"", C"\n8,\n', "UTF-8")
    df = src.read_headed_csv(spark, path)
    assert {t for _, t in df.dtypes} == {"string"}
    assert [tuple(r) for r in df.collect()] == [("007", 'A "B", C'), ("8", None)]


def test_csv_sink_puts_the_key_first_and_arrays_as_json(spark, tmp_path):
    df = spark.createDataFrame([(["a", 'b "x"'], "n, 1\nn"), ([], "m")], "l array<string>, name string")
    path = str(tmp_path / "out")
    src.write_headed_csv(df, path, key="name")
    back = src.read_headed_csv(spark, path, multi_line=True)
    assert back.columns == ["name", "l"]
    assert {r["name"]: json.loads(r["l"]) for r in back.collect()} == {"n, 1\nn": ["a", 'b "x"'], "m": []}
    with pytest.raises(AnalysisException):
        src.write_headed_csv(df, path, key="name")


@pytest.fixture
def places(spark):
    data = [("PR", "007", 1), ("PR", "A/B", 2), ("SP", "007", 3), (None, "-", 4)]
    return spark.createDataFrame(data, "UF string, MUNICIPIO string, v int")


PLACES = ["UF", "MUNICIPIO"]


def bag(df):
    return Counter(tuple(r) for r in df.select("v", *PLACES).collect())


def test_writing_twice_is_writing_once_unless_appending(spark, places, tmp_path):
    path = str(tmp_path / "t")
    text = "v int, UF string, MUNICIPIO string"
    for _ in range(2):
        src.write_partitioned(places, path, PLACES)
    back = src.read_partition(spark, path, text)
    assert back.columns == ["v", "UF", "MUNICIPIO"] and bag(back) == bag(places)
    src.write_partitioned(places.where("UF = 'SP'").withColumn("v", F.lit(9)), path, PLACES)
    assert sorted(r["v"] for r in spark.read.schema(text).parquet(path).collect()) == [1, 2, 4, 9]
    src.write_partitioned(places, path, PLACES, mode="append")
    assert spark.read.schema(text).parquet(path).count() == 8
    src.write_partitioned(places.limit(1), path, PLACES, mode="overwrite")
    assert spark.read.schema(text).parquet(path).count() == 1


def test_partition_folders(spark, places, tmp_path):
    path = str(tmp_path / "t")
    src.write_partitioned(places, path, PLACES)
    folders = {f"{d}/{c}" for d in os.listdir(path) if "=" in d for c in os.listdir(f"{path}/{d}") if "=" in c}
    assert folders == {
        "UF=PR/MUNICIPIO=007", "UF=PR/MUNICIPIO=A%2FB", "UF=SP/MUNICIPIO=007",
        "UF=__HIVE_DEFAULT_PARTITION__/MUNICIPIO=-"}
    assert all(len([f for f in os.listdir(f"{path}/{x}") if f.endswith(".parquet")]) == 1 for x in folders)


def test_reading_one_partition(spark, places, tmp_path, plan):
    path = str(tmp_path / "t")
    src.write_partitioned(places, path, PLACES)
    one = src.read_partition(spark, path, UF="PR")
    assert sorted(r["v"] for r in one.collect()) == [1, 2]
    assert "PartitionFilters: [isnotnull(UF" in plan(one)
    assert [r["v"] for r in src.read_partition(spark, path, UF=None).collect()] == [4]
    two = src.read_partition(spark, path, "v int, UF string, MUNICIPIO string", UF="PR", MUNICIPIO="007")
    assert [tuple(r) for r in two.collect()] == [(1, "PR", "007")]


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("leaves", [50, 500, 501, 1500])
def test_a_large_leaf_is_written_by_several_tasks(spark, tmp_path, leaves, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(20000, numPartitions=12).select(
            F.when(F.col("id") % 3 == 0, "BIG").otherwise((F.col("id") % leaves).cast("string")).alias("c"),
            F.lit("same").alias("v"))
        path = str(tmp_path / "t")
        counts = df.groupBy("c").agg(F.count("*").alias("n_rows"))
        src.write_partitioned(df, path, "c", rows_per_file=1200, leaf_rows=counts if leaves == 500 else None)
        files = {d: len([f for f in os.listdir(f"{path}/{d}") if f.endswith(".parquet")]) for d in os.listdir(path) if "=" in d}
        assert files["c=BIG"] > 3 and max(n for d, n in files.items() if d != "c=BIG") == 1
        assert spark.read.schema("v string, c string").parquet(path).count() == 20000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_records_per_file(spark, tmp_path):
    path = str(tmp_path / "t")
    src.write_partitioned(spark.range(100).withColumn("c", F.lit("x")), path, "c", max_records_per_file=10)
    assert len([f for f in os.listdir(f"{path}/c=x") if f.endswith(".parquet")]) == 10


def test_catalog_table(spark, places, tmp_path):
    spark.sql("drop table if exists places_saved")
    src.save_table(places, "places_saved", PLACES, path=str(tmp_path / "saved"))
    assert spark.sql("select count(*) from places_saved where UF = 'PR'").first()[0] == 2
    src.save_table(places, "places_saved", PLACES, mode="append", path=str(tmp_path / "saved"))
    assert spark.table("places_saved").count() == 8
    with pytest.raises(AnalysisException):
        src.save_table(places, "places_saved", PLACES)
    spark.sql("drop table places_saved")


def test_file_inventory(spark, tmp_path):
    a = write(tmp_path / "a.csv", "1;2;x\n2;3;y\n")
    b = write(tmp_path / "b.csv", "4;5;z\n")
    files = {os.path.basename(r["file"]): (r["bytes"], r["n_rows"])
             for r in src.file_inventory(src.read_delimited(spark, [a, b], SCHEMA)).collect()}
    assert files == {"a.csv": (12, 2), "b.csv": (6, 1)}
    listed = src.list_files(spark, str(tmp_path), "*.csv")
    assert sorted((os.path.basename(r["file"]), r["bytes"]) for r in listed.collect()) == [("a.csv", 12), ("b.csv", 6)]
    assert src.list_files(spark, str(tmp_path)).count() == 2


def test_parquet_inventory_reads_no_column(spark, tmp_path, plan):
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([("x", 1), ("y", 1), ("z", 2)], "s string, p int").coalesce(1).write.partitionBy("p").parquet(str(tmp_path / "b"))
    found = src.parquet_inventory(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert sorted(r["n_rows"] for r in found.collect()) == [1, 2, 7]
    assert "ReadSchema: struct<>" in plan(found)


def rows_scanned(df):
    """Rows that the scan hands on, after its own pruning."""
    executed = df.select("*")._jdf.queryExecution().executedPlan()  # fresh metrics
    executed.executeCollectPublic()
    return executed.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_read_keys_reads_few_rows(spark, tmp_path):
    people = spark.range(200_000).selectExpr("id % 2 as `the part`", "concat('k', xxhash64(id)) as `a key`", "id")
    people = people.repartition(4, "id")
    plain, sorted_ = str(tmp_path / "plain"), str(tmp_path / "sorted")
    src.write_partitioned(people, plain, "the part")
    src.write_partitioned(people, sorted_, "the part", lookup="a key")
    keys = [r["a key"] for r in people.where("id in (5, 77777, 123456)").collect()]
    few, all_ = (src.read_keys(spark, p, "a key", [*keys, None, keys[0]]) for p in (sorted_, plain))
    assert sorted(r["id"] for r in few.collect()) == [5, 77777, 123456] == sorted(r["id"] for r in all_.collect())
    assert rows_scanned(few) < 0.6 * rows_scanned(all_)
    absent = src.read_keys(spark, sorted_, "a key", ["k5x"])
    assert rows_scanned(absent) == 0 and rows_scanned(src.read_keys(spark, plain, "a key", ["k5x"])) > 0
    assert rows_scanned(src.read_keys(spark, sorted_, "a key", keys[:1], **{"the part": 1})) <= rows_scanned(few)
    assert src.read_keys(spark, sorted_, "a key", []).count() == 0
    many = [r["a key"] for r in people.where("id < 35").collect()]
    assert src.read_keys(spark, sorted_, "a key", many).count() == 35


def test_published_tables_can_be_written_for_look_ups(spark, tmp_path):
    rows = spark.range(50_000).selectExpr("id % 2 as p", "concat('k', xxhash64(id)) as k", "id")
    root = str(tmp_path / "t")
    src.publish(rows, root, "p", lookup=["k"])
    key = rows.where("id = 4321").first()["k"]
    found = src.read_snapshot(spark, root).where(F.col("k") == key)
    assert [r["id"] for r in found.collect()] == [4321] and rows_scanned(found) < 25_000


def test_sessions(spark):
    other = ses.new_session("other", {"spark.sql.shuffle.partitions": "77", "spark.driver.memory": "1g"})
    assert other is not spark and other.sparkContext is spark.sparkContext
    assert other.conf.get("spark.sql.shuffle.partitions") == "77" and spark.conf.get("spark.sql.shuffle.partitions") == "8"
    other.sql("select 1 as x").createOrReplaceTempView("only_here")
    assert not spark.catalog.tableExists("only_here")
    spark.range(1).count()


def test_scratch_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = ses.scratch_path(spark, "x"), ses.scratch_path(spark, "x")
    assert one.startswith(f"{base}/x-") and one != two


def session_with(**settings):
    """A session of which only the settings are looked at."""
    names = {"master": "spark.master", "warehouse": "spark.sql.warehouse.dir", "shared": "spark.checkpoint.dir"}
    held = {names[k]: v for k, v in settings.items()}

    class Session:
        class conf:
            get = staticmethod(lambda name, *default: held[name] if name in held or not default else default[0])

    return Session


def test_without_the_setting_scratch_is_in_the_warehouse():
    assert ses.scratch_path(session_with(warehouse="hdfs://x/warehouse", master="yarn"), "x").startswith("hdfs://x/warehouse/_scratch/x-")
    assert ses.scratch_path(session_with(warehouse="file:/w", master="local[8]"), "x").startswith("file:/w/_scratch/x-")


@pytest.mark.parametrize("warehouse", ["file:/home/me/spark-warehouse", "/home/me/spark-warehouse", "file:///w"])
@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://https://x"])
def test_a_local_warehouse_is_no_shared_folder_on_a_cluster(warehouse, master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ses.scratch_path(session_with(warehouse=warehouse, master=master), "x")
    assert ses.scratch_path(session_with(warehouse=warehouse, master=master, shared="hdfs://x/c/"), "x").startswith("hdfs://x/c/x-")
