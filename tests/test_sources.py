import hashlib
import os

from obsframe.sources import (
    flatten_nested, flatten_paged, grapher_to_long, manifest, read_csv_strings, write_csv, write_warehouse,
)
from obsframe.sources.registry import SourceSpec, indicators_long
from tests.conftest import SF_SMALL


def test_csv_roundtrip_all_strings(spark, tmp_path):
    df = spark.createDataFrame([("PER", "2020", "1.5"), ("FRA", "", "NA")], "c string, year string, v string")
    out = str(tmp_path / "x")
    write_csv(df, out, single_file=True)
    back = read_csv_strings(spark, out)
    assert back.columns == ["c", "year", "v"] and all(t == "string" for _, t in back.dtypes)
    assert back.count() == 2


def test_grapher_csv_to_long(spark, tmp_path):
    p = tmp_path / "g.csv"
    p.write_text('Entity,Code,Year,Life\n"Peru, Republic",PER,2020,74.1\nPeru,PER,1899,70\n'
                 "Peru,PER,20x1,71\nPeru,PER,2021,NA\nFrance,FRA,2020,82\n")
    out = grapher_to_long(read_csv_strings(spark, str(p)), "PER", "OWID", "le", "le", "life", "Peru").collect()
    assert sorted((r.year, r.value) for r in out) == [(2020, 74.1), (2021, None)]


def test_flatten_paged_and_nested(spark):
    pages = spark.createDataFrame([('[{"total":2,"per_page":50},[{"date":"2020","value":1.5},{"date":"2021","value":null}]]',),
                                   ('[{"total":0}, null]',)], "json string")
    assert sorted((r.date, r.value) for r in flatten_paged(pages).collect()) == [("2020", 1.5), ("2021", None)]
    docs = spark.createDataFrame([('{"values":{"NGDPD":{"PER":{"2020":1.0,"2021":2.0}}}}',)], "json string")
    got = sorted((r.code, r.country, r.year, r.value) for r in flatten_nested(docs).collect())
    assert got == [("NGDPD", "PER", 2020, 1.0), ("NGDPD", "PER", 2021, 2.0)]


def test_manifest_sha256(spark):
    m = {r.logical: r for r in manifest(spark, SF_SMALL, "*.parquet").collect()}
    path = os.path.join(SF_SMALL, "region.parquet")
    assert m["region"].sha256 == hashlib.sha256(open(path, "rb").read()).hexdigest()
    assert m["region"].size == os.path.getsize(path)


def test_registry_and_partitioned_warehouse(spark, tmp_path):
    wide = spark.createDataFrame([("PER", 2020, 1.0, None), ("PER", 2021, 2.0, 3.0)],
                                 "country string, year int, gdp double, `NY.X` double")
    suffixed = spark.createDataFrame([("PER", 0.7, 0.71, 5.0)], "country string, hdi_2020 double, hdi_2021 double, hdi_rank double")
    specs = [SourceSpec("panel", lambda s: wide, "wide_year", {"source": "WB", "dataset": "P", "entity": "country", "year": "year"}),
             SourceSpec("hdi", lambda s: suffixed, "wide_year_suffixed", {"source": "UNDP", "dataset": "HDI", "entity": "country"})]
    long = indicators_long(spark, specs)
    assert long.count() == 6
    out = str(tmp_path / "wh")
    write_warehouse(long, out)
    assert {"source=UNDP", "source=WB"} <= set(os.listdir(out))
    back = spark.read.parquet(out).filter("source = 'UNDP'")
    assert "PartitionFilters: [isnotnull(source" in back._jdf.queryExecution().executedPlan().toString()
    assert back.count() == 2


def test_sinks_and_folder_load(spark, tmp_path):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    from obsframe.sources import load_folder, save_model, write_report
    df = spark.createDataFrame([(None, 2), ("b", 1), ("a", 3)], "e string, n int")
    out = str(tmp_path / "sorted")
    write_csv(df, out, single_file=True, order_by=["e"])
    assert [r.e for r in read_csv_strings(spark, out).collect()] == ["a", "b", None]
    write_report(df, str(tmp_path / "rep"), run_ts="2024-01-01 00:00:00")
    write_report(df, str(tmp_path / "rep"))
    assert spark.read.json(str(tmp_path / "rep")).count() == 6
    folder = tmp_path / "tables"
    folder.mkdir()
    df.write.parquet(str(folder / "good.parquet"))
    (folder / "bad.parquet").write_text("not parquet")
    tables, alerts = load_folder(spark, str(folder))
    assert list(tables) == ["good"]
    assert [(r.severity, r.category, r.table_name) for r in alerts.collect()] == [("CRITICAL", "LOAD", "bad")]
    data = VectorAssembler(inputCols=["n"], outputCol="features").transform(
        spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 6.0)], "n double, y double"))
    model = LinearRegression(labelCol="y").fit(data)
    save_model(model, str(tmp_path / "model"))
    assert os.path.isdir(str(tmp_path / "model" / "metadata"))


def test_manifest_reads_large_files_in_pieces(spark):
    whole = {r.raw: r for r in manifest(spark, SF_SMALL, "*.parquet", {"orders": "facts"}, "given").collect()}
    pieces = {r.raw: r for r in manifest(spark, SF_SMALL, "*.parquet", {"orders": "facts"}, "given", whole_file_bytes=0).collect()}
    assert whole == pieces and {r.source for r in whole.values()} == {"given"}
    assert {r.logical: r.type for r in whole.values()}["orders"] == "facts"
