import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.columns import round_to, signif, snake_case
from obsframe.plans import etl
from obsframe.plans import testdata as td
from obsframe.sources import normalise_long, read_csv_strings
from obsframe.sources.registry import SourceSpec
from obsframe.streaming import ingest_files
from tests.conftest import SF_SMALL


def test_etl_writes_every_zone(spark, tmp_path):
    out_dir = str(tmp_path / "wh")
    tables = etl.run(spark, td.source_specs(SF_SMALL), out_dir, prices=td.price_fact(spark, SF_SMALL),
                     subject=td.SUBJECT_NATION, rules=[{"check": "not_null", "columns": ["year"]}])
    for sub in ("staging/indicators_long", "clean/indicators_clean", "marts/mart_macro_wide",
                "marts/mart_banks_macro", "checks/validation"):
        assert len(glob.glob(os.path.join(out_dir, "versions", "*", sub))) == 1
    assert tables["indicators_clean"].count() <= tables["indicators_long"].count()
    assert "total" in tables["mart_macro_wide"].columns         # the subject's only code
    assert spark.sql("SELECT count(*) FROM v_bank_annual").first()[0] > 0
    assert tables["validation"].first()["passed"]
    lat = {r.stage: r.status for r in tables["latency"].collect()}
    assert lat == {"staging": "OK", "clean": "OK", "marts": "OK", "checks": "OK"}
    log = tables["run_log"]
    assert log.filter("event = 'WRITTEN' AND rows IS NULL").count() == 0
    assert {r.event for r in log.collect()} == {"START", "WRITTEN", "END"}
    assert spark.table("v_bank_annual").columns == list(etl.PRICE_YEAR_VIEW)


def _three_sources(spark, tmp_path):
    """Three CSV sources that share a code, in several files each."""
    specs = []
    for s in range(3):
        folder = tmp_path / f"s{s}"
        folder.mkdir()
        for part in range(3):
            lines = [f"GDP,gdp,{1990 + y},{100 * s + 10 * part + y}" for y in range(20) if (s, part) != (0, 0) or y % 2]
            (folder / f"f{part}.csv").write_text("indicator_code,indicator_name,year,value\n" + "\n".join(lines) + "\n")
        specs.append(SourceSpec(f"s{s}", lambda sp, f=str(folder): read_csv_strings(sp, f), "indicators_long",
                                {"source": f"src{s}", "dataset": "d"}))
    return specs


def test_marts_do_not_depend_on_partitions(spark, tmp_path):
    specs = _three_sources(spark, tmp_path)
    want = [(1990 + y, float((0 if y % 2 else 10) + y)) for y in range(20)]  # the first source, its first file that has the year
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for n, limit in ((2, "-1"), (16, "-1"), (16, "10m")):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            out = etl.run(spark, specs, str(tmp_path / f"wh{n}{limit}"), snapshot_where=F.col("source") == "src1")
            assert sorted((r.year, r.GDP) for r in out["mart_macro_wide"].collect()) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_snapshot_scope_and_benchmarks(spark, tmp_path):
    rows = [("IMF", "NGDPD", 1000.0), ("OTHER", "NGDPD", 9000.0)]
    specs = [SourceSpec(s, lambda sp, c=c, v=v: sp.createDataFrame([(c, c, 2020, v)], "indicator_code string, indicator_name string, year int, value double"),
                        "indicators_long", {"source": s, "dataset": "WEO"}) for s, c, v in rows]
    flat = spark.createDataFrame([("x", "me", 2020, 1.0), ("x", "you", 2020, 3.0)], "indicator string, entity string, year int, value double")
    out = etl.run(spark, specs, str(tmp_path / "wh"), snapshot_where=(F.col("source") == "IMF") & (F.col("dataset") == "WEO"),
                  peers={"one": flat, "two": flat.withColumn("region", F.lit("r"))}, subject="me")
    assert out["economy_snapshot"].collect()[0].pib_usd_m == 1000.0
    got = {r.source: (r.subject_rank, r.group_avg) for r in out["benchmark"].collect()}
    assert got == {"one": (2, None), "two": (2, 2.0)}


def test_failed_stage_is_logged(spark, tmp_path):
    out_dir = str(tmp_path / "wh")
    bad = SourceSpec("bad", lambda sp: sp.range(3).select(F.raise_error(F.lit("broken source")).cast("string").alias("indicator_code"),
                                                          F.lit("n").alias("indicator_name"), F.lit(2020).alias("year"), F.lit(1.0).alias("value")),
                     "indicators_long", {"source": "s", "dataset": "d"})
    with pytest.raises(Exception, match="broken source"):
        etl.run(spark, [bad], out_dir)
    log = {(r.event, r.table_name): r for r in spark.read.parquet(out_dir + "/run_log").collect()}
    assert ("START", None) in log and ("FAILED", None) in log
    assert "broken source" in log["FAILED", "indicators_long"].message


def _one_source(year, value, code="NGDPD"):
    value = F.raise_error(F.lit("broken source")).cast("double") if value is None else F.lit(value)
    return SourceSpec("s", lambda sp: sp.range(1).select(F.lit(code).alias("indicator_code"), F.lit("n").alias("indicator_name"), F.lit(year).alias("year"), value.alias("value")),
                      "indicators_long", {"source": "s", "dataset": "d"})


def test_versions_are_published_as_a_whole(spark, tmp_path):
    out_dir = str(tmp_path / "wh")
    with pytest.raises(LookupError):
        etl.load(spark, out_dir)
    etl.run(spark, [_one_source(2001, 1.0)], out_dir)
    with pytest.raises(Exception, match="broken source"):
        etl.run(spark, [_one_source(2002, None)], out_dir)

    def fail_late(*_args, **_options):
        raise RuntimeError("marts broke")

    with pytest.MonkeyPatch.context() as m, pytest.raises(RuntimeError, match="marts broke"):
        m.setattr(etl.reshape, "snapshot", fail_late)  # after staging, clean zone and panels of that run were written
        etl.run(spark, [_one_source(2003, 3.0)], out_dir)
    tables = etl.load(spark, out_dir)
    for name in ("indicators_long", "indicators_clean", "mart_macro_wide", "economy_snapshot", "benchmark_panel"):
        assert {r.year for r in tables[name].collect()} == {2001}, name
    assert {r.year for r in etl.view_tables(tables)["v_economy_snapshot"].collect()} == {2001}
    etl.run(spark, [_one_source(2004, 4.0)], out_dir)
    assert etl.load(spark, out_dir)["indicators_long"].first().year == 2004
    assert etl.load(spark, out_dir, version=1)["indicators_long"].first().year == 2001
    assert len(etl.prune(spark, out_dir, keep=1)) == 3 and len(glob.glob(f"{out_dir}/versions/*")) == 1
    assert etl.load(spark, out_dir)["indicators_long"].first().year == 2004 and etl.prune(spark, out_dir, keep=1) == []


def test_panel_names_and_order(spark):
    """Codes that differ in case are one column with the smallest spelling; ``first`` follows the order column."""
    rows = [("Gdp", None, 2000, 5.0, 2), ("GDP", None, 2000, 7.0, 1), ("gdp", None, 2001, None, 3), ("cpi", None, 2001, 2.0, 4)]
    long = spark.createDataFrame([("s", "d", c, c, e, y, v, o) for c, e, y, v, o in rows],
                                 f"source string, dataset string, code string, name string, entity string, year int, value double, {etl.ROW_ORDER} long")
    assert sorted(etl.macro_wide(long, None).select("year", "GDP", "cpi").collect()) == [(2000, 7.0, None), (2001, None, 2.0)]
    assert etl.macro_wide(long, None, agg="max").where("year = 2000").first().GDP == 7.0
    assert etl.macro_wide(long, None, agg="mean", codes=["GDP"]).first().GDP == 6.0


def test_stream_ingest_exactly_once(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "long")
    landing.mkdir()
    (landing / "a.csv").write_text("indicator_code,indicator_name,year,value\nX,x,2020,1.5\nX,x,2021,NA\n")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           ("indicator_code", "indicator_name", "year", "value")])
    norm = lambda b: normalise_long(b, "WB", "WDI")
    ckpt = str(tmp_path / "ckpt")
    ingest_files(spark, str(landing), schema, norm, target, checkpoint=ckpt)
    (landing / "b.csv").write_text("indicator_code,indicator_name,year,value\nY,y,2020,2\n")
    ingest_files(spark, str(landing), schema, norm, target, checkpoint=ckpt)
    got = sorted((r.code, r.year, r.value) for r in spark.read.parquet(target).collect())
    assert got == [("X", 2020, 1.5), ("X", 2021, None), ("Y", 2020, 2.0)]
    with pytest.raises(ValueError):                     # another checkpoint would read the files again
        ingest_files(spark, str(landing), schema, norm, target, checkpoint=str(tmp_path / "other"))


def test_snake_case_and_rounding(spark):
    assert [snake_case(c) for c in ("GDP Growth (%)", "NY.GDP.MKTP.CD", "gdpPerCapita", "2020")] == [
        "gdp_growth", "ny_gdp_mktp_cd", "gdp_per_capita", "x2020"]
    df = spark.createDataFrame([(133.2581875,), (-0.0000001,), (2.5,), (None,)], "x double")
    got = [r[0] for r in df.select(round_to("x", 6)).collect()]
    assert got[2] == 2.5 and got[3] is None
    assert str(got[1]) == "-0.0"                                # sign of zero kept, as C round() does
    assert got[0] in (133.258187, 133.258188)


def test_significant_digits(spark):
    df = spark.createDataFrame([(123456.0,), (0.00123456,), (-98765.0,), (0.0,), (None,)], "x double")
    got = [r[0] for r in df.select(signif("x", 3)).collect()]
    assert got[0] == 123000.0 and abs(got[1] - 0.00123) < 1e-12 and got[2] == -98800.0 and got[3:] == [0.0, None]


def test_read_csv_header_only(spark, tmp_path):
    p = tmp_path / "h.csv"
    p.write_text("a,b\n1,x\n")
    assert read_csv_strings(spark, str(p)).dtypes == [("a", "string"), ("b", "string")]
