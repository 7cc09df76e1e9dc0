import pytest

from obsframe.operators import alerts, checks, observe, sla


def _t(spark, n_null, n=100):
    return spark.createDataFrame([(i, None if i < n_null else float(i), "k") for i in range(n)],
                                 "id int, v double, c string")


def test_suite_one_aggregation(spark):
    df = _t(spark, 5)
    res = {r.test: r for r in checks.run_suite(df, "t", [
        {"check": "not_null", "columns": ["v", "missing_col"]},
        {"check": "unique", "columns": ["id", "c"]},
        {"check": "range", "column": "v", "min": 0, "max": 50},
        {"check": "volume", "min": 10, "max": 100},
        {"check": "non_constant", "exclude": ["id"]},
        {"check": "schema", "expected": ["id", "v", "w"]},
    ]).collect()}
    assert res["t.v_not_null"].observed == 5.0 and res["t.v_not_null"].passed is False   # 5 % is not < 5
    assert res["t.missing_col_exists"].passed is False
    assert res["t.id_unique"].passed and res["t.c_unique"].observed == 99.0
    assert res["t.v_range"].observed == 49.0
    assert res["t_volume"].passed
    assert res["t.c_non_constant"].passed is False and "t.v_non_constant" not in res   # failures only
    assert res["t_schema"].passed is False


def test_unique_counts_nulls_as_equal(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "x int")
    r = checks.run_suite(df, "t", [{"check": "unique", "columns": ["x"]}]).collect()[0]
    assert r.observed == 1.0


def test_empty_table_and_summary(spark):
    df = spark.createDataFrame([], "x int")
    r = checks.run_suite(df, "t", [{"check": "not_null", "columns": ["x"]}]).collect()[0]
    assert r.observed is None and r.passed is False            # no division by zero
    empty = spark.createDataFrame([], checks.CHECK_RESULT_SCHEMA)
    s = checks.summary(empty).collect()[0]
    assert (s.total, s.pass_rate, s.ok) == (0, 0.0, False)     # nothing checked is not a pass


def test_freshness_of_year_column(spark):
    df = spark.createDataFrame([(2023,)], "year int")
    r = checks.run_suite(df, "t", [{"check": "freshness", "column": "year", "max_age_days": 400,
                                    "as_of": "2024-06-30"}]).collect()[0]
    assert r.observed == 182.0 and r.passed


def test_null_share_thresholds(spark):
    out = {r.column_name: r.severity for r in observe.null_share(
        spark.createDataFrame([(None if i < 20 else 1, None if i < 5 else 1, None if i < 4 else 1) for i in range(100)],
                              "a int, b int, c int"), "t").collect()}
    assert out == {"a": "CRITICAL", "b": "WARNING"}


def test_anomalies_min_values_and_constant(spark):
    vals = [0.0] * 19 + [100.0]          # z of the outlier = 95 / sqrt(500) > 3
    df = spark.createDataFrame([(v, 1.0, v if i < 9 else None) for i, v in enumerate(vals)], "x double, k double, y double")
    got = {r.column_name: (r.severity, r.n_anomalies) for r in observe.anomalies(df, "t").collect()}
    assert got == {"x": ("WARNING", 1)}        # k constant skipped, y has 9 values skipped


def test_volume_drop_boundaries(spark):
    act = spark.createDataFrame([("a", 90), ("b", 70), ("c", 69)], "table_name string, actual long")
    exp = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100)], "table_name string, expected long")
    got = {r.table_name: r.severity for r in observe.volume_drop(act.join(exp, "table_name")).collect()}
    assert got == {"c": "CRITICAL", "b": "WARNING"}           # exactly 10 % is quiet, 30 % is a warning
    rule = {r.table_name: r.severity for r in alerts.volume_drop_rule(act.join(exp, "table_name")).collect()}
    assert rule == {"a": "WARNING", "b": "WARNING", "c": "CRITICAL"}


def test_routing_and_sla(spark):
    a = spark.createDataFrame([("CRITICAL", "X"), ("INFO", "Y"), ("DEBUG", "Z")], "severity string, category string")
    got = sorted((r.severity, r.channel) for r in alerts.route(a).collect())
    assert got == [("CRITICAL", "json_log"), ("CRITICAL", "log_file"), ("DEBUG", "log_file"), ("INFO", "log_file")]
    upd = spark.createDataFrame([("ledger", "2024-01-01 00:00:00")], "table_name string, updated_at string")
    tiers = sla.tier_config(spark, {"critical": ["ledger"], "batch": ["archive"]})
    fr = {r.table_name: r.status for r in sla.freshness_sla(upd, "2024-01-01 05:00:00", tiers).collect()}
    assert fr == {"ledger": "FRESH", "archive": "MISSING"}
    cnt = spark.createDataFrame([("ledger", 5)], "table_name string, actual long")
    assert sla.volume_sla(cnt, sla.volume_config(spark, {"ledger": (6, 9, 8)})).collect()[0].status == "BREACH"


def test_stage_latency(spark):
    runs = spark.createDataFrame([("r1", "staging", "2024-01-01 00:00:00", "2024-01-01 00:12:00", True, 72)],
                                 "run_id string, stage string, started string, ended string, ok boolean, rows int")
    ev = alerts.stage_events(runs.selectExpr("run_id", "stage", "CAST(started AS TIMESTAMP) started",
                                             "CAST(ended AS TIMESTAMP) ended", "ok", "rows"))
    budgets = spark.createDataFrame([("staging", 10), ("clean", 5)], "stage string, max_minutes int")
    r = alerts.latency_breaches(ev, budgets).collect()[0]
    assert r.duration_minutes == pytest.approx(12.0) and r.status == "BREACH"


def test_file_metadata_freshness(spark):
    from tests.conftest import SF_SMALL
    upd = sla.table_timestamps(spark, {"orders": f"{SF_SMALL}/orders.parquet", "events": f"{SF_SMALL}/events.parquet"})
    got = {r.table_name: r.updated_at for r in upd.collect()}
    assert set(got) == {"orders", "events"} and all(v is not None for v in got.values())
    far = sla.freshness_sla(upd, "2999-01-01 00:00:00", sla.tier_config(spark, {"critical": ["orders", "gone"]}))
    assert {r.table_name: r.status for r in far.collect()} == {"orders": "STALE", "gone": "MISSING"}


def test_nan_is_missing_and_odd_dates_fail(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, "2024-01-01"), (5.0, "garbage")] + [(float(i % 3), "2024-01-01") for i in range(50)] + [(1e6, None)], "v double, d string")
    rules = [{"check": "not_null", "columns": ["v"], "max_pct": 1.0}, {"check": "range", "column": "v", "min": 0, "max": 1e9},
             {"check": "freshness", "column": "d", "max_age_days": 9, "as_of": "2024-01-02"}]
    got = {r.check: r.passed for r in checks.run_suite(df, "t", rules).collect()}
    assert got == {"not_null": False, "range": True, "freshness": False}
    a = observe.anomalies(df.select("v"), "t").collect()
    assert [(r.n_anomalies, r.n_values) for r in a] == [(1, 52)]
