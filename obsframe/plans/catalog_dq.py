"""Queries for data-quality rules, SLAs, observability and alerting (with DuckDB oracles)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from obsframe.operators import alerts, checks, clean, observe, sla
from obsframe.plans import testdata as td
from obsframe.plans.registry import register, rounded

# -------------------------------------------------------------------- configuration ----
# fixed values: the rule suite of lineitem, SLA tiers and volumes of the given tables
AS_OF_DATE = "2001-12-31"
AS_OF_TS = "2024-01-31 00:00:00"
LINEITEM_EXPECTED = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                     "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "l_comment"]
NON_CONSTANT_COLS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                     "l_linestatus", "l_shipdate"]
TIERS = {"critical": ["events"], "standard": ["orders", "returns"], "batch": ["lineitem"]}
# (least, most, expected) rows of the given tables; `returns` is configured but absent
VOLUMES = {"lineitem": (1000, 100_000_000, 60000), "orders": (1000, 100_000_000, 15000),
           "customer": (100, 10_000_000, 1500), "supplier": (10, 1_000_000, 100), "part": (100, 10_000_000, 2000),
           "nation": (25, 25, 25), "region": (5, 5, 5), "events": (1000, 100_000_000, 12000),
           "returns": (1, 1_000_000, 900)}
COUNTED = ["lineitem", "orders", "customer", "supplier", "part", "nation", "region", "events"]
LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                    "l_discount", "l_tax"]


def lineitem_rules(spark, sf_dir):
    return [
        {"check": "not_null", "columns": ["l_orderkey", "l_quantity", "l_shipdate", "l_comment"]},
        {"check": "unique", "columns": ["l_orderkey"]},
        {"check": "range", "column": "l_discount", "min": 0.0, "max": 0.1},
        {"check": "range", "column": "l_quantity", "min": 1.0, "max": 50.0},
        {"check": "volume", "min": 1000, "max": 100_000_000},
        {"check": "non_constant", "exclude": ["l_orderkey", "l_partkey", "l_suppkey"]},
        {"check": "correlation", "a": "l_quantity", "b": "l_extendedprice", "min_abs": 0.3},
        {"check": "freshness", "column": "l_shipdate", "max_age_days": 90, "as_of": AS_OF_DATE},
        {"check": "schema", "expected": LINEITEM_EXPECTED},
        {"check": "referential", "column": "l_orderkey", "ref": td.table(spark, sf_dir, "orders"), "ref_column": "o_orderkey"},
        {"check": "referential", "column": "l_partkey", "ref": td.table(spark, sf_dir, "part"), "ref_column": "p_partkey"},
        {"check": "referential", "column": "l_suppkey", "ref": td.table(spark, sf_dir, "supplier"), "ref_column": "s_suppkey"},
    ]


def lineitem_checks(spark, sf_dir):
    res = checks.run_suite(td.table(spark, sf_dir, "lineitem"), "lineitem", lineitem_rules(spark, sf_dir))
    return rounded(res, 6, only=["observed"])


# -------------------------------------------------------------------- SQL fragments ----

def _nc(c: str) -> str:
    return (f"SELECT 'lineitem' AS table_name, 'lineitem.{c}_non_constant' AS test, 'non_constant' AS \"check\", "
            f"'{c}' AS column_name, false AS passed, CAST(CASE WHEN count({c}) = 0 THEN 0 ELSE 1 END AS DOUBLE) AS observed, "
            f"CAST(2 AS DOUBLE) AS bound_low, CAST(NULL AS DOUBLE) AS bound_high, CAST(NULL AS VARCHAR) AS details FROM lineitem "
            f"HAVING count({c}) = 0 OR min({c}) = max({c})")


def _nn(c: str) -> str:
    return (f"SELECT 'lineitem', 'lineitem.{c}_not_null', 'not_null', '{c}', "
            f"coalesce(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100 / count(*) < 5.0, false), "
            f"round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100 / count(*), 6), NULL, 5.0, CAST(NULL AS VARCHAR) FROM lineitem")


def _ref(c: str, t: str, rc: str) -> str:
    return (f"SELECT 'lineitem', 'lineitem.{c}_referential', 'referential', '{c}', count(*) = 0, "
            f"CAST(count(*) AS DOUBLE), 0.0, 0.0, 'sample=' || coalesce(array_to_string(list_sort(list({c}))[1:10], ','), '') "
            f"FROM (SELECT DISTINCT l.{c} FROM lineitem l ANTI JOIN {t} r ON l.{c} = r.{rc} WHERE l.{c} IS NOT NULL)")


CHECKS = "chk AS (SELECT * FROM (\n" + "\nUNION ALL ".join(
    [_nn(c) for c in ("l_orderkey", "l_quantity", "l_shipdate")] + [
        "SELECT 'lineitem', 'lineitem.l_comment_exists', 'exists', 'l_comment', false, NULL, NULL, NULL, NULL",
        "SELECT 'lineitem', 'lineitem.l_orderkey_unique', 'unique', 'l_orderkey', "
        "count(*) - count(DISTINCT l_orderkey) - max(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) = 0, "
        "CAST(count(*) - count(DISTINCT l_orderkey) - max(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) AS DOUBLE), "
        "0.0, 0.0, NULL FROM lineitem",
        "SELECT 'lineitem', 'lineitem.l_discount_range', 'range', 'l_discount', "
        "count(*) FILTER (WHERE l_discount < 0.0::DOUBLE OR l_discount > 0.1::DOUBLE) = 0, "
        "CAST(count(*) FILTER (WHERE l_discount < 0.0::DOUBLE OR l_discount > 0.1::DOUBLE) AS DOUBLE), 0.0, 0.1, "
        "'below=' || count(*) FILTER (WHERE l_discount < 0.0::DOUBLE) || ';above=' || count(*) FILTER (WHERE l_discount > 0.1::DOUBLE) FROM lineitem",
        "SELECT 'lineitem', 'lineitem.l_quantity_range', 'range', 'l_quantity', "
        "count(*) FILTER (WHERE l_quantity < 1.0 OR l_quantity > 50.0) = 0, "
        "CAST(count(*) FILTER (WHERE l_quantity < 1.0 OR l_quantity > 50.0) AS DOUBLE), 1.0, 50.0, "
        "'below=' || count(*) FILTER (WHERE l_quantity < 1.0) || ';above=' || count(*) FILTER (WHERE l_quantity > 50.0) FROM lineitem",
        "SELECT 'lineitem', 'lineitem_volume', 'volume', NULL, count(*) BETWEEN 1000 AND 100000000, "
        "CAST(count(*) AS DOUBLE), 1000.0, 100000000.0, NULL FROM lineitem",
        "SELECT 'lineitem', 'lineitem.l_quantity_l_extendedprice_correlation', 'correlation', 'l_quantity,l_extendedprice', "
        "coalesce(abs(corr(l_quantity, l_extendedprice)) >= 0.3, false), round(corr(l_quantity, l_extendedprice), 6), "
        "0.3, NULL, NULL FROM lineitem",
        f"SELECT 'lineitem', 'lineitem_freshness', 'freshness', 'l_shipdate', "
        f"coalesce(date_diff('day', max(CAST(l_shipdate AS DATE)), DATE '{AS_OF_DATE}') <= 90, false), "
        f"CAST(date_diff('day', max(CAST(l_shipdate AS DATE)), DATE '{AS_OF_DATE}') AS DOUBLE), NULL, 90.0, 'unreadable=0' FROM lineitem",
        "SELECT 'lineitem', 'lineitem_schema', 'schema', NULL, false, 1.0, 0.0, 0.0, 'missing=l_comment;extra='",
        _ref("l_orderkey", "orders", "o_orderkey"), _ref("l_partkey", "part", "p_partkey"),
        _ref("l_suppkey", "supplier", "s_suppkey"),
    ] + [_nc(c) for c in NON_CONSTANT_COLS]) + \
    ") t(table_name, test, \"check\", column_name, passed, observed, bound_low, bound_high, details))"

COUNTS = "cnt AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS actual FROM {t}" for t in COUNTED) + ")"
VOLCFG = "vcfg AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', {lo}, {hi}, {e})" for k, (lo, hi, e) in VOLUMES.items()) + ") t(table_name, min_rows, max_rows, expected))"
VOLUME = COUNTS + ",\n" + VOLCFG + """,
vol AS (SELECT cnt.table_name, cnt.actual, CAST(vcfg.expected AS BIGINT) AS expected,
               CAST(vcfg.min_rows AS BIGINT) AS min_rows, CAST(vcfg.max_rows AS BIGINT) AS max_rows,
               CASE WHEN cnt.actual BETWEEN vcfg.min_rows AND vcfg.max_rows THEN 'OK' ELSE 'BREACH' END AS status
        FROM cnt JOIN vcfg ON cnt.table_name = vcfg.table_name)"""
FRESH = "tiers AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{tier}', {float(h)}, '{t}')" for tier, names in TIERS.items()
    for t, h in ((n, {"critical": 6, "standard": 24, "batch": 168}[tier]) for n in names)) + \
    """) t(tier, max_age_hours, table_name)),
upd AS (SELECT 'events' AS table_name, max(ts) AS updated_at FROM events
        UNION ALL SELECT 'orders', max(o_orderdate) FROM orders UNION ALL SELECT 'lineitem', max(l_shipdate) FROM lineitem),
fr AS (SELECT tiers.table_name, tiers.tier,
              CASE WHEN upd.updated_at IS NULL THEN 'MISSING'
                   WHEN (epoch(TIMESTAMP '""" + AS_OF_TS + """') - floor(epoch(upd.updated_at))) / 3600.0 <= max_age_hours
                   THEN 'FRESH' ELSE 'STALE' END AS status,
              round((epoch(TIMESTAMP '""" + AS_OF_TS + """') - floor(epoch(upd.updated_at))) / 3600.0, 1) AS age_hours,
              CAST(max_age_hours AS DOUBLE) AS sla_hours
       FROM tiers LEFT JOIN upd ON tiers.table_name = upd.table_name)"""

ANOM = "cells AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM lineitem" for c in LINEITEM_NUMERIC) + """),
st AS (SELECT column_name, count(x) AS n, avg(x) AS mean, stddev_samp(x) AS std FROM cells WHERE x IS NOT NULL
       GROUP BY column_name HAVING count(x) >= 10 AND stddev_samp(x) > 0),
ac AS (SELECT c.column_name, count(*) FILTER (WHERE abs((c.x - st.mean) / st.std) > 3) AS n_anomalies,
              any_value(st.n) AS n, any_value(st.mean) AS mean, any_value(st.std) AS std
       FROM cells c JOIN st ON c.column_name = st.column_name WHERE c.x IS NOT NULL GROUP BY c.column_name),
anom AS (SELECT CASE WHEN n_anomalies = 0 THEN 'INFO' WHEN CAST(n_anomalies AS DOUBLE) * 100 / n > 10 THEN 'CRITICAL'
                     ELSE 'WARNING' END AS severity, 'ANOMALY' AS category, 'lineitem' AS table_name, column_name,
                round(CAST(n_anomalies AS DOUBLE) * 100 / n, 2) AS observed, n_anomalies, n AS n_values,
                round(mean, 4) AS mean, round(std, 4) AS std FROM ac)"""

NULLS = """typed_o AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS entity,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS value, o_orderpriority AS code FROM orders),
nl AS (SELECT 'orders_typed' AS table_name, 'code' AS column_name, count(*) FILTER (WHERE code IS NULL) AS nulls, count(*) AS n FROM typed_o
       UNION ALL SELECT 'orders_typed', 'entity', count(*) FILTER (WHERE entity IS NULL), count(*) FROM typed_o
       UNION ALL SELECT 'orders_typed', 'value', count(*) FILTER (WHERE value IS NULL), count(*) FROM typed_o
       """ + "\n       ".join(f"UNION ALL SELECT 'lineitem', '{c}', count(*) FILTER (WHERE {c} IS NULL), count(*) FROM lineitem"
                                for c in LINEITEM_EXPECTED if c != "l_comment") + """),
nulls AS (SELECT CASE WHEN CAST(nulls AS DOUBLE) * 100 / n >= 20.0 THEN 'CRITICAL'
                      WHEN CAST(nulls AS DOUBLE) * 100 / n >= 5.0 THEN 'WARNING' END AS severity,
                 'NULL' AS category, table_name, column_name, round(CAST(nulls AS DOUBLE) * 100 / n, 2) AS observed
          FROM nl WHERE CAST(nulls AS DOUBLE) * 100 / n >= 5.0)"""

VDROP = """vdrop AS (SELECT CASE WHEN CAST(expected - actual AS DOUBLE) * 100 / expected > 30.0 THEN 'CRITICAL'
                           ELSE 'WARNING' END AS severity, 'VOLUME' AS category, table_name,
                      CAST(NULL AS VARCHAR) AS column_name,
                      round(CAST(expected - actual AS DOUBLE) * 100 / expected, 2) AS observed
               FROM vol WHERE CAST(expected - actual AS DOUBLE) * 100 / expected > 10.0)"""

SCHEMA = """sch AS (SELECT 'CRITICAL' AS severity, 'SCHEMA' AS category, 'lineitem' AS table_name,
                     'l_comment' AS column_name, CAST(NULL AS DOUBLE) AS observed)"""

ALERTS = ",\n".join([ANOM, NULLS, VOLUME, VDROP, SCHEMA]) + """,
alerts AS (SELECT severity, category, table_name, column_name, observed FROM anom
           UNION ALL SELECT * FROM nulls UNION ALL SELECT * FROM vdrop UNION ALL SELECT * FROM sch)"""


def typed_orders(spark, sf_dir):
    """Typed (entity, value, code) of the orders text source, before validity and dedup."""
    t = clean.type_long(td.raw_orders_text(spark, sf_dir))
    return t.select("entity", "value", "code")


def volume_results(spark, sf_dir):
    counts = sla.table_counts({t: td.table(spark, sf_dir, t) for t in COUNTED})
    return sla.volume_sla(counts, sla.volume_config(spark, VOLUMES))


def one_pass(spark, sf_dir, rules: list[dict]) -> dict:
    """Everything that the run's reports need of a table, in one pass over it: rule metrics, counts, nulls, moments and the
    newest time of lineitem (anomaly counts, which need the moments, are its second pass), typed orders, and events."""
    li, typed = td.table(spark, sf_dir, "lineitem"), typed_orders(spark, sf_dir)
    chk, li_row = checks.run_suite_with(li, "lineitem", rules, {
        **observe.stat_columns(li, LINEITEM_NUMERIC), "_updated": F.max("l_shipdate")})
    _, o_row = checks.run_suite_with(typed, "orders_typed", [], observe.stat_columns(typed, []))
    _, e_row = checks.run_suite_with(td.table(spark, sf_dir, "events"), "events", [], {"_n": F.count(F.lit(1)), "_updated": F.max("ts")})
    counted = [r.select(F.lit(t).alias("table_name"), F.col("_n").alias("actual"))
               for t, r in (("lineitem", li_row), ("orders", o_row), ("events", e_row))]
    rest = sla.table_counts({t: td.table(spark, sf_dir, t) for t in COUNTED if t not in ("lineitem", "orders", "events")})
    vol = sla.volume_sla(reduce(lambda a, b: a.unionByName(b), counted, rest), sla.volume_config(spark, VOLUMES))
    updated = [r.select(F.lit(t).alias("table_name"), F.col("_updated").alias("updated_at")) for t, r in (("lineitem", li_row), ("events", e_row))]
    newest = td.table(spark, sf_dir, "orders").agg(F.max("o_orderdate").alias("updated_at")).select(F.lit("orders").alias("table_name"), "updated_at")
    fresh = sla.freshness_sla(reduce(lambda a, b: a.unionByName(b), updated, newest), AS_OF_TS, sla.tier_config(spark, TIERS))
    an = observe.anomalies(li, "lineitem", LINEITEM_NUMERIC, stats=li_row)
    nulls = observe.null_share(typed, "orders_typed", stats=o_row).unionByName(observe.null_share(li, "lineitem", stats=li_row))
    sd = observe.schema_drift(spark, "lineitem", li.columns, LINEITEM_EXPECTED)
    return {"checks": rounded(chk, 6, only=["observed"]), "volume": vol, "freshness": fresh, "anomalies": an, "nulls": nulls,
            "alerts": observe.alert_table(an, nulls, observe.volume_drop(vol), sd)}


def alert_union(spark, sf_dir):
    return one_pass(spark, sf_dir, [])["alerts"]


# ------------------------------------------------------------------------- checks ----

@register("lineitem_checks", "WITH " + CHECKS + "\nSELECT *, test || CASE WHEN passed THEN ' passed' ELSE ' failed' END AS message FROM chk")
def q_lineitem_checks(spark, sf_dir):
    """One rule suite compiled into one aggregation (+ anti joins for references)."""
    return lineitem_checks(spark, sf_dir)


@register("check_summary", "WITH " + CHECKS + """
SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(*) - count(*) FILTER (WHERE passed) AS failed,
       coalesce(round(CAST(count(*) FILTER (WHERE passed) AS DOUBLE) * 100 / count(*), 1), 0.0) AS pass_rate,
       count(*) > 0 AND count(*) FILTER (WHERE passed) = count(*) AS ok
FROM chk""")
def q_check_summary(spark, sf_dir):
    """Total, passed, failed, pass rate; an empty run is not ok."""
    return checks.summary(lineitem_checks(spark, sf_dir))


# ---------------------------------------------------------------------------- SLA ----

@register("volume_sla", "WITH " + VOLUME + "\nSELECT * FROM vol")
def q_volume_sla(spark, sf_dir):
    """Row counts against configured ranges; configured but absent tables are skipped."""
    return volume_results(spark, sf_dir)


def freshness_results(spark, sf_dir):
    upd = reduce(lambda a, b: a.unionByName(b), [
        td.table(spark, sf_dir, t).agg(F.max(c).alias("updated_at")).select(F.lit(t).alias("table_name"), "updated_at")
        for t, c in (("events", "ts"), ("orders", "o_orderdate"), ("lineitem", "l_shipdate"))])
    return sla.freshness_sla(upd, AS_OF_TS, sla.tier_config(spark, TIERS))


@register("freshness_sla", "WITH " + FRESH + "\nSELECT * FROM fr")
def q_freshness_sla(spark, sf_dir):
    """FRESH / STALE / MISSING by tier from each table's newest timestamp."""
    return freshness_results(spark, sf_dir)


@register("sla_report", "WITH " + FRESH + ",\n" + VOLUME + """
SELECT 'freshness' AS kind, count(*) AS total, count(*) FILTER (WHERE status = 'FRESH') AS passed,
       coalesce(string_agg(table_name, ',' ORDER BY table_name) FILTER (WHERE status <> 'FRESH'), '') AS details FROM fr
UNION ALL SELECT 'volume', count(*), count(*) FILTER (WHERE status = 'OK'),
       coalesce(string_agg(table_name, ',' ORDER BY table_name) FILTER (WHERE status <> 'OK'), '') FROM vol""")
def q_sla_report(spark, sf_dir):
    """Compliance per SLA kind."""
    return sla.sla_report(freshness_results(spark, sf_dir), volume_results(spark, sf_dir))


# ------------------------------------------------------------------ observability ----

@register("anomalies", "WITH " + ANOM + "\nSELECT * FROM anom")
def q_anomalies(spark, sf_dir):
    """|z| > 3 counts per numeric column with severity."""
    return observe.anomalies(td.table(spark, sf_dir, "lineitem"), "lineitem", LINEITEM_NUMERIC)


@register("null_share", "WITH " + NULLS + "\nSELECT * FROM nulls")
def q_null_share(spark, sf_dir):
    """Null share per column, >= 20 % CRITICAL, >= 5 % WARNING."""
    li = td.table(spark, sf_dir, "lineitem")
    return observe.null_share(typed_orders(spark, sf_dir), "orders_typed").unionByName(
        observe.null_share(li, "lineitem"))


@register("volume_drop", "WITH " + VOLUME + ",\n" + VDROP + "\nSELECT * FROM vdrop")
def q_volume_drop(spark, sf_dir):
    """Drop against expected rows, > 30 % CRITICAL, > 10 % WARNING."""
    vol = volume_results(spark, sf_dir)
    return observe.volume_drop(vol)


MEAN_DRIFT_SQL = """
WITH base AS (SELECT 'o_orderkey' AS column_name, avg(CAST(o_orderkey AS DOUBLE)) AS base_mean,
                     stddev_samp(CAST(o_orderkey AS DOUBLE)) AS base_std FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
              UNION ALL SELECT 'o_custkey', avg(CAST(o_custkey AS DOUBLE)), stddev_samp(CAST(o_custkey AS DOUBLE))
                     FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
              UNION ALL SELECT 'o_totalprice', avg(o_totalprice), stddev_samp(o_totalprice)
                     FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
cur AS (SELECT 'o_orderkey' AS column_name, avg(CAST(o_orderkey AS DOUBLE)) AS current_mean FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
        UNION ALL SELECT 'o_custkey', avg(CAST(o_custkey AS DOUBLE)) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
        UNION ALL SELECT 'o_totalprice', avg(o_totalprice) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT cur.column_name, round(abs(current_mean - base_mean) / base_std, 4) AS z,
       round(current_mean, 4) AS current_mean, round(base_mean, 4) AS base_mean,
       abs(current_mean - base_mean) / base_std > 3 AS drifted
FROM cur JOIN base ON cur.column_name = base.column_name WHERE base_std <> 0"""


@register("mean_drift", MEAN_DRIFT_SQL)
def q_mean_drift(spark, sf_dir):
    """Mean of orders since 1998 against the pre-1998 baseline; z > 3 drifts."""
    o = td.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    cols = ["o_orderkey", "o_custkey", "o_totalprice"]
    base = observe.baseline_stats(o.filter(cut), cols)
    cur = o.filter(~cut).select(*cols)
    scored = observe.mean_drift_scores(cur, base)
    return rounded(scored, 4)


@register("alert_summary", "WITH " + ALERTS + """
SELECT count(*) AS total_alerts, count(*) FILTER (WHERE severity = 'CRITICAL') AS critical,
       count(*) FILTER (WHERE severity = 'WARNING') AS warnings, count(*) FILTER (WHERE severity = 'INFO') AS info
FROM alerts""")
def q_alert_summary(spark, sf_dir):
    """Anomaly, null, volume and schema alerts in one table; severity counts."""
    return observe.severity_counts(alert_union(spark, sf_dir))


# ------------------------------------------------------------------------- alerts ----

ROUTES = """routes AS (SELECT * FROM (VALUES ('CRITICAL', 'log_file'), ('CRITICAL', 'json_log'), ('WARNING', 'log_file'),
                                   ('WARNING', 'json_log'), ('INFO', 'log_file')) t(severity, channel))"""


@register("alert_routing", "WITH " + ALERTS + ",\n" + ROUTES + """
SELECT a.severity, a.category, a.table_name, a.column_name, a.observed, coalesce(r.channel, 'log_file') AS channel
FROM alerts a LEFT JOIN routes r ON a.severity = r.severity""")
def q_alert_routing(spark, sf_dir):
    """K1: one row per alert and enabled channel of its severity."""
    return alerts.route(alert_union(spark, sf_dir))


@register("alert_rules", "WITH " + CHECKS + ",\n" + ANOM + ",\n" + VOLUME + ",\n" + NULLS + """
SELECT CASE WHEN passed THEN 'INFO' ELSE 'WARNING' END AS severity, 'DATA_CHECK' AS category, table_name,
       column_name, observed FROM chk
UNION ALL
SELECT CASE WHEN CAST(n_anomalies AS DOUBLE) * 100 / n > 10.0 THEN 'CRITICAL' ELSE 'WARNING' END, 'ANOMALY',
       'lineitem', column_name, round(CAST(n_anomalies AS DOUBLE) * 100 / n, 2) FROM ac WHERE n_anomalies > 0
UNION ALL
SELECT CASE WHEN CAST(expected - actual AS DOUBLE) * 100 / expected > 30.0 THEN 'CRITICAL' ELSE 'WARNING' END,
       'VOLUME_DROP', table_name, CAST(NULL AS VARCHAR), round(CAST(expected - actual AS DOUBLE) * 100 / expected, 2)
FROM vol
UNION ALL
SELECT 'CRITICAL', 'SCHEMA_CHANGE', 'lineitem', 'l_comment', CAST(NULL AS DOUBLE)
UNION ALL
SELECT CASE WHEN observed > 20.0 THEN 'CRITICAL' ELSE 'WARNING' END, 'NULL_SPIKE', table_name, column_name,
       round(observed, 2) FROM nulls""")
def q_alert_rules(spark, sf_dir):
    """K2-K6: alert rules applied to check, anomaly, volume, schema and null-share results."""
    run = one_pass(spark, sf_dir, lineitem_rules(spark, sf_dir))
    li, chk, vol = td.table(spark, sf_dir, "lineitem"), run["checks"], run["volume"]
    an = run["anomalies"].filter(F.col("n_anomalies") > 0)
    counts = an.select("table_name", "column_name", "n_anomalies", F.col("n_values").alias("n_total"))
    changes = spark.createDataFrame(
        [("lineitem", c, "removed") for c in sorted(set(LINEITEM_EXPECTED) - set(li.columns))] +
        [("lineitem", c, "added") for c in sorted(set(li.columns) - set(LINEITEM_EXPECTED))],
        "table_name string, column_name string, change string")
    spikes = alerts.null_spike_rule(run["nulls"].select("table_name", "column_name", F.col("observed").alias("null_pct")))
    parts = [alerts.data_check_rule(chk), alerts.anomaly_rule(counts), alerts.volume_drop_rule(vol),
             alerts.schema_change_rule(changes), spikes]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("check_run", "WITH " + CHECKS + ",\n" + FRESH + ",\n" + ALERTS + """
SELECT 'checks_total' AS metric, CAST(count(*) AS BIGINT) AS value FROM chk
UNION ALL SELECT 'checks_passed', count(*) FILTER (WHERE passed) FROM chk
UNION ALL SELECT 'freshness_total', count(*) FROM fr
UNION ALL SELECT 'freshness_passed', count(*) FILTER (WHERE status = 'FRESH') FROM fr
UNION ALL SELECT 'volume_total', count(*) FROM vol
UNION ALL SELECT 'volume_passed', count(*) FILTER (WHERE status = 'OK') FROM vol
UNION ALL SELECT 'alerts_total', count(*) FROM alerts
UNION ALL SELECT 'alerts_critical', count(*) FILTER (WHERE severity = 'CRITICAL') FROM alerts
UNION ALL SELECT 'alerts_warning', count(*) FILTER (WHERE severity = 'WARNING') FROM alerts
UNION ALL SELECT 'alerts_info', count(*) FILTER (WHERE severity = 'INFO') FROM alerts""")
def q_check_run(spark, sf_dir):
    """K8: validation + SLA + observability + alerts of one run as (metric, value) rows."""
    run = one_pass(spark, sf_dir, lineitem_rules(spark, sf_dir))
    chk = checks.summary(run["checks"]).select(
        F.col("total").alias("checks_total"), F.col("passed").alias("checks_passed"))
    rep = sla.sla_report(run["freshness"], run["volume"])
    slas = rep.select(F.explode(F.array(
        F.struct(F.concat("kind", F.lit("_total")).alias("metric"), F.col("total").alias("value")),
        F.struct(F.concat("kind", F.lit("_passed")).alias("metric"), F.col("passed").alias("value")))).alias("m")
    ).select("m.metric", "m.value")
    cnt = observe.severity_counts(run["alerts"]).select(
        F.col("total_alerts").alias("alerts_total"), F.col("critical").alias("alerts_critical"),
        F.col("warnings").alias("alerts_warning"), F.col("info").alias("alerts_info"))
    parts = [chk.unpivot([], chk.columns, "metric", "value"), slas, cnt.unpivot([], cnt.columns, "metric", "value")]
    return reduce(lambda a, b: a.unionByName(b), parts)
