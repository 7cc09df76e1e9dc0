"""Queries over the batch ETL's written tables, and over data with NaN and a large offset."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from obsframe.operators import observe, stats
from obsframe.plans import etl
from obsframe.plans import testdata as td
from obsframe.plans.registry import register, rounded
from obsframe.session import scratch_path
from obsframe.sources.registry import SourceSpec

# Two sources share the codes (order priorities): the first has the later half of each year, the
# second all rows. The marts must take each (year, code) from the first source that has it.


def _orders(spark, sf_dir, late_only: bool):
    o = td.table(spark, sf_dir, "orders")
    o = o.filter(F.month("o_orderdate") > 6) if late_only else o
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))
    return o.select(F.col("o_orderpriority").alias("indicator_code"), F.col("o_orderpriority").alias("indicator_name"),
                    F.year("o_orderdate").alias("year"), value.alias("value"), F.col("o_orderkey").alias("pos"))


def shared_code_specs(sf_dir: str) -> list[SourceSpec]:
    return [SourceSpec(name, lambda s, late=late: _orders(s, sf_dir, late), "indicators_long",
                       {"source": name, "dataset": "orders"}, order="pos")
            for name, late in (("late", True), ("all", False))]


SHARED = """
raw AS (SELECT 0 AS src, 'late' AS source, o_orderpriority AS code, CAST(year(o_orderdate) AS INTEGER) AS year,
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS value, o_orderkey AS pos FROM orders WHERE month(o_orderdate) > 6
        UNION ALL SELECT 1, 'all', o_orderpriority, CAST(year(o_orderdate) AS INTEGER),
               CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END, o_orderkey FROM orders),
clean AS (SELECT src, source, code, year, arg_min(struct_pack(v := value), pos).v AS value, min(pos) AS pos FROM raw GROUP BY ALL)"""


def _run(spark, sf_dir, **options):
    out = scratch_path(spark, f"etl-{uuid.uuid4().hex}")
    return etl.run(spark, shared_code_specs(sf_dir), out, **options)


@register("etl_macro_mart", "WITH " + SHARED + """
SELECT year, """ + ", ".join(
    f"arg_min(value, src) FILTER (WHERE code = '{p}' AND value IS NOT NULL) AS \"{p}\"" for p in td.ORDER_PRIORITIES) + """
FROM clean WHERE value IS NOT NULL GROUP BY year""")
def q_etl_macro_mart(spark, sf_dir):
    """The batch over two sources that share codes; the first source wins in every year."""
    return _run(spark, sf_dir)["mart_macro_wide"]


@register("etl_snapshot", "WITH " + SHARED + """
SELECT year, max(CASE WHEN code = '1-URGENT' THEN value END) AS urgent, max(CASE WHEN code = '5-LOW' THEN value END) AS low
FROM raw WHERE source = 'late' GROUP BY year""")
def q_etl_snapshot(spark, sf_dir):
    """The written snapshot mart of one source, read through its view."""
    _run(spark, sf_dir, snapshot_codes={"urgent": "1-URGENT", "low": "5-LOW"}, snapshot_where=F.col("source") == "late")
    return spark.table("v_economy_snapshot")


@register("etl_published", "WITH " + SHARED + """
SELECT count(*) AS n_rows, count(value) AS n_values, count(DISTINCT code) AS n_codes, round(sum(value), 2) AS total
FROM clean""")
def q_etl_published(spark, sf_dir):
    """The published version of the batch, loaded by another reader after a later run has failed."""
    out = scratch_path(spark, f"etl-{uuid.uuid4().hex}")
    etl.run(spark, shared_code_specs(sf_dir), out)
    broken = SourceSpec("broken", lambda s: td.table(s, sf_dir, "orders").select(
        F.raise_error(F.lit("source went away")).cast("string").alias("indicator_code"), F.lit("x").alias("indicator_name"),
        F.lit(2000).alias("year"), F.lit(1.0).alias("value")), "indicators_long", {"source": "broken", "dataset": "orders"})
    try:
        etl.run(spark, [*shared_code_specs(sf_dir), broken], out)
    except Exception as e:  # the fault that the query plants; any other one is raised
        if "source went away" not in str(e):
            raise
    clean = etl.load(spark, out)["indicators_clean"]
    return clean.agg(F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values"), F.countDistinct("code").alias("n_codes"),
                     F.round(F.sum("value"), 2).alias("total"))


@register("corr_offset", """
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS day, CAST(1e9 AS DOUBLE) + avg(l_discount) AS a, avg(l_tax) AS b, avg(l_quantity) AS c
           FROM lineitem GROUP BY 1)
SELECT 'a' AS code_a, 'b' AS code_b, count(*) AS n_pairs, round(corr(a - 1e9, b), 4) AS corr FROM d
UNION ALL SELECT 'a', 'c', count(*), round(corr(a - 1e9, c), 4) FROM d
UNION ALL SELECT 'b', 'c', count(*), round(corr(b, c), 4) FROM d""")
def q_corr_offset(spark, sf_dir):
    """G1 on a series with an offset of 1e9: moments about the mean keep the correlation."""
    d = td.table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(
        (F.lit(1e9) + F.avg("l_discount")).alias("a"), F.avg("l_tax").alias("b"), F.avg("l_quantity").alias("c"))
    return rounded(stats.corr_matrix(d.unpivot("day", ["a", "b", "c"], "code", "value"), "day"), 4)


@register("anomalies_with_nan", """
WITH x AS (SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderkey % 97 = 0 THEN 1e6 * 10 ELSE o_totalprice END AS x FROM orders),
s AS (SELECT count(x) AS n, avg(x) AS m, stddev_samp(x) AS sd FROM x),
a AS (SELECT count(*) FILTER (WHERE abs((x - m) / sd) > 3) AS k, any_value(n) AS n, any_value(m) AS m, any_value(sd) AS sd FROM x, s)
SELECT CASE WHEN k = 0 THEN 'INFO' WHEN k * 100.0::DOUBLE / n > 10 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, 'ANOMALY' AS category,
       'orders' AS table_name, 'x' AS column_name, round(k * 100.0::DOUBLE / n, 2) AS observed, k AS n_anomalies, n AS n_values,
       round(m, 2) AS mean, round(sd, 2) AS std FROM a""")
def q_anomalies_with_nan(spark, sf_dir):
    """J1 on a column with NaN: NaN is missing, and the outliers are still found."""
    k = F.col("o_orderkey")
    x = F.when(k % 50 == 0, F.lit(float("nan"))).when(k % 97 == 0, F.lit(1e7)).otherwise(F.col("o_totalprice"))
    return rounded(observe.anomalies(td.table(spark, sf_dir, "orders").select(x.alias("x")), "orders"), 2, only=["mean", "std"])
