"""Sources and sinks as queries: a given table is written to shared scratch in a source's form and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.operators import alerts
from obsframe.plans import testdata as td
from obsframe.plans.registry import register, rounded
from obsframe.session import scratch_path
from obsframe.sources import (
    grapher_to_long, load_folder, normalise_prices, read_csv_strings, read_csv_typed, write_csv, write_report, write_warehouse,
)


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@register("csv_strings", """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand, CAST(p_size AS VARCHAR) AS p_size FROM part""")
def q_csv_strings(spark, sf_dir):
    """A1 + A8: CSV sink, then a scan with every column as text."""
    out = _folder(spark, "csv")
    write_csv(td.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size"), out)
    return read_csv_strings(spark, out)


@register("csv_typed", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_orderstatus,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""")
def q_csv_typed(spark, sf_dir):
    """A2: typed CSV scan; text that is no number becomes NULL."""
    out = _folder(spark, "csv")
    price = F.when(F.col("o_orderkey") % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    write_csv(td.table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", price.alias("o_totalprice"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate")), out)
    schema = T.StructType([T.StructField("o_orderkey", T.IntegerType()), T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderdate", T.DateType())])
    return read_csv_typed(spark, out, schema).withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@register("price_layout", """
SELECT CAST(l_suppkey AS VARCHAR) AS entity, strftime(l_shipdate, '%Y-%m-%d') AS trade_date, l_extendedprice AS price,
       CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem""")
def q_price_layout(spark, sf_dir):
    """A3 layout of daily prices, B17, B27: price CSV to the typed price fact."""
    out = _folder(spark, "csv")
    write_csv(td.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("bank"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), F.col("l_extendedprice").alias("Price")), out)
    prices = normalise_prices(read_csv_strings(spark, out))
    return prices.select("entity", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"), "price", "year")


@register("grapher_csv", """
SELECT 'grapher' AS source, 'orders' AS dataset, 'total' AS code, 'order total' AS name, 'Region' AS entity,
       CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS value
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey = 7 GROUP BY ALL""")
def q_grapher_csv(spark, sf_dir):
    """Per-entity grapher CSV to the long rows of one entity."""
    out = _folder(spark, "csv")
    totals = td.customer_years(spark, sf_dir).groupBy("c_nationkey", "n_name", "year").agg(F.sum("total").alias("total"))
    write_csv(totals.select(F.col("n_name").alias("Entity"), F.concat(F.lit("N"), "c_nationkey").alias("Code"),
                            F.col("year").alias("Year"), "total"), out)
    return rounded(grapher_to_long(read_csv_strings(spark, out), "N7", "grapher", "orders", "total", "order total", "Region"), 2)


@register("warehouse_tables", """
SELECT 'facts' AS table_name, l_returnflag AS source, l_linestatus AS dataset, count(*) AS n, round(sum(l_quantity), 2) AS total
FROM lineitem GROUP BY ALL""")
def q_warehouse_tables(spark, sf_dir):
    """A9 + A16: partitioned Parquet warehouse, read back by folder."""
    out = _folder(spark, "warehouse")
    li = td.table(spark, sf_dir, "lineitem").withColumnsRenamed({"l_returnflag": "source", "l_linestatus": "dataset"})
    write_warehouse(li, out + "/facts.parquet")
    tables, _ = load_folder(spark, out)
    parts = [d.groupBy("source", "dataset").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total"))
             .select(F.lit(n).alias("table_name"), "*") for n, d in tables.items()]
    return rounded(parts[0], 2)


@register("json_report", """
SELECT event_type, count(*) AS n, round(max(value), 4) AS top FROM events GROUP BY 1""")
def q_json_report(spark, sf_dir):
    """A result table appended as JSON lines, read back."""
    out = _folder(spark, "report")
    e = td.table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    write_report(rounded(e, 4), out, "2024-01-31 00:00:00")
    return spark.read.schema("event_type string, n long, top double").json(out)


@register("stage_latency", """
WITH r AS (SELECT 'u' || CAST(user_id AS VARCHAR) AS run_id, event_type AS stage,
                  (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 60.0 AS d, count(*) AS n FROM events GROUP BY ALL)
SELECT run_id, stage, round(d, 2) AS duration_minutes, n AS rows, CAST(CASE WHEN stage = 'click' THEN 20000 WHEN stage = 'view' THEN 10000 END AS DOUBLE) AS max_minutes,
       CASE WHEN stage NOT IN ('click', 'view') THEN 'NO_BUDGET'
            WHEN round(d, 2) <= CASE WHEN stage = 'click' THEN 20000 ELSE 10000 END THEN 'OK' ELSE 'BREACH' END AS status FROM r""")
def q_stage_latency(spark, sf_dir):
    """Each user's stages, from first to last event, against the stages' budgets."""
    runs = td.table(spark, sf_dir, "events").groupBy(F.concat(F.lit("u"), "user_id").alias("run_id"), F.col("event_type").alias("stage")).agg(
        F.min("ts").cast("timestamp").alias("started"), F.max("ts").cast("timestamp").alias("ended"), F.lit(True).alias("ok"), F.count(F.lit(1)).alias("rows"))
    budgets = spark.createDataFrame([("click", 20000.0), ("view", 10000.0)], "stage string, max_minutes double")
    return alerts.latency_breaches(alerts.stage_events(runs), budgets).select("run_id", "stage", "duration_minutes", "rows", "max_minutes", "status")
