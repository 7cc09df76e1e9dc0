"""Bindings of the given TPC-H-style tables to the indicator data model.

There are no indicator files in the test data, so each view below re-expresses a
given table in the canonical shapes the operators consume. Every view reads whole
tables; nothing is sampled or capped.

- ``lineitem`` measures        -> wide-year source (entity = supplier, year = ship year)
- ``orders`` totals by nation   -> year-suffixed wide source (``total_YYYY`` + ``total_all``)
- ``orders`` as all-string rows -> raw long rows for the cleaning chain
- ``lineitem``                  -> daily price fact (entity = supplier)
- ``events``                    -> per (event type, user, day) series panel
- ``orders``                    -> per (nation, year) panel with region as peer group
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.functions.columns import round_to

from obsframe.operators import reshape
from obsframe.sources.registry import SourceSpec, indicators_long

LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# fixed values: TPC-H order priorities (pivot columns)
ORDER_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SUBJECT_NATION = "NATION_7"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation x region names; Spark picks the join from the measured sizes."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


def customer_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order sums and counts per customer and year, with nation and region: orders are reduced before the joins,
    so a customer with very many orders is a few partial sums."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum("o_totalprice").alias("total"), F.count(F.lit(1)).alias("n"), F.count("o_totalprice").alias("n_priced"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(nation_region(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")))


# ---- wide sources and the registry ------------------------------------------------------

def lineitem_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_suppkey").cast("string").alias("supplier"),
                     F.year("l_shipdate").alias("ship_year"), *LINEITEM_MEASURES)


def nation_totals_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation, ``total_YYYY`` per order year and an unsuffixed ``total_all``.

    Orders are reduced to (nation, year) sums in one aggregation; that small table
    is checkpointed so the year list and the pivot do not re-run the orders join.
    """
    from obsframe.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    cells = (customer_years(spark, sf_dir).groupBy(F.col("n_name").alias("nation"), "year")
             .agg(F.sum("total").alias("total")).checkpoint(eager=True))
    years = reshape.pivot_values(cells, "year", max_width=201)
    wide = reshape.pivot(cells, "nation", "year", "total", values=years, agg="max",
                         names={y: f"total_{y}" for y in years}, extra=[F.sum("total").alias("total_all")])
    return wide.select("nation", *[round_to(c, 2).alias(c) for c in [f"total_{y}" for y in years] + ["total_all"]])


def source_specs(sf_dir: str) -> list[SourceSpec]:
    return [
        SourceSpec("lineitem_measures", lambda s: lineitem_wide(s, sf_dir), "wide_year",
                   {"source": "tpch", "dataset": "lineitem", "entity": "supplier", "year": "ship_year"}),
        SourceSpec("nation_totals", lambda s: nation_totals_wide(s, sf_dir), "wide_year_suffixed",
                   {"source": "tpch", "dataset": "orders_by_nation", "entity": "nation"}),
    ]


def long_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """indicators_long over the registered sources."""
    return indicators_long(spark, source_specs(sf_dir))


# ---- raw text rows for the cleaning chain ----------------------------------------------

def raw_orders_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string long rows as a CSV source would deliver them.

    Pending orders ('P') carry the entity token 'None' and the value 'NA'; other
    statuses are padded with blanks; the year is text. Every order year of the data is
    valid, so some rows get a year out of range (1850) or not a number, to exercise the
    rejection. ``row_order`` is the file order.
    """
    o = table(spark, sf_dir, "orders")
    pending = F.col("o_orderstatus") == "P"
    key = F.col("o_orderkey")
    year = (F.when(key % 41 == 0, F.lit("1850")).when(key % 43 == 0, F.lit("n.d."))
            .otherwise(F.year("o_orderdate").cast("string")))
    return o.select(
        F.lit("tpch").alias("source"), F.lit("orders").alias("dataset"),
        F.col("o_orderpriority").alias("code"), F.col("o_orderpriority").alias("name"),
        F.when(pending, F.lit("None")).otherwise(F.concat(F.lit(" "), "o_orderstatus", F.lit(" "))).alias("entity"),
        year.alias("year"),
        F.when(pending, F.lit("NA")).otherwise(F.col("o_totalprice").cast("string")).alias("value"),
        F.col("o_orderkey").alias("row_order"))


# ---- price fact ---------------------------------------------------------------------------

def price_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("entity"),
        F.col("l_shipdate").cast("date").alias("trade_date"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("volume"),
        ((F.col("l_discount") - F.col("l_tax")) * 100.0).alias("change_pct"),
        F.year("l_shipdate").alias("year"))


def orders_year_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, month, code = priority, value = total price or NULL when pending, row_order)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                    F.col("o_orderpriority").alias("code"),
                    F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("double"))
                     .otherwise(F.col("o_totalprice")).alias("value"),
                    F.col("o_orderkey").alias("row_order"))


def priority_panel(spark: SparkSession, sf_dir: str, agg: str = "mean") -> DataFrame:
    """Annual panel: one row per year, one column per order priority."""
    return reshape.pivot(orders_year_long(spark, sf_dir), "year", "code", "value",
                         values=ORDER_PRIORITIES, agg=agg, order_by="row_order")


# ---- series panels ------------------------------------------------------------------------

def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value per (event type, user, day of month): one row per series and period."""
    e = table(spark, sf_dir, "events")
    return (e.groupBy(F.col("event_type").alias("code"), F.col("user_id").alias("entity"),
                      F.dayofmonth("ts").alias("day"))
             .agg(F.avg("value").alias("value")))


def event_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense panel: every (type, user) series gets every day of the observed span.

    The span is two scalars from one narrow aggregate over the raw scan (no shuffle),
    so the cells are aggregated only once.
    """
    lo, hi = table(spark, sf_dir, "events").agg(F.min(F.dayofmonth("ts")), F.max(F.dayofmonth("ts"))).first()
    return reshape.densify(event_cells(spark, sf_dir), ["code", "entity"], t="day", t_min=lo, t_max=hi)


def event_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean value per event type (one series per type)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("code"), F.dayofmonth("ts").alias("day")).agg(
        F.avg("value").alias("value"))


def nation_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long panel (indicator, entity = nation, region, year, value) from orders, checkpointed: it is small, and
    its readers join it with itself."""
    from obsframe.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    g = customer_years(spark, sf_dir).groupBy(F.col("n_name").alias("entity"), F.col("r_name").alias("region"), "year").agg(
        F.sum("total").alias("revenue"), F.sum("n").cast("double").alias("orders"),
        (F.sum("total") / F.sum("n_priced")).alias("avg_order"))
    return g.unpivot(["entity", "region", "year"], ["revenue", "orders", "avg_order"], "indicator", "value").checkpoint(eager=True)


def nation_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity = nation, year, value = revenue)."""
    return (nation_panel(spark, sf_dir).filter(F.col("indicator") == "revenue")
            .select("entity", "year", "value"))


def daily_lineitem_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ship date: revenue, quantity, mean discount and tax, line count (ML panel)."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(
        F.sum("l_extendedprice").alias("revenue"), F.sum("l_quantity").alias("quantity"),
        F.avg("l_discount").alias("avg_discount"), F.avg("l_tax").alias("avg_tax"),
        F.count(F.lit(1)).cast("double").alias("n_lines"))
