"""Queries for sources, reshaping, cleaning, quality reports and marts (with DuckDB oracles)."""

from __future__ import annotations

from pyspark.sql import functions as F

from obsframe.functions.columns import round_to

from obsframe.operators import clean, marts, quality, reshape, series
from obsframe.plans import testdata as td
from obsframe.plans.registry import register, rounded
from obsframe.sources import flatten_nested, flatten_paged

# ---------------------------------------------------------------- shared SQL fragments ----

ONW = """onw AS (
  SELECT o.*, n.n_name, r.r_name FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

LONG = ONW + """,
li_long AS (
  SELECT 'tpch' AS source, 'lineitem' AS dataset, 'l_quantity' AS code, 'l_quantity' AS name,
         CAST(l_suppkey AS VARCHAR) AS entity, CAST(year(l_shipdate) AS INTEGER) AS year, l_quantity AS value FROM lineitem
  UNION ALL SELECT 'tpch', 'lineitem', 'l_extendedprice', 'l_extendedprice', CAST(l_suppkey AS VARCHAR),
         CAST(year(l_shipdate) AS INTEGER), l_extendedprice FROM lineitem
  UNION ALL SELECT 'tpch', 'lineitem', 'l_discount', 'l_discount', CAST(l_suppkey AS VARCHAR),
         CAST(year(l_shipdate) AS INTEGER), l_discount FROM lineitem
  UNION ALL SELECT 'tpch', 'lineitem', 'l_tax', 'l_tax', CAST(l_suppkey AS VARCHAR),
         CAST(year(l_shipdate) AS INTEGER), l_tax FROM lineitem),
nt AS (SELECT n_name AS entity, CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS v
       FROM onw GROUP BY ALL),
nt_grid AS (SELECT e.entity, y.year, nt.v FROM (SELECT DISTINCT entity FROM nt) e
            CROSS JOIN (SELECT DISTINCT year FROM nt) y LEFT JOIN nt USING (entity, year)),
long AS (SELECT * FROM li_long
         UNION ALL SELECT 'tpch', 'orders_by_nation', 'total', 'total', entity, year, v FROM nt_grid)"""

RAW_ORDERS = """raw AS (
  SELECT 'tpch' AS source, 'orders' AS dataset, o_orderpriority AS code, o_orderpriority AS name,
         CASE WHEN o_orderstatus = 'P' THEN 'None' ELSE ' ' || o_orderstatus || ' ' END AS entity,
         CASE WHEN o_orderkey % 41 = 0 THEN '1850' WHEN o_orderkey % 43 = 0 THEN 'n.d.'
              ELSE CAST(CAST(year(o_orderdate) AS INTEGER) AS VARCHAR) END AS year,
         CASE WHEN o_orderstatus = 'P' THEN 'NA' ELSE CAST(o_totalprice AS VARCHAR) END AS value,
         o_orderkey AS row_order FROM orders),
typed AS (
  SELECT trim(source) AS source, trim(dataset) AS dataset, trim(code) AS code, trim(name) AS name,
         CASE WHEN trim(entity) IN ('nan', 'None', '') THEN NULL ELSE trim(entity) END AS entity,
         TRY_CAST(trim(year) AS INTEGER) AS year, TRY_CAST(trim(value) AS DOUBLE) AS value, row_order FROM raw),
valid AS (SELECT * FROM typed WHERE coalesce(year BETWEEN 1900 AND 2100, false)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source, dataset, code, entity, year ORDER BY row_order) AS rn
           FROM valid),
clean AS (SELECT source, dataset, code, name, entity, year, value, TRUE AS year_valid, value IS NULL AS is_missing
          FROM ranked WHERE rn = 1)"""

OYL = """oyl AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         o_orderpriority AS code, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS value,
         o_orderkey AS row_order FROM orders)"""

PF = """pf AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS entity, CAST(l_shipdate AS DATE) AS trade_date,
         l_extendedprice / l_quantity AS price, l_quantity AS volume,
         (l_discount - l_tax) * CAST(100.0 AS DOUBLE) AS change_pct, CAST(year(l_shipdate) AS INTEGER) AS year
  FROM lineitem)"""

PRIOS = td.ORDER_PRIORITIES


def _cells(fmt: str) -> str:
    return ",\n  ".join(fmt.format(p=p) for p in PRIOS)


# ------------------------------------------------------------ sources and reshaping ----

@register("indicators_long", "WITH " + LONG + "\nSELECT * FROM long")
def q_indicators_long(spark, sf_dir):
    """A3 registry + B12 wide unpivot + B13 suffixed unpivot + F3/F4 union + B2 tags."""
    return td.long_view(spark, sf_dir)


@register("dim_indicators", "WITH " + LONG + """
SELECT source, dataset, code, name, min(year) AS years_min, max(year) AS years_max, count(value) AS n_obs
FROM long GROUP BY ALL""")
def q_dim_indicators(spark, sf_dir):
    """Dimension table (the flagship query)."""
    return quality.dimension(td.long_view(spark, sf_dir))


@register("economy_snapshot", "WITH " + LONG + """
SELECT year,
  max(CASE WHEN code = 'l_quantity' THEN value END) AS max_quantity,
  max(CASE WHEN code = 'l_extendedprice' THEN value END) AS max_price,
  max(CASE WHEN code = 'l_discount' THEN value END) AS max_discount,
  max(CASE WHEN code = 'l_tax' THEN value END) AS max_tax,
  max(CASE WHEN code = 'total' THEN value END) AS max_nation_total
FROM long WHERE source = 'tpch' AND dataset IN ('lineitem', 'orders_by_nation') GROUP BY year""")
def q_economy_snapshot(spark, sf_dir):
    """Conditional-aggregate snapshot per year, filtered by source and dataset."""
    long = td.long_view(spark, sf_dir)
    where = (F.col("source") == "tpch") & F.col("dataset").isin("lineitem", "orders_by_nation")
    return reshape.snapshot(long, "year", "code", {
        "max_quantity": "l_quantity", "max_price": "l_extendedprice", "max_discount": "l_discount",
        "max_tax": "l_tax", "max_nation_total": "total"}, where=where)


@register("long_counts", "WITH " + LONG + """
SELECT count(*) AS n_rows, count(DISTINCT code) AS n_codes FROM long""")
def q_long_counts(spark, sf_dir):
    """Row count and distinct codes."""
    return quality.counts(td.long_view(spark, sf_dir))


@register("long_counts_by_source", "WITH " + LONG + """
SELECT source, dataset, count(*) AS n_rows FROM long GROUP BY ALL""")
def q_long_counts_by_source(spark, sf_dir):
    """D3: rows per (source, dataset)."""
    return quality.counts_by(td.long_view(spark, sf_dir))


@register("suffixed_unpivot", "WITH " + LONG + """
SELECT entity, code, year, v AS value FROM nt_grid CROSS JOIN (SELECT 'total' AS code)""")
def q_suffixed_unpivot(spark, sf_dir):
    """``total_YYYY`` columns -> (code, year); ``total_all`` is not melted."""
    wide = td.nation_totals_wide(spark, sf_dir).withColumnRenamed("nation", "entity")
    return reshape.unpivot_suffixed(wide, ["entity"])


@register("part_long", """
SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_brand, code, value FROM (
  SELECT p_partkey, p_brand, 'p_size' AS code, CAST(p_size AS DOUBLE) AS value FROM part
  UNION ALL SELECT p_partkey, p_brand, 'p_retailprice', p_retailprice FROM part)""")
def q_part_long(spark, sf_dir):
    """B12 with a dynamic measure set (every non-id column) of mixed INT/DOUBLE types."""
    p = td.table(spark, sf_dir, "part").drop("p_name", "p_type")
    return reshape.unpivot(p, ["p_partkey", "p_brand"])


@register("paged_json", """
SELECT CAST(event_id // 50 AS BIGINT) AS page_no, strftime(ts, '%Y-%m-%d') AS date, value FROM events""")
def q_paged_json(spark, sf_dir):
    """A4: landed JSON pages ``[meta, [records]]`` (50 records per page) flattened back to rows."""
    e = td.table(spark, sf_dir, "events")
    recs = e.select(F.expr("event_id div 50").alias("page_no"), "event_id",
                    F.date_format("ts", "yyyy-MM-dd").alias("date"), "value")
    pages = recs.groupBy("page_no").agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_list(F.struct("event_id", "date", "value"))).alias("r"))
    meta = F.to_json(F.struct(F.col("page_no").alias("page"), F.lit(50).alias("per_page"), F.col("n").alias("total")))
    body = F.to_json(F.transform("r", lambda x: F.struct(x["date"].alias("date"), x["value"].alias("value"))))
    landed = pages.select("page_no", F.concat(F.lit("["), meta, F.lit(","), body, F.lit("]")).alias("json"))
    return flatten_paged(landed, "json", keep=["page_no"])


@register("nested_json", """
SELECT event_type AS code, 'U' || CAST(user_id AS VARCHAR) AS country, CAST(day(ts) AS INTEGER) AS year,
       round(sum(value), 2) AS value
FROM events GROUP BY ALL""")
def q_nested_json(spark, sf_dir):
    """A5: one ``{"values": {code: {country: {period: value}}}}`` document per (code, country), flattened."""
    e = td.table(spark, sf_dir, "events")
    cells = e.groupBy("event_type", "user_id", F.dayofmonth("ts").alias("d")).agg(
        round_to(F.sum("value"), 2).alias("v"))
    docs = cells.groupBy("event_type", "user_id").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("d").cast("string"), "v"))).alias("m"))
    country = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    j = F.to_json(F.struct(F.create_map(F.col("event_type"), F.create_map(country, F.col("m"))).alias("values")))
    return flatten_nested(docs.select(j.alias("json")), "json")


# ---------------------------------------------------------------------- cleaning ----

@register("indicators_clean", "WITH " + RAW_ORDERS + "\nSELECT * FROM clean")
def q_indicators_clean(spark, sf_dir):
    """B3-B5 typing, B7 year window, E1 keep-first dedup, B18 missing flag."""
    return clean.clean_long(td.raw_orders_text(spark, sf_dir), "row_order", unique_order=True)


@register("indicators_complete", "WITH " + RAW_ORDERS + """
SELECT source, dataset, code, name, entity, year, value FROM clean WHERE value IS NOT NULL""")
def q_indicators_complete(spark, sf_dir):
    """Complete observations only."""
    c = clean.clean_long(td.raw_orders_text(spark, sf_dir), "row_order", unique_order=True)
    return clean.complete(c).drop("year_valid", "is_missing")


@register("run_counters", "WITH " + RAW_ORDERS + """
SELECT (SELECT count(*) FROM typed) AS n_read,
       (SELECT count(*) FROM typed WHERE NOT coalesce(year BETWEEN 1900 AND 2100, false)) AS n_rejected_year,
       (SELECT count(*) FROM valid) - (SELECT count(*) FROM clean) AS n_duplicates,
       (SELECT count(*) FROM clean) AS n_final,
       (SELECT count(*) FROM clean WHERE value IS NULL) AS n_missing""")
def q_run_counters(spark, sf_dir):
    """Read / rejected / duplicate / final / missing counters in one pass."""
    return clean.run_counters(td.raw_orders_text(spark, sf_dir), "row_order")


@register("quality_report", "WITH " + RAW_ORDERS + """
SELECT source, dataset, code, name, count(*) AS n_total, count(value) AS n_nonnull,
       count(*) - count(value) AS n_missing,
       round(CAST(count(*) - count(value) AS DOUBLE) * 100 / count(*), 1) AS pct_missing,
       round(100 - CAST(count(*) - count(value) AS DOUBLE) * 100 / count(*), 1) AS pct_complete,
       min(year) AS year_min, max(year) AS year_max
FROM clean GROUP BY ALL""")
def q_quality_report(spark, sf_dir):
    """Per indicator completeness over the total and year span."""
    return quality.quality_report(clean.clean_long(td.raw_orders_text(spark, sf_dir), "row_order", unique_order=True))


@register("missingness", "WITH " + RAW_ORDERS + """
SELECT code, name, count(value) AS n_nonnull, count(*) AS n_total, count(*) - count(value) AS n_missing,
       round(CAST(count(*) - count(value) AS DOUBLE) * 100 / count(*), 4) AS pct_missing
FROM clean GROUP BY ALL""")
def q_missingness(spark, sf_dir):
    """Missingness per (code, name)."""
    return quality.missingness(clean.clean_long(td.raw_orders_text(spark, sf_dir), "row_order", unique_order=True))


# ------------------------------------------------------------------------ pivots ----

@register("pivot_first", "WITH " + OYL + "\nSELECT year,\n  " + _cells(
    "arg_min(value, row_order) FILTER (WHERE code = '{p}' AND value IS NOT NULL) AS \"{p}\"") + "\nFROM oyl GROUP BY year")
def q_pivot_first(spark, sf_dir):
    """Long -> wide, first non-null value per (year, code) in file order."""
    return td.priority_panel(spark, sf_dir, "first")


@register("pivot_mean", "WITH " + OYL + "\nSELECT year,\n  " + _cells(
    "round(avg(value) FILTER (WHERE code = '{p}'), 4) AS \"{p}\"") + "\nFROM oyl GROUP BY year")
def q_pivot_mean(spark, sf_dir):
    """Pivot with the mean of non-null values."""
    return rounded(td.priority_panel(spark, sf_dir, "mean"), 4)


@register("pivot_strict_mean", "WITH " + OYL + "\nSELECT year, month,\n  " + _cells(
    "CASE WHEN count(*) FILTER (WHERE code = '{p}') = count(value) FILTER (WHERE code = '{p}') "
    "THEN round(avg(value) FILTER (WHERE code = '{p}'), 4) END AS \"{p}\"") + "\nFROM oyl GROUP BY year, month")
def q_pivot_strict_mean(spark, sf_dir):
    """NA-propagating mean (NULL as soon as one input of the cell is NULL)."""
    long = td.orders_year_long(spark, sf_dir)
    wide = reshape.pivot(long, ["year", "month"], "code", "value", values=td.ORDER_PRIORITIES, agg="strict_mean")
    return rounded(wide, 4)


# ---------------------------------------------------------- price fact and marts ----

@register("entity_year_summary", "WITH " + PF + """
SELECT entity, year, count(*) AS sessions, round(avg(price), 6) AS avg_price, min(price) AS min_price,
       max(price) AS max_price, round((max(price) - min(price)) * 100.0 / min(price), 6) AS range_volatility_pct
FROM pf GROUP BY ALL""")
def q_entity_year_summary(spark, sf_dir):
    """Sessions, price statistics and range volatility per (entity, year)."""
    return rounded(marts.entity_year_summary(td.price_fact(spark, sf_dir)), 6, only=["avg_price", "range_volatility_pct"])


@register("finance_by_year", "WITH " + PF + """
SELECT year, round(avg(price), 6) AS avg_price, round(stddev_samp(change_pct), 6) AS change_sd FROM pf GROUP BY year""")
def q_finance_by_year(spark, sf_dir):
    """Mean price and sample sd of the change per year."""
    return rounded(marts.finance_by_year(td.price_fact(spark, sf_dir)))


@register("volatility_by_entity", "WITH " + PF + """
SELECT entity, round(stddev_samp(change_pct), 6) AS change_sd, count(change_pct) AS n_changes FROM pf GROUP BY entity""")
def q_volatility_by_entity(spark, sf_dir):
    """Volatility (sd of change) per entity."""
    return rounded(marts.volatility_by_entity(td.price_fact(spark, sf_dir)))


@register("prices_with_panel", "WITH " + PF + ", " + OYL + """,
panel AS (SELECT year,
  """ + _cells("round(avg(value) FILTER (WHERE code = '{p}'), 4) AS \"{p}\"") + """
  FROM oyl GROUP BY year)
SELECT pf.year, pf.entity, strftime(pf.trade_date, '%Y-%m-%d') AS trade_date, pf.price, """ + ", ".join(f'panel."{p}"' for p in PRIOS) + """
FROM pf LEFT JOIN panel ON pf.year = panel.year""")
def q_prices_with_panel(spark, sf_dir):
    """Daily facts left-joined to the annual panel (one row per year, checked; broadcast after its size is measured)."""
    prices = td.price_fact(spark, sf_dir).select(
        "year", "entity", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"), "price")
    panel = rounded(td.priority_panel(spark, sf_dir, "mean"), 4)
    return marts.join_year_panel(prices, panel)


@register("master_dataset", "WITH " + PF + ", " + OYL + """,
panel AS (SELECT year,
  """ + _cells("arg_min(value, row_order) FILTER (WHERE code = '{p}' AND value IS NOT NULL) AS \"{p}\"") + """
  FROM oyl GROUP BY year),
fin AS (SELECT year, round(avg(price), 6) AS avg_price, round(stddev_samp(change_pct), 6) AS change_sd FROM pf GROUP BY year)
SELECT coalesce(panel.year, fin.year) AS year, """ + ", ".join(f'panel."{p}"' for p in PRIOS) + """, fin.avg_price, fin.change_sd
FROM panel FULL JOIN fin ON panel.year = fin.year""")
def q_master_dataset(spark, sf_dir):
    """Annual panel full-outer-joined with yearly finance aggregates."""
    panel = td.priority_panel(spark, sf_dir, "first")
    fin = rounded(marts.finance_by_year(td.price_fact(spark, sf_dir)))
    return marts.full_join_on([panel, fin], "year")


@register("three_way_by_year", """
WITH a AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS orders_total FROM orders GROUP BY 1),
b AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, round(sum(l_extendedprice), 2) AS lineitem_revenue FROM lineitem GROUP BY 1),
c AS (SELECT CAST(year(ts) AS INTEGER) AS year, round(sum(value), 2) AS events_value FROM events GROUP BY 1)
SELECT coalesce(a.year, b.year, c.year) AS year, orders_total, lineitem_revenue, events_value
FROM a FULL JOIN b ON a.year = b.year FULL JOIN c ON coalesce(a.year, b.year) = c.year""")
def q_three_way_by_year(spark, sf_dir):
    """Three yearly series, chained full outer joins on year."""
    o = td.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        round_to(F.sum("o_totalprice"), 2).alias("orders_total"))
    li = td.table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(
        round_to(F.sum("l_extendedprice"), 2).alias("lineitem_revenue"))
    ev = td.table(spark, sf_dir, "events").groupBy(F.year("ts").alias("year")).agg(
        round_to(F.sum("value"), 2).alias("events_value"))
    return marts.full_join_on([o, li, ev], "year")


@register("source_precedence", """
WITH s AS (SELECT s_nationkey AS nation, avg(s_acctbal) AS v FROM supplier GROUP BY 1),
c AS (SELECT c_nationkey AS nation, avg(c_acctbal) AS v FROM customer GROUP BY 1)
SELECT coalesce(s.nation, c.nation) AS nation, round(coalesce(s.v, c.v), 4) AS value,
       CASE WHEN s.v IS NOT NULL THEN 0 ELSE 1 END AS source_rank
FROM s FULL JOIN c ON s.nation = c.nation""")
def q_source_precedence(spark, sf_dir):
    """C4: supplier balance per nation where present, customer balance otherwise."""
    s = td.table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.avg("s_acctbal").alias("value"))
    c = td.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.avg("c_acctbal").alias("value"))
    return rounded(marts.precedence_merge([s, c], ["nation"]), 4)


@register("composite_index", """
WITH a0 AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1),
a AS (SELECT year, (total - lag(total) OVER (ORDER BY year)) / lag(total) OVER (ORDER BY year) * CAST(100.0 AS DOUBLE) AS growth FROM a0),
b AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_discount) * CAST(100.0 AS DOUBLE) AS u FROM lineitem GROUP BY 1)
SELECT year, round(growth, 6) AS growth, round(u, 6) AS u,
       round(greatest(CAST(8.0 AS DOUBLE), least(CAST(35.0 AS DOUBLE),
             CAST(18.0 AS DOUBLE) - CAST(0.8 AS DOUBLE) * growth + CAST(0.5 AS DOUBLE) * u)), 2) AS "index"
FROM a JOIN b USING (year) WHERE growth IS NOT NULL""")
def q_composite_index(spark, sf_dir):
    """C5 + B23: inner join on the key intersection, clipped and rounded linear index."""
    tot = td.table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        round_to(F.sum("o_totalprice"), 2).alias("total")).withColumn("series", F.lit(1))
    g = series.yoy_growth(tot, "series", "year", "total").filter(F.col("growth").isNotNull()).select("year", "growth")
    u = td.table(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(
        (F.avg("l_discount") * 100.0).alias("u"))
    expr = F.lit(18.0) - F.lit(0.8) * F.col("growth") + F.lit(0.5) * F.col("u")
    out = marts.composite_index(g, u, "year", expr, 8.0, 35.0, 2)
    return rounded(out, 6, only=["growth", "u"])


# --------------------------------------------------------------------- benchmark ----

NATION_PANEL = ONW + """,
p AS (SELECT n_name AS entity, r_name AS region, CAST(year(o_orderdate) AS INTEGER) AS year,
             sum(o_totalprice) AS revenue, CAST(count(*) AS DOUBLE) AS orders, avg(o_totalprice) AS avg_order
      FROM onw GROUP BY ALL),
l AS (SELECT entity, region, year, 'revenue' AS indicator, revenue AS value FROM p
      UNION ALL SELECT entity, region, year, 'orders', orders FROM p
      UNION ALL SELECT entity, region, year, 'avg_order', avg_order FROM p)"""


@register("benchmark_rank", "WITH " + NATION_PANEL + """,
s AS (SELECT indicator, max(year) AS year FROM l WHERE entity = 'NATION_7' AND value IS NOT NULL GROUP BY indicator),
sv AS (SELECT l.indicator, l.year, l.value AS subject_value, l.region AS subject_group
       FROM l JOIN s USING (indicator, year) WHERE l.entity = 'NATION_7'),
agg AS (SELECT l.indicator, l.year, any_value(sv.subject_value) AS subject_value, avg(l.value) AS world_avg,
               any_value(sv.subject_group) AS region,
               avg(CASE WHEN l.region = sv.subject_group THEN l.value END) AS group_avg,
               count(l.value) AS rank_out_of, count(*) FILTER (WHERE l.value > sv.subject_value) + 1 AS subject_rank
        FROM l JOIN sv ON l.indicator = sv.indicator AND l.year = sv.year
        WHERE l.value IS NOT NULL GROUP BY l.indicator, l.year)
SELECT indicator, year, round(subject_value, 4) AS subject_value, round(world_avg, 4) AS world_avg, region,
       round(group_avg, 4) AS group_avg, rank_out_of, subject_rank,
       round(subject_value / group_avg, 4) AS parity_ratio, subject_value / group_avg > 1 AS above_peer
FROM agg""")
def q_benchmark_rank(spark, sf_dir):
    """E2 rank, E3 latest non-null, D14 world/peer means, C9 subject vs peers, G15 parity."""
    b = marts.benchmark_rank(td.nation_panel(spark, sf_dir), td.SUBJECT_NATION)
    return rounded(marts.parity(b), 4)


@register("latest_rows", "WITH " + NATION_PANEL + """
SELECT entity, region, year, indicator, round(value, 4) AS value FROM l
WHERE year = (SELECT max(year) FROM l l2 WHERE l2.indicator = l.indicator)""")
def q_latest_rows(spark, sf_dir):
    """Every row of the latest year per indicator."""
    return rounded(marts.latest_rows(td.nation_panel(spark, sf_dir), ["indicator"]), 4)


@register("orphan_keys", """
WITH o1 AS (SELECT DISTINCT l.l_orderkey AS k FROM lineitem l ANTI JOIN orders o ON l.l_orderkey = o.o_orderkey
            WHERE l.l_orderkey IS NOT NULL),
o2 AS (SELECT DISTINCT l.l_partkey AS k FROM lineitem l ANTI JOIN part p ON l.l_partkey = p.p_partkey
       WHERE l.l_partkey IS NOT NULL),
o3 AS (SELECT DISTINCT l.l_suppkey AS k FROM lineitem l ANTI JOIN supplier s ON l.l_suppkey = s.s_suppkey
       WHERE l.l_suppkey IS NOT NULL),
u AS (SELECT 'l_orderkey' AS fk, k FROM o1 UNION ALL SELECT 'l_partkey', k FROM o2 UNION ALL SELECT 'l_suppkey', k FROM o3),
r AS (SELECT fk, k, row_number() OVER (PARTITION BY fk ORDER BY k) AS rn FROM u),
f AS (SELECT * FROM (VALUES ('l_orderkey'), ('l_partkey'), ('l_suppkey')) t(fk))
SELECT f.fk, CAST(count(r.k) AS BIGINT) AS n_orphans,
       coalesce(string_agg(CAST(r.k AS VARCHAR), ',' ORDER BY r.k) FILTER (WHERE r.rn <= 10), '') AS sample
FROM f LEFT JOIN r ON f.fk = r.fk GROUP BY f.fk""")
def q_orphan_keys(spark, sf_dir):
    """Orphan foreign keys (anti join on distinct keys) with the 10 smallest as a sample."""
    from functools import reduce
    li = td.table(spark, sf_dir, "lineitem")
    parts = []
    for fk, ref, rc in (("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"),
                        ("l_suppkey", "supplier", "s_suppkey")):
        keys = li.select(F.col(fk).alias("k")).where(F.col("k").isNotNull()).distinct()
        orphans = keys.join(td.table(spark, sf_dir, ref).select(F.col(rc).alias("k")), "k", "left_anti")
        n = orphans.agg(F.count(F.lit(1)).alias("n_orphans")).select(
            F.lit(fk).alias("fk"), "n_orphans", F.lit(None).cast("string").alias("sample"))
        # top-k is the feature: TakeOrderedAndProject keeps 10 rows per task, then merges
        top = orphans.orderBy("k").limit(10).agg(
            F.array_join(F.transform(F.array_sort(F.collect_list("k")), lambda x: x.cast("string")), ",").alias("sample"))
        parts += [n, top.select(F.lit(fk).alias("fk"), F.lit(None).cast("long").alias("n_orphans"), "sample")]
    u = reduce(lambda a, b: a.unionByName(b), parts)
    return u.groupBy("fk").agg(F.max("n_orphans").alias("n_orphans"),
                               F.coalesce(F.max("sample"), F.lit("")).alias("sample"))


# ------------------------------------------------------------------ subject panels ----

@register("subject_panel", "WITH " + RAW_ORDERS + """
SELECT year,
  """ + ",\n  ".join(f"max(CASE WHEN code = '{p}' THEN value END) AS \"{p}\"" for p in PRIOS) + """
FROM clean WHERE (entity IS NULL OR entity = 'F') AND value IS NOT NULL GROUP BY year""")
def q_subject_panel(spark, sf_dir):
    """The subject's annual panel (NULL-entity rows plus the subject's own rows)."""
    from obsframe.plans.etl import macro_wide
    c = clean.clean_long(td.raw_orders_text(spark, sf_dir), "row_order", unique_order=True)
    return macro_wide(c, "F", agg="max")


@register("curated_panel", "WITH " + RAW_ORDERS + """,
w AS (SELECT year, max(CASE WHEN lower(code) = '1-urgent' THEN value END) AS "1-URGENT",
             max(CASE WHEN lower(code) = '5-low' THEN value END) AS "5-LOW"
      FROM clean WHERE (entity IS NULL OR entity = 'F') AND value IS NOT NULL
        AND lower(code) IN ('1-urgent', '5-low', 'no-such-code') GROUP BY year)
SELECT * FROM w WHERE "1-URGENT" IS NOT NULL AND "5-LOW" IS NOT NULL""")
def q_curated_panel(spark, sf_dir):
    """Curated codes (case-insensitive, absent ones ignored), complete years only."""
    from obsframe.plans.etl import macro_wide
    c = clean.clean_long(td.raw_orders_text(spark, sf_dir), "row_order", unique_order=True)
    return macro_wide(c, "F", codes=["1-URGENT", "5-low", "NO-SUCH-CODE"], agg="max", complete_cases=True)


# ------------------------------------------------------------ typed views and ELT ----

@register("typed_price_view", """
SELECT CAST(l_suppkey AS VARCHAR) AS entity, strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS trade_date,
       l_extendedprice / l_quantity AS price, l_quantity AS volume, (l_discount - l_tax) * CAST(100.0 AS DOUBLE) AS change_pct,
       CAST(year(l_shipdate) AS INTEGER) AS year
FROM lineitem""")
def q_typed_price_view(spark, sf_dir):
    """B27 + B17: all-text price rows -> typed view (DOUBLE measures, DATE, year of the date)."""
    li = td.table(spark, sf_dir, "lineitem")
    raw = li.select(F.col("l_suppkey").cast("string").alias("bank"),
                    F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
                    F.try_divide("l_extendedprice", "l_quantity").cast("string").alias("Price"),
                    F.col("l_quantity").cast("string").alias("Volume"),
                    ((F.col("l_discount") - F.col("l_tax")) * 100.0).cast("string").alias("Change_pct"))
    typed = marts.typed_prices(raw, "bank", "date", ["Price", "Volume", "Change_pct"])
    return typed.select("entity", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"), "price",
                        "volume", "change_pct", "year")


@register("peer_share", "WITH " + NATION_PANEL + """,
g AS (SELECT indicator, year, region, avg(value) AS region_avg FROM l WHERE value IS NOT NULL GROUP BY ALL)
SELECT l.indicator, l.year, round(avg(CASE WHEN l.value IS NULL OR g.region_avg IS NULL THEN NULL
                                        WHEN l.value > g.region_avg THEN 1.0 ELSE 0.0 END), 6) AS share_above_peer,
       count(l.value) AS n
FROM l JOIN g ON l.indicator = g.indicator AND l.year = g.year AND l.region = g.region
GROUP BY l.indicator, l.year""")
def q_peer_share(spark, sf_dir):
    """Share of entities above their peer-group mean, per indicator and year (NULL-aware)."""
    p = td.nation_panel(spark, sf_dir)
    g = p.filter(F.col("value").isNotNull()).groupBy("indicator", "year", "region").agg(
        F.avg("value").alias("region_avg"))
    j = p.join(g, ["indicator", "year", "region"])
    above = F.when(F.col("value").isNull() | F.col("region_avg").isNull(), None).otherwise(
        (F.col("value") > F.col("region_avg")).cast("double"))
    return rounded(j.groupBy("indicator", "year").agg(F.avg(above).alias("share_above_peer"),
                                                      F.count("value").alias("n")))


ELT_SUPPLIER_YEAR = """
SELECT CAST(l_suppkey AS STRING) AS supplier, CAST(year(l_shipdate) AS INT) AS ship_year, count(*) AS n_lines,
       avg(l_extendedprice / l_quantity) AS unit_price_mean, min(l_extendedprice / l_quantity) AS unit_price_low,
       max(l_extendedprice / l_quantity) AS unit_price_high,
       (max(l_extendedprice / l_quantity) - min(l_extendedprice / l_quantity)) * 100.0
             / min(l_extendedprice / l_quantity) AS unit_price_range_pct
FROM {src} GROUP BY 1, 2"""


@register("elt_bank_annual", "SELECT supplier, ship_year, n_lines, round(unit_price_mean, 6) AS unit_price_mean, unit_price_low, "
          "unit_price_high, round(unit_price_range_pct, 6) AS unit_price_range_pct FROM (" + ELT_SUPPLIER_YEAR.format(src="lineitem") + ")")
def q_elt_bank_annual(spark, sf_dir):
    """Raw scan registered as a view, transform in Spark SQL (the ELT form of D7)."""
    from obsframe.plans.etl import elt_sql
    out = elt_sql(spark, {"raw_prices": td.table(spark, sf_dir, "lineitem")}, ELT_SUPPLIER_YEAR.format(src="raw_prices"))
    return rounded(out, 6, only=["unit_price_mean", "unit_price_range_pct"])


@register("elt_long", "WITH " + LONG + "\nSELECT * FROM long WHERE value IS NOT NULL")
def q_elt_long(spark, sf_dir):
    """The long table in generated SQL over raw views, NULL values left out."""
    from obsframe.plans.etl import elt_long
    raw = [{"view": "raw_lineitem", "source": "tpch", "dataset": "lineitem", "entity": "supplier", "year": "ship_year"},
           {"view": "raw_nation_totals", "source": "tpch", "dataset": "orders_by_nation", "entity": "nation"}]
    return elt_long(spark, raw, {"raw_lineitem": td.lineitem_wide(spark, sf_dir), "raw_nation_totals": td.nation_totals_wide(spark, sf_dir)})
