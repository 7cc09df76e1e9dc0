"""End-to-end batch ETL: sources -> long -> clean -> marts -> checks, written as Parquet tables.

Every stage's output is written to the warehouse folder and read back before the
next stage uses it: that is the zone promotion (staging -> clean -> marts) and it
cuts the lineage, so a lost executor only recomputes from the last written table.
The folder must be shared storage on a cluster.

Each run writes its zones into a folder of its own, ``versions/<run id>``. A run whose stages all succeed adds one row to the
``published`` table, and that row is the switch: ``load`` and the views read the newest published version, so a
failed or unfinished run leaves the last good one as it is, and readers never see half of a run. ``prune`` drops old versions.
"""

from __future__ import annotations

import datetime as dt
import os
import re
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.operators import alerts, checks, clean, marts, quality, reshape
from obsframe.schema import CURATED_CODES, LONG_COLUMNS, VALID_YEAR_MAX, VALID_YEAR_MIN, YEAR_SUFFIX_PATTERN
from obsframe.session import ensure_checkpoint_dir
from obsframe.sources.readers import ROW_ORDER
from obsframe.sources.registry import SourceSpec, indicators_long
from obsframe.sources.sinks import register_views, write_warehouse

# minutes allowed per zone of this pipeline (stage latency SLA)
ZONE_BUDGET_MINUTES = {"staging": 10, "clean": 5, "marts": 5, "checks": 5}

# fixed values: the snapshot's output names and the codes they read
SNAPSHOT_CODES = {"pib_usd_m": "NGDPD", "croissance_pib": "NGDP_RPCH", "inflation": "PCPIPCH",
                  "dette_publique_pib": "GGXWDG_NGDP", "balance_courante_pib": "BCA_NGDPD", "chomage": "LUR"}

# fixed values: columns of the price views, as queries on them expect
PRICE_VIEW = {"bank": "entity", "trade_date": "trade_date", "price": "price", "open": "open", "high": "high", "low": "low",
              "volume": "volume", "change_pct": "change_pct"}
PRICE_YEAR_VIEW = {"bank": "entity", "annee": "year", "seances": "sessions", "prix_moyen": "avg_price", "prix_min": "min_price",
                   "prix_max": "max_price", "volatilite_pct": "range_volatility_pct"}

RUN_LOG_SCHEMA = ("run_id string, stage string, table_name string, event string, started timestamp, ended timestamp, "
                  "ok boolean, rows long, message string")


PUBLISHED_SCHEMA = "version long, run_id string, published timestamp, tables map<string,string>"


class StageRuns:
    """Writes the tables of one run below its own version folder and keeps its events; each run has its own."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run_id, self.events = spark, root, uuid.uuid4().hex[:12], []
        self.started = dt.datetime.now()
        self.tables: dict[str, DataFrame] = {}
        self.places: dict[str, str] = {}

    def write(self, df: DataFrame, name: str, key: str | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write one table of a zone and read it back (lineage cut); a failure is logged before it is raised again."""
        zone, table = name.split("/")
        path, started = _version_path(self.root, self.run_id, name), dt.datetime.now()
        try:
            write_warehouse(df, path, partition_by)
        except Exception as e:
            self.events.append((self.run_id, zone, table, "FAILED", started, dt.datetime.now(), False, None, str(e)[:500]))
            raise
        back = self.spark.read.parquet(path)
        rows = back.count()  # Parquet footers only
        self.events.append((self.run_id, zone, table, "WRITTEN", started, dt.datetime.now(), True, rows, None))
        self.tables[key or table], self.places[key or table] = back, name
        return back

    def publish(self) -> int:
        """Make this run's tables the current version: one row, written as one file, is the switch."""
        last = published(self.spark, self.root).agg(F.max("version")).first()[0] or 0
        row = [(last + 1, self.run_id, dt.datetime.now(), self.places)]
        self.spark.createDataFrame(row, PUBLISHED_SCHEMA).coalesce(1).write.mode("append").parquet(os.path.join(self.root, "published"))
        return last + 1

    def close(self, ok: bool, message: str | None = None) -> DataFrame:
        """Store the run's events, with its start and end, below ``run_log``."""
        now = dt.datetime.now()
        rows = [(self.run_id, "run", None, "START", self.started, None, None, None, None), *self.events,
                (self.run_id, "run", None, "END" if ok else "FAILED", self.started, now, ok, None, message)]
        log = self.spark.createDataFrame(rows, RUN_LOG_SCHEMA)
        log.coalesce(1).write.mode("append").parquet(os.path.join(self.root, "run_log"))
        return log


def _version_path(root: str, run_id: str, name: str = "") -> str:
    return os.path.join(root, "versions", run_id, name) if name else os.path.join(root, "versions", run_id)


def published(spark: SparkSession, root: str) -> DataFrame:
    """The published versions below ``root`` (``PUBLISHED_SCHEMA``); none before the first run that succeeded."""
    try:
        return spark.read.schema(PUBLISHED_SCHEMA).parquet(os.path.join(root, "published"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED_SCHEMA)


def load(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the newest published version, or of ``version``. Of two runs that published at once under one number, the later one counts."""
    found = published(spark, root)
    found = found if version is None else found.where(F.col("version") == version)
    row = found.orderBy(F.desc("version"), F.desc("published"), F.desc("run_id")).first()
    if row is None:
        raise LookupError(f"no published version {'' if version is None else str(version) + ' '}below {root}")
    return {k: spark.read.parquet(_version_path(root, row["run_id"], place)) for k, place in row["tables"].items()}


def prune(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the folders of published versions but the newest ``keep``, and of runs logged as failed; returns their run ids.

    Runs that are neither published nor failed may still be going on and stay. The tables of runs are few, so is this list."""
    if keep < 1:
        raise ValueError("the current version must be kept")
    runs = [r["run_id"] for r in published(spark, root).orderBy(F.desc("version"), F.desc("published"), F.desc("run_id")).select("run_id").collect()]
    log = spark.read.schema(RUN_LOG_SCHEMA).parquet(os.path.join(root, "run_log"))
    failed = [r["run_id"] for r in log.where("event = 'FAILED' AND stage = 'run'").select("run_id").distinct().collect()]
    gone = []
    for run_id in [*runs[keep:], *(f for f in failed if f not in runs)]:
        path = spark._jvm.org.apache.hadoop.fs.Path(_version_path(root, run_id))
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if store.exists(path) and store.delete(path, True):
            gone.append(run_id)
    return gone


def view_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The SQL surface over a version's tables (``run``'s or ``load``'s): view name -> DataFrame."""
    views = {"v_indicators_long": tables["indicators_long"].select(*LONG_COLUMNS), "v_economy_snapshot": tables["economy_snapshot"]}
    if "bank_prices" in tables:
        price = tables["bank_prices"]
        views["v_bank_prices"] = price.select(*[
            (F.col(c) if c in price.columns else F.lit(None).cast("double")).alias(n) for n, c in PRICE_VIEW.items()])
        views["v_bank_annual"] = tables["bank_annual"].select(*[F.col(c).alias(n) for n, c in PRICE_YEAR_VIEW.items()])
    return views


def macro_wide(clean_long: DataFrame, subject: str | None, codes: Sequence[str] | None = None,
               max_width: int = 1000, agg: str = "first", order_by: str | None = ROW_ORDER,
               complete_cases: bool = False) -> DataFrame:
    """Annual panel of the subject (NULL entity or the subject), one column per code.

    ``agg`` resolves several values of one (year, code): ``first`` non-null in
    ``order_by`` order, ``mean`` or ``max``. Codes that differ in case only are one column, named
    by their smallest spelling. ``codes`` restricts the columns (case-insensitive; absent codes
    are ignored) and is applied before the pivot so Catalyst prunes the rest; ``complete_cases``
    keeps years with every column. More than ``max_width`` codes raise: stay long then.
    """
    base = clean.subject_scope(clean_long, subject).filter(F.col("value").isNotNull())
    if codes is not None:
        base = clean.code_filter(base, codes)
    ensure_checkpoint_dir(base.sparkSession)
    # one row per (year, code), stored: the column list and the pivot both read it, so the upstream plan runs once
    cells = reshape.reduce_cells(base.withColumn("_k", F.lower("code")), ["year"], "_k", "value", agg, order_by if agg == "first" else None,
                                 [F.min("code").alias("spelling")]).checkpoint(eager=True)
    spelt = cells.groupBy("_k").agg(F.min("spelling").alias("code")).limit(max_width + 1).collect()
    if len(spelt) > max_width:
        raise ValueError(f"the panel would exceed {max_width} columns; stay long")
    names = {r["_k"]: r["code"] for r in sorted(spelt)}
    wide = reshape.pivot(cells, "year", "_k", "_cell", values=list(names), names=names, agg="max", max_width=max_width)
    return wide.dropna("any") if complete_cases else wide


def benchmarks(peers: dict[str, DataFrame], subject: str) -> DataFrame:
    """``marts.benchmark_rank`` of the subject in each peer source ``(indicator, entity, region, year, value)``, tagged
    with ``source``; a source without a ``region`` column gets NULL groups."""
    def ranked(name: str, panel: DataFrame) -> DataFrame:
        if "region" not in panel.columns:
            panel = panel.withColumn("region", F.lit(None).cast("string"))
        return marts.benchmark_rank(panel, subject).select(F.lit(name).alias("source"), "*")

    return reduce(DataFrame.unionByName, [ranked(n, p) for n, p in peers.items()])


def run(spark: SparkSession, specs: list[SourceSpec], out_dir: str, prices: DataFrame | None = None,
        subject: str | None = None, year_min: int = VALID_YEAR_MIN, year_max: int = VALID_YEAR_MAX,
        rules: list[dict] | None = None, snapshot_where: Column | None = None, peers: dict[str, DataFrame] | None = None,
        max_width: int = 1000, snapshot_codes: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Run the whole batch, publish it and return the written tables (read back from the run's version folder).

    Rows keep their order (source, file, position) from load to the marts, so keep-first dedup and
    ``first`` pivots give the same tables however tasks are dealt. ``snapshot_where`` scopes the
    economy snapshot (e.g. one source and its datasets), ``snapshot_codes`` names its columns and their codes; ``peers`` are the benchmark sources;
    ``max_width`` bounds the panels' columns. Also returns ``run_log`` (start, end and one event per
    written or failed table) and ``latency`` (zone durations against ``ZONE_BUDGET_MINUTES``). A
    failing stage stores the log under ``out_dir/run_log`` before its error goes on.
    """
    runs = StageRuns(spark, out_dir)
    try:
        _stages(runs, specs, prices, subject, year_min, year_max, rules, snapshot_where, peers, max_width, snapshot_codes or SNAPSHOT_CODES)
        runs.publish()
    except Exception as e:
        runs.close(False, str(e)[:500])
        raise
    out = dict(runs.tables)
    log = runs.close(True)
    per_zone = (log.where("event = 'WRITTEN'").groupBy("run_id", "stage")
                .agg(F.min("started").alias("started"), F.max("ended").alias("ended"),
                     F.min(F.col("ok").cast("int")).cast("boolean").alias("ok"), F.sum("rows").alias("rows")))
    budgets = spark.createDataFrame(list(ZONE_BUDGET_MINUTES.items()), "stage string, max_minutes int")
    out["run_log"] = log
    out["latency"] = alerts.latency_breaches(alerts.stage_events(per_zone), budgets)
    register_views(spark, view_tables(out))
    return out


def _stages(runs: StageRuns, specs: list[SourceSpec], prices: DataFrame | None, subject: str | None, year_min: int,
            year_max: int, rules: list[dict] | None, snapshot_where: Column | None, peers: dict[str, DataFrame] | None,
            max_width: int, snapshot_codes: dict[str, str]) -> None:
    by_source = ("source", "dataset")
    staged = runs.write(indicators_long(runs.spark, specs, keep_order=True), "staging/indicators_long", partition_by=by_source)
    runs.write(quality.dimension(staged), "staging/dim_indicators")
    cleaned = runs.write(clean.clean_long(staged, ROW_ORDER, year_min, year_max, keep_order=True), "clean/indicators_clean",
                         partition_by=by_source)
    runs.write(clean.complete(cleaned).drop("year_valid", "is_missing", ROW_ORDER), "clean/indicators_complete", partition_by=by_source)
    runs.write(quality.quality_report(cleaned), "clean/data_quality_report")
    runs.write(macro_wide(cleaned, subject, max_width=max_width), "marts/mart_macro_wide")
    runs.write(macro_wide(cleaned, subject, CURATED_CODES, max_width), "marts/curated_panel", "benchmark_panel")
    runs.write(reshape.snapshot(staged, "year", "code", snapshot_codes, where=snapshot_where), "marts/economy_snapshot")
    if peers:
        runs.write(benchmarks(peers, subject), "marts/benchmark")
    if prices is not None:
        price = runs.write(prices, "staging/bank_prices")
        # facts meet the panel of the NULL-entity rows, with every code
        national = runs.tables["mart_macro_wide"] if subject is None else runs.write(
            macro_wide(cleaned, None, max_width=max_width), "marts/mart_macro_national")
        runs.write(marts.join_year_panel(price, national), "marts/mart_banks_macro")
        runs.write(marts.entity_year_summary(price), "marts/bank_annual")
    if rules:
        runs.write(checks.run_suite(cleaned.drop(ROW_ORDER), "indicators_clean", rules), "checks/validation")


def elt_sql(spark: SparkSession, raw_views: dict[str, DataFrame], sql: str) -> DataFrame:
    """ELT form: register raw scans as views and express the transform in Spark SQL."""
    register_views(spark, raw_views)
    return spark.sql(sql)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def long_table_sql(spark: SparkSession, raw: list[dict]) -> str:
    """Spark SQL for the long table over registered raw views, made from the catalog's column lists.

    Each entry names ``view, source, dataset, entity`` and either ``year`` (every other column but ``ids`` is a
    measure) or no year (measures are the columns with a year suffix, whose name gives code and year). Every measure
    becomes rows tagged with its provenance; NULL values are left out. A view is read once, by one ``UNPIVOT``.
    """
    parts = []
    for r in raw:
        names = [f.name for f in spark.table(r["view"]).schema.fields]
        outside = {r["entity"], r.get("year"), *r.get("ids", ())}
        measures = [c for c in names if c not in outside and (r.get("year") or re.search(YEAR_SUFFIX_PATTERN, c))]
        if not measures:
            continue
        kept = [f"CAST({_quoted(r['entity'])} AS STRING) AS entity"]
        code, year = "column", "year"
        if r.get("year"):
            kept.append(f"CAST({_quoted(r['year'])} AS INT) AS year")
        else:
            code = f"regexp_replace(column, {_text(YEAR_SUFFIX_PATTERN)}, '')"
            year = f"CAST(regexp_extract(column, {_text(YEAR_SUFFIX_PATTERN)}, 1) AS INT)"
        kept += [f"TRY_CAST({_quoted(c)} AS DOUBLE) AS {_quoted('m_' + c)}" for c in measures]
        listed = ", ".join(f"{_quoted('m_' + c)} AS {_quoted(c)}" for c in measures)
        parts.append(f"SELECT {_text(r['source'])} AS source, {_text(r['dataset'])} AS dataset, {code} AS code, {code} AS name, entity, "
                     f"{year} AS year, value FROM (SELECT {', '.join(kept)} FROM {_quoted(r['view'])}) "
                     f"UNPIVOT EXCLUDE NULLS (value FOR column IN ({listed}))")
    if not parts:
        raise ValueError("no view has a measure")
    return "\nUNION ALL ".join(parts)


def elt_long(spark: SparkSession, raw: list[dict], frames: dict[str, DataFrame]) -> DataFrame:
    """The long table as ELT: raw frames become views, the catalog becomes SQL."""
    register_views(spark, frames)
    return spark.sql(long_table_sql(spark, raw))
