"""Declarative data-quality rules compiled into one aggregation per table.

A suite is a list of rule dicts, e.g.::

    [{"check": "not_null", "columns": ["year"], "max_pct": 5.0},
     {"check": "unique", "columns": ["id"]},
     {"check": "range", "column": "value", "min": 0, "max": 100},
     {"check": "volume", "min": 10, "max": 1000},
     {"check": "non_constant", "exclude": ["year"]},
     {"check": "correlation", "a": "x", "b": "y", "min_abs": 0.3},
     {"check": "freshness", "column": "trade_date", "max_age_days": 7, "as_of": "2024-02-01"},
     {"check": "schema", "expected": ["id", "value"]},
     {"check": "referential", "column": "fk", "ref": ref_df, "ref_column": "id"}]

Every data rule of a table becomes aggregate expressions of ONE ``agg`` (one scan,
partial aggregation); all uniqueness and referential rules share one more pass over the key
columns, where ``max_duplicates`` and ``max_orphans`` allow some (0 by default); schema rules read metadata only. The result has one row per test:
``table_name, test, check, column_name, passed, observed, bound_low, bound_high, details, message``; ``details`` holds
counts below and above a range, unreadable dates, missing and extra columns, and the ten smallest orphans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsframe.functions.columns import col_ref, nan_to_null, round_to, year_end_date
from obsframe.functions.stats import guarded_corr
from obsframe.schema import CHECK_RESULT_SCHEMA, NULL_PCT_MAX

_ORDERABLE = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _row(table: str, test: str, check: str, column: str | None, observed: Column, passed: Column,
         lo=None, hi=None, details: Column | None = None) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(test).alias("test"), F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column_name"), F.coalesce(passed, F.lit(False)).alias("passed"),
        observed.cast("double").alias("observed"),
        F.lit(lo).cast("double").alias("bound_low"), F.lit(hi).cast("double").alias("bound_high"),
        (F.lit(None) if details is None else details).cast("string").alias("details"))


def _date_of(df: DataFrame, column: str) -> Column:
    dtype = df.schema[column].dataType
    c = col_ref(column)
    if isinstance(dtype, T.IntegralType):
        return year_end_date(c)
    return F.coalesce(c.try_cast("date"), F.try_to_timestamp(c.cast("string")).cast("date"))


def compile_rules(df: DataFrame, table: str, rules: list[dict]):
    """Split rules into (aggregate-phase metrics, post-aggregate result structs, side results)."""
    aggs: dict[str, Column] = {}
    rows: list = []
    keyed: list[tuple] = []
    meta: list[tuple] = []
    cols = set(df.columns)
    spark = df.sparkSession

    def metric(_label, expr):
        name = f"_m{len(aggs)}"
        aggs[name] = expr
        return F.col(name)

    n = metric("_n", F.count(F.lit(1)))
    for ri, r in enumerate(rules):
        kind = r["check"]
        if kind == "not_null":
            mx = r.get("max_pct", NULL_PCT_MAX)
            for c in r["columns"]:
                if c not in cols:
                    meta.append((table, f"{table}.{c}_exists", "exists", c, False, None, None, None, None))
                    continue
                nulls = metric(f"_nn{ri}_{c}", F.count_if(col_ref(c).isNull()))
                pct = F.try_divide(nulls * 100.0, n)
                rows.append(_row(table, f"{table}.{c}_not_null", kind, c, pct, pct < mx, None, mx))
        elif kind == "unique":
            for c in r["columns"]:
                if c not in cols:
                    continue
                keyed.append(("unique", c, r.get("max_duplicates", 0), None, None))
        elif kind == "range":
            c = r["column"]
            if c not in cols:
                continue
            lo, hi = r["min"], r["max"]
            below = metric(f"_rl{ri}", F.count_if(col_ref(c) < F.lit(lo)))
            above = metric(f"_rh{ri}", F.count_if(col_ref(c) > F.lit(hi)))
            rows.append(_row(table, f"{table}.{c}_range", kind, c, below + above, below + above == 0, lo, hi,
                             F.concat(F.lit("below="), below, F.lit(";above="), above)))
        elif kind == "volume":
            lo, hi = r["min"], r["max"]
            rows.append(_row(table, f"{table}_volume", kind, None, n, n.between(lo, hi), lo, hi))
        elif kind == "non_constant":
            excl = set(r.get("exclude", []))
            for f in df.schema.fields:
                if f.name in excl or not isinstance(f.dataType, _ORDERABLE):
                    continue
                c = col_ref(f.name)
                cnt = metric(f"_cc{ri}_{f.name}", F.count(c))
                same = metric(f"_cs{ri}_{f.name}", F.min(c) == F.max(c))
                distinct_le1 = F.when(cnt == 0, 0).when(same, 1).otherwise(2)
                rows.append(_row(table, f"{table}.{f.name}_non_constant", kind, f.name, distinct_le1,
                                 distinct_le1 > 1, 2, None))
        elif kind == "correlation":
            a, b = r["a"], r["b"]
            if a not in cols or b not in cols:
                continue
            rho = metric(f"_co{ri}", guarded_corr(col_ref(a), col_ref(b)))
            mn = r["min_abs"]
            rows.append(_row(table, f"{table}.{a}_{b}_correlation", kind, f"{a},{b}", rho, F.abs(rho) >= mn, mn, None))
        elif kind == "freshness":
            c = r["column"]
            if c not in cols:
                continue
            latest = metric(f"_fr{ri}", F.max(_date_of(df, c)))
            unread = metric(f"_fu{ri}", F.count_if(col_ref(c).isNotNull() & _date_of(df, c).isNull()))
            age = F.datediff(F.to_date(F.lit(r["as_of"])), latest)
            mx = r["max_age_days"]
            # a value that is no date fails the rule
            rows.append(_row(table, f"{table}_freshness", kind, c, age, (age <= mx) & (unread == 0), None, mx,
                             F.concat(F.lit("unreadable="), unread)))
        elif kind == "schema":
            expected = list(r["expected"])
            missing = [c for c in expected if c not in cols]
            extra = sorted(cols - set(expected))
            meta.append((table, f"{table}_schema", "schema", None, not missing, float(len(missing)), 0.0, 0.0,
                         f"missing={','.join(missing)};extra={','.join(extra)}"))
        elif kind == "referential":
            c, ref, rc = r["column"], r["ref"], r["ref_column"]
            if c not in cols or rc not in ref.columns:
                continue
            keyed.append(("referential", c, r.get("max_orphans", 0), ref, rc))
        else:
            raise ValueError(f"unknown check {kind!r}")
    side = [_key_rules(df, table, keyed)] if keyed else []
    return aggs, rows, side, meta, spark


def _common(a: T.DataType, b: T.DataType) -> str:
    """The type in which a key and a reference of another type are compared."""
    if a == b:
        return "string"
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return "bigint"
    return "double" if isinstance(a, T.NumericType) and isinstance(b, T.NumericType) else "string"


def _text(c: Column, kind: str, dtype: T.DataType) -> Column:
    if kind == "double" or isinstance(dtype, (T.FloatType, T.DoubleType)):
        c = c.cast("double") + F.lit(0.0)  # minus zero is zero
    return (c if kind == "string" else c.cast(kind)).cast("string")


def _key_rules(df: DataFrame, table: str, keyed: list[tuple]) -> DataFrame:
    """All uniqueness and referential rules of a table from one pass over its key columns.

    One ``Expand`` gives a row per row and rule (rule number, key as text), counted per key with map-side combine; the
    counts meet all references, one table of (rule number, key), in one left join. Duplicates, orphans and the least
    orphans all read that result, whose shuffles Spark reuses, so the facts are scanned and shuffled once.
    """
    entries, refs = [], None
    for i, (_kind, c, _most, ref, rc) in enumerate(keyed):
        mine = df.schema[c].dataType
        kind = _common(mine, ref.schema[rc].dataType) if ref is not None else "string"
        entries.append(F.struct(F.lit(i).alias("i"), _text(col_ref(c), kind, mine).alias("k")))
        if ref is not None:
            theirs = ref.select(F.lit(i).alias("ri"), _text(col_ref(rc), kind, ref.schema[rc].dataType).alias("rk")).where("rk IS NOT NULL")
            refs = theirs if refs is None else refs.unionByName(theirs)
    names = sorted({c for _kind, c, *_ in keyed})
    counted = df.select(*[col_ref(c) for c in names]).select(F.inline(F.array(*entries))).groupBy("i", "k").agg(F.count(F.lit(1)).alias("c"))
    found = counted.withColumn("ri", F.col("i") if refs is None else F.lit(None).cast("int"))
    if refs is not None:
        found = counted.join(refs.distinct(), (F.col("i") == F.col("ri")) & (F.col("k") == F.col("rk")), "left")
    checked = F.col("i").isin([i for i, x in enumerate(keyed) if x[0] == "referential"])
    orphan = checked & F.col("k").isNotNull() & F.col("ri").isNull()
    rules = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(kind).alias("check"), F.lit(c).alias("column_name"),
                               F.lit(float(most)).alias("most")) for i, (kind, c, most, *_r) in enumerate(keyed)])
    # the ten least orphans of a rule: every task keeps ten before the shuffle
    number = F.col("k").try_cast("double")
    rank = F.row_number().over(Window.partitionBy("i").orderBy(number.asc_nulls_last(), "k"))
    per_rule = found.groupBy("i").agg(F.sum(F.col("c") - 1).alias("dups"), F.count_if(orphan).alias("orphans"))
    # a condition on the count stays above the aggregation, so both branches have the same shuffle below
    least = (found.where(F.when(F.col("c") > 0, orphan)).select("i", "k", rank.alias("at")).where("at <= 10").groupBy("i")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "k"))), lambda x: x["k"]), ",").alias("s")))
    listed = df.sparkSession.range(1).select(F.inline(rules))  # one row per rule, also over an empty table
    seen = F.coalesce(F.when(F.col("check") == "unique", F.col("dups")).otherwise(F.col("orphans")), F.lit(0))
    return listed.join(per_rule, "i", "left").join(least, "i", "left").select(
        F.lit(table).alias("table_name"), F.concat(F.lit(f"{table}."), "column_name", F.lit("_"), "check").alias("test"),
        "check", "column_name", (seen <= F.col("most")).alias("passed"), seen.cast("double").alias("observed"),
        F.lit(0.0).alias("bound_low"), F.col("most").alias("bound_high"),
        F.when(F.col("check") == "referential", F.concat(F.lit("sample="), F.coalesce("s", F.lit("")))).alias("details"))


def run_suite(df: DataFrame, table: str, rules: list[dict]) -> DataFrame:
    """Evaluate a rule suite on one table; non-constant rules record failures only. NaN counts as missing."""
    return _evaluate(df, table, rules, {})[0]


def run_suite_with(df: DataFrame, table: str, rules: list[dict], extra: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """``run_suite``, and the row of ``extra`` aggregates computed in the same pass over the table (checkpointed)."""
    return _evaluate(df, table, rules, extra)


def _evaluate(df: DataFrame, table: str, rules: list[dict], extra: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    df = nan_to_null(df)
    aggs, rows, side, meta, spark = compile_rules(df, table, rules)
    parts = []
    one = df.agg(*[e.alias(k) for k, e in (aggs | extra).items()])
    if extra:
        from obsframe.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(spark)
        one = one.checkpoint(eager=True)  # one row
    if rows:
        res = one.select(F.inline(F.array(*rows)))
        res = res.filter(~((F.col("check") == "non_constant") & F.col("passed")))
        parts.append(res)
    if meta:
        parts.append(spark.createDataFrame(meta, CHECK_RESULT_SCHEMA))
    parts.extend(side)
    found = reduce(lambda a, b: a.unionByName(b), parts) if parts else spark.createDataFrame([], CHECK_RESULT_SCHEMA)
    verdict = F.when(F.col("passed"), "passed").otherwise("failed")
    return found.withColumn("message", F.concat_ws(" ", "test", verdict)), one


def summary(results: DataFrame) -> DataFrame:
    """total, passed, failed, pass_rate (1 decimal, 0 when nothing ran) and ``ok``.

    ``ok`` is false when nothing was checked: an empty suite is not a pass.
    """
    g = results.agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"))
    return g.select(
        "total", "passed", (F.col("total") - F.col("passed")).alias("failed"),
        F.coalesce(round_to(F.try_divide(F.col("passed") * 100.0, F.col("total")), 1), F.lit(0.0)).alias("pass_rate"),
        ((F.col("total") > 0) & (F.col("passed") == F.col("total"))).alias("ok"))
