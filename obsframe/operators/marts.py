"""Marts: price/finance aggregates, panel joins, source precedence, benchmark and rank."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.functions.columns import round_to, year_of
from obsframe.operators.joins import measured_broadcast


# ---- price fact and finance aggregates ---------------------------------------------------

def typed_prices(raw: DataFrame, entity: str = "bank", date: str = "date",
                 measures: Sequence[str] = ("Price", "Open", "High", "Low", "Volume", "Change_pct")) -> DataFrame:
    """Typed price view: lower-case names, DOUBLE measures, DATE trade_date and its year."""
    from obsframe.functions.columns import safe_double
    present = [m for m in measures if m in raw.columns]
    d = F.col(date)
    return raw.select(
        F.col(entity).cast("string").alias("entity"),
        F.coalesce(d.try_cast("date"), F.try_to_timestamp(d.cast("string")).cast("date")).alias("trade_date"),
        *[safe_double(m).alias(m.lower()) for m in present],
    ).withColumn("year", year_of("trade_date"))


def entity_year_summary(prices: DataFrame, price: str = "price") -> DataFrame:
    """Per (entity, year): sessions, mean/min/max price, range volatility 100*(max-min)/min."""
    p = F.col(price)
    g = prices.groupBy("entity", "year").agg(
        F.count(F.lit(1)).alias("sessions"), F.avg(p).alias("avg_price"),
        F.min(p).alias("min_price"), F.max(p).alias("max_price"))
    return g.withColumn("range_volatility_pct",
                        F.try_divide((F.col("max_price") - F.col("min_price")) * 100.0, F.col("min_price")))


def finance_by_year(prices: DataFrame, price: str = "price", change: str = "change_pct") -> DataFrame:
    """Per year: mean price and sample sd of the daily change."""
    return prices.groupBy("year").agg(F.avg(price).alias("avg_price"),
                                      F.stddev_samp(change).alias("change_sd"))


def volatility_by_entity(prices: DataFrame, change: str = "change_pct") -> DataFrame:
    """Per entity: sample sd of the daily change (the 'volatility' ranking)."""
    return prices.groupBy("entity").agg(F.stddev_samp(change).alias("change_sd"),
                                        F.count(change).alias("n_changes"))


# ---- joins -------------------------------------------------------------------------------

def join_year_panel(facts: DataFrame, panel: DataFrame) -> DataFrame:
    """Many-to-one left join of daily facts to an annual panel on ``year``; every panel row takes part.

    The panel is checkpointed, must have one row per year (else ``ValueError``: a repeated year would
    multiply facts), and is broadcast when its measured size is small, so the fact side is not shuffled.
    """
    side = measured_broadcast(panel)
    twice = side.groupBy("year").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError("the annual panel has several rows for one year")
    return facts.join(side, on="year", how="left")


def full_join_on(frames: Sequence[DataFrame], on: str | Sequence[str] = "year") -> DataFrame:
    """Chained full outer joins on the same key (union of keys, key columns coalesced)."""
    on = [on] if isinstance(on, str) else list(on)
    return reduce(lambda a, b: a.join(b, on=on, how="full"), frames)


def precedence_merge(frames: Sequence[DataFrame], keys: Sequence[str], value: str = "value") -> DataFrame:
    """Union of keys; for each key the value of the first frame (highest precedence) that has one.

    Planned as union + ``min_by(value, priority)``: one shuffle, partial aggregation.
    """
    tagged = [f.select(*keys, F.col(value).alias("_v"), F.lit(i).alias("_prio")).filter(F.col("_v").isNotNull())
              for i, f in enumerate(frames)]
    u = reduce(lambda a, b: a.unionByName(b), tagged)
    return u.groupBy(*keys).agg(F.min_by("_v", "_prio").alias(value),
                                F.min("_prio").alias("source_rank"))


def composite_index(a: DataFrame, b: DataFrame, on: str, expr, lo: float, hi: float,
                    digits: int = 2, out: str = "index") -> DataFrame:
    """Inner join on the key intersection, then ``round(clip(expr, lo, hi), digits)``."""
    j = a.join(b, on=on, how="inner")
    return j.withColumn(out, round_to(F.greatest(F.lit(lo), F.least(F.lit(hi), expr)), digits))


# ---- benchmark ---------------------------------------------------------------------------

def latest_nonnull(long: DataFrame, keys: Sequence[str], t: str = "year", value: str = "value") -> DataFrame:
    """Per key: the last period with a value and that value (max_by over non-null rows)."""
    v = F.col(value)
    return (long.filter(v.isNotNull()).groupBy(*keys)
                .agg(F.max(t).alias(t), F.max_by(v, F.col(t)).alias(value)))


def latest_rows(long: DataFrame, keys: Sequence[str], t: str = "year") -> DataFrame:
    """All rows of the latest period per key (aggregate + join, not a whole-group window)."""
    last = long.groupBy(*keys).agg(F.max(t).alias("_tmax"))
    return long.join(last, on=list(keys), how="inner").filter(F.col(t) == F.col("_tmax")).drop("_tmax")


def benchmark_rank(panel: DataFrame, subject: str, indicator: str = "indicator", entity: str = "entity",
                   group: str = "region", t: str = "year", value: str = "value",
                   descending: bool = True) -> DataFrame:
    """Subject against the world and its peer group in the subject's latest year.

    Output per indicator: year, subject value, world mean, subject's group, group
    mean, population size (non-null values that year) and competition rank
    (1 + number of strictly better values; NULL if the subject has no value).

    Plan: the subject's latest non-null row per indicator (small) is joined to
    the facts of that indicator and year, then one grouped aggregation counts and
    averages. No window over all entities of a year, so a huge (indicator, year)
    group is pre-reduced by partial aggregation.
    """
    v = F.col(value)
    facts = panel.filter(v.isNotNull()).select(indicator, entity, group, t, value)
    subj = (facts.filter(F.col(entity) == F.lit(subject))
                 .groupBy(indicator)
                 .agg(F.max(t).alias(t),
                      F.max_by(F.struct(v.alias("subject_value"), F.col(group).alias("subject_group")),
                               F.col(t)).alias("_s"))
                 .select(indicator, t, "_s.subject_value", "_s.subject_group"))
    j = facts.join(subj, on=[indicator, t], how="inner")
    sv = F.col("subject_value")
    better = (v > sv) if descending else (v < sv)
    in_group = F.col(group) == F.col("subject_group")
    # subject value and group are constant within (indicator, year): grouping by them keeps
    # every aggregate buffer fixed-width, so the plan stays a hash aggregate with partials
    g = j.groupBy(indicator, t, "subject_value", "subject_group").agg(
        F.avg(v).alias("world_avg"),
        F.avg(F.when(in_group, v)).alias("group_avg"),
        F.count(v).alias("rank_out_of"),
        (F.count_if(better) + 1).cast("long").alias("subject_rank"),
    )
    return g.select(indicator, t, "subject_value", "world_avg", F.col("subject_group").alias(group),
                    "group_avg", "rank_out_of", "subject_rank")


def parity(bench: DataFrame, subject_col: str = "subject_value", peer_col: str = "group_avg") -> DataFrame:
    """Subject / peer ratio and a flag for ratio > 1."""
    r = F.try_divide(F.col(subject_col), F.col(peer_col))
    return bench.withColumn("parity_ratio", r).withColumn("above_peer", r > 1)
