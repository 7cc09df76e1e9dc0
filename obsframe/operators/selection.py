"""Exact order statistics and quantiles of groups of any size, by repeated refinement.

A group is never sorted in one task. Each round takes equal-depth edges of every interval from a mergeable sketch,
counts the rows of each bin (and those equal to an edge) with map-side combine, and keeps only the bins
that hold a wanted rank. The sketch only places the edges; the counts are exact, so the result is too. A rank that
falls on an edge is settled at once, which ends heavy ties. When no interval has more than ``block`` rows, what is
left is counted per value and ranked. Each round leaves about 1/``BINS`` of an interval, stored as a checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsframe.session import ensure_checkpoint_dir

BINS = 64
STEP = 8
BLOCK = 100_000
MAX_ROUNDS = 40
BROADCAST_ROWS = 20_000


def _small(df: DataFrame) -> DataFrame:
    """A stored side of counted rows (a few hundred bytes each): broadcast if it is small, else joined plainly."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def order_statistics(df: DataFrame, by: str | Sequence[str], value: str, ranks: Callable[[Column], list[Column]],
                     block: int = BLOCK, bins: int = BINS) -> DataFrame:
    """Per group: the keys, ``n`` (non-null values) and the array ``stats`` of the values at the wanted ranks.

    ``ranks`` gives, from the column of the group's size, the ranks (from 1) to find. A group without a value has no
    row, a rank outside 1..n gives NULL, NaN ranks above every number, and a NULL key is a group of its own.
    """
    by = [by] if isinstance(by, str) else list(by)
    ensure_checkpoint_dir(df.sparkSession)
    rows = df.where(F.col(value).isNotNull()).select(F.struct(*by).alias("g"), F.lit("").alias("iv"), F.col(value).cast("double").alias("x"))
    shares = [i / bins for i in range(bins + 1)]
    edges_of = F.percentile_approx("x", shares, 20 * bins).alias("edges")
    intervals = rows.groupBy("g", "iv").agg(F.count("x").alias("n"), edges_of).checkpoint(eager=True)
    sizes = intervals.select("g", "n")
    targets = sizes.select("g", F.lit("").alias("iv"), F.posexplode(F.array(*[k.cast("long") for k in ranks(F.col("n"))])).alias("j", "k"))
    settled = []
    for _ in range(MAX_ROUNDS):
        if (intervals.agg(F.max("n")).first()[0] or 0) <= block:
            break
        # edges below x: among every STEP-th edge first, then among the STEP edges after those
        steps = intervals.select("g", "iv", "edges", F.filter("edges", lambda e, i: i % STEP == STEP - 1).alias("coarse"))
        past = rows.join(_small(steps), ["g", "iv"]).withColumn("skip", STEP * F.size(F.filter("coarse", lambda e: e < F.col("x"))))
        past = past.withColumn("m", F.col("skip") + F.size(F.filter(F.slice("edges", F.col("skip") + 1, F.lit(STEP)), lambda e: e < F.col("x"))))
        next_edge = F.get("edges", F.col("m"))
        on_edge = F.coalesce(next_edge == F.col("x"), F.lit(False))
        binned = past.select("g", "iv", (2 * F.col("m") + on_edge.cast("int")).alias("b"), F.when(on_edge, next_edge).alias("edge"))
        counts = binned.groupBy("g", "iv", "b").agg(F.count(F.lit(1)).alias("c"), F.max("edge").alias("edge"))
        upto = F.sum("c").over(Window.partitionBy("g", "iv").orderBy("b"))  # 2 * bins + 3 rows at most
        hits = (targets.join(counts.withColumn("upto", upto), ["g", "iv"])
                .where((F.col("k") <= F.col("upto")) & (F.col("k") > F.col("upto") - F.col("c")))
                .select("g", "iv", "b", "j", (F.col("k") - F.col("upto") + F.col("c")).alias("k"), "edge")).checkpoint(eager=True)
        settled.append(hits.where("edge IS NOT NULL").select("g", "j", F.col("edge").alias("x")))
        name = F.concat_ws(".", "iv", F.col("b").cast("string"))
        targets = hits.where("edge IS NULL").select("g", name.alias("iv"), "j", "k")
        m = (F.col("b") / 2).cast("int")
        wanted = (hits.where("edge IS NULL").select("g", "iv", "b").distinct().join(_small(steps), ["g", "iv"])
                  .select("g", "iv", name.alias("inner"), F.get("edges", m - 1).alias("lo"), F.get("edges", m).alias("hi")))
        inside = (F.col("lo").isNull() | (F.col("x") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("x") < F.col("hi")))
        rows = rows.join(_small(wanted), ["g", "iv"]).where(inside).select("g", F.col("inner").alias("iv"), "x").checkpoint(eager=True)
        intervals = rows.groupBy("g", "iv").agg(F.count("x").alias("n"), edges_of).checkpoint(eager=True)
    else:
        raise RuntimeError("selection did not settle")
    values = rows.groupBy("g", "iv", "x").agg(F.count(F.lit(1)).alias("c"))
    ranked = values.withColumn("upto", F.sum("c").over(Window.partitionBy("g", "iv").orderBy("x")))  # block rows at most
    found = targets.join(ranked, ["g", "iv"]).where((F.col("k") <= F.col("upto")) & (F.col("k") > F.col("upto") - F.col("c")))
    parts = found.select("g", "j", "x")
    for s in settled:
        parts = parts.unionByName(s)
    at = parts.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("j", "x"))).alias("m"))
    width = len(ranks(F.lit(1)))
    return sizes.join(at, "g", "left").select(*[F.col("g")[c].alias(c) for c in by], "n",
                                              F.array(*[F.try_element_at("m", F.lit(i)) for i in range(width)]).alias("stats"))


def quantiles(df: DataFrame, by: str | Sequence[str], value: str, shares: Sequence[float], block: int = BLOCK, bins: int = BINS) -> DataFrame:
    """Exact linear (R type 7) quantiles per group: the keys, ``n`` and the array ``q``."""
    def ranks(n: Column) -> list[Column]:
        at = [(n - 1) * F.lit(float(p)) + 1 for p in shares]
        return [r for h in at for r in (F.floor(h), F.ceil(h))]
    found = order_statistics(df, by, value, ranks, block, bins)
    keys = [by] if isinstance(by, str) else list(by)

    def at(i: int, p: float) -> Column:
        h = (F.col("n") - 1) * F.lit(float(p)) + 1  # as in ranks
        lo, hi = F.col("stats")[2 * i], F.col("stats")[2 * i + 1]
        return F.when(lo == hi, lo).otherwise((F.ceil(h) - h) * lo + (h - F.floor(h)) * hi)
    return found.select(*keys, "n", F.array(*[at(i, p) for i, p in enumerate(shares)]).alias("q"))
