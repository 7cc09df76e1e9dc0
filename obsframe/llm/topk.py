"""Exact top-k search by inner product over a pivot-distance index.

Vectors are whole numbers: each component x becomes floor(256 x). With one more component,
sqrt(M^2 - |x|^2) for candidates (M the largest norm) and 0 for queries, the candidates with the
largest inner product are the nearest ones: d^2 = |q|^2 + M^2 - 2 q.x.

Index. Pivots are fitted by k-means on a bounded sample (``SAMPLE`` rows). Every candidate is
keyed by its nearest pivot and its distance to it, and each pivot's candidates are cut into
annuli by distance (bounds from quantile sketches), and into blocks of about ``BLOCK`` rows, so a
pivot that holds much of the table, or many equal vectors, is many blocks.

Search. A first pass compares each query with the blocks of its nearest pivot; its k-th best score there
bounds the radius. Then each query goes to the other pivots whose annuli may hold something nearer: by the triangle inequality |d(q, pivot) - d(x, pivot)| <= d(q, x), so an annulus whose
distances lie beyond the radius is skipped, and the expansion stops. Scores are exact (whole numbers in
double products below 2^53). A pivot's blocks, in order of distance, form slabs of ``SLAB`` blocks (more where a pivot
would have over ``MOST_SLABS``); queries go to the slabs that their radius reaches and meet the blocks through a join on
(pivot, slab), whose number of keys grows with the table.

Defined results: a null vector, or one with a null or non-finite component, takes no part. Shorter
vectors count as padded with zeros. Rows with a null id take no part. Equal scores go to the smaller id; a
query's own id is no candidate (all rows of that id, if it is repeated). Fewer candidates than k: all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsframe.llm.common import materialise, ship

SAMPLE = 8_000
PIVOTS = 48
BLOCK = 2_048
QUERY_BLOCK = 512
ROUTED = 256
MOST_ANNULI = 500
SLAB = 32
MOST_SLABS = 500
SLACK = 1e-6


def quantise(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(id, v array<double>)`` of the rows that take part."""
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * 256).cast("double"))
    bad = F.exists(F.col(vector), lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~bad).select(F.col(key).alias("id"), x.alias("v"))


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def fit_pivots(x: np.ndarray, pivots: int = PIVOTS, rounds: int = 8) -> np.ndarray:
    """k-means centres of a bounded sample (rows in a fixed order)."""
    c = x[np.linspace(0, len(x) - 1, min(pivots, len(x))).astype(int)]
    for _ in range(rounds):
        near = distances(x, c).argmin(1)
        c = np.stack([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * x @ c.T, 0))


def lifted(x: np.ndarray, biggest: float | None) -> np.ndarray:
    """With the extra component: of candidates, or 0 for queries (``biggest`` None)."""
    last = np.zeros(len(x)) if biggest is None else np.sqrt(np.maximum(biggest * biggest - (x * x).sum(1), 0))
    return np.column_stack([x, last])


def build_index(vectors: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE, block: int = BLOCK) -> tuple[DataFrame, dict]:
    """Blocks ``(pivot, block, low, high, n, ids, matrix)`` and the fitted parts (pivots, norm, dims)."""
    ship(vectors.sparkSession)
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    stats = vectors.agg(F.max(F.size("v")).alias("dims"), F.sqrt(F.max(norm2)).alias("norm"), F.count(F.lit(1)).alias("n")).first()
    dims, biggest, n = int(stats["dims"] or 0), float(stats["norm"] or 0.0), int(stats["n"])
    u = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    rows = vectors.where(u <= int((1 << 30) * min(1.0, 1.2 * sample / max(n, 1)))).orderBy(u, "id").limit(sample).toPandas()
    centres = fit_pivots(lifted(_matrix(rows["v"], dims), biggest), pivots) if len(rows) else np.zeros((1, dims + 1))
    fitted = {"pivots": centres, "norm": biggest, "dims": dims}

    def key(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["v"], dims)
            d = distances(lifted(x, biggest), centres)
            near = d.argmin(1)
            yield pd.DataFrame({"id": b["id"], "pivot": near, "dist": d[np.arange(len(d)), near], "row": [r.tobytes() for r in x]})

    keyed = materialise(vectors.mapInPandas(key, "id long, pivot int, dist double, row binary"), "topk-keyed")
    counts = {r["pivot"]: r["count"] for r in keyed.groupBy("pivot").count().collect()}  # one row per pivot
    annuli = int(min(MOST_ANNULI, max([1, *(-(-c // block) for c in counts.values())])))
    cuts = {r["pivot"]: r["q"] for r in keyed.groupBy("pivot").agg(F.percentile_approx("dist", [(i + 1) / annuli for i in range(annuli)], 10_000).alias("q")).collect()}
    parts = {p: min(annuli, -(-c // block)) for p, c in counts.items()}
    bounds = {p: sorted({cuts[p][min(annuli - 1, (i + 1) * annuli // parts[p] - 1)] for i in range(parts[p])})[:-1] for p in counts}

    def annulus(b: pd.DataFrame) -> np.ndarray:
        at = np.zeros(len(b), np.int64)
        pivot, dist = b["pivot"].to_numpy(), b["dist"].to_numpy()
        for p in np.unique(pivot).tolist():
            at[pivot == p] = np.searchsorted(bounds[p], dist[pivot == p])
        return at

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"pivot": b["pivot"], "annulus": annulus(b)})

    # equal distances leave fewer annuli than planned: blocks follow from the rows that each really has
    held = keyed.select("pivot", "dist").mapInPandas(place, "pivot int, annulus long").groupBy("pivot", "annulus").count().collect()  # at most 500 per pivot
    subs = {p: np.ones(len(bounds[p]) + 1, np.int64) for p in counts}
    for r in held:
        subs[r["pivot"]][r["annulus"]] = -(-r["count"] // block)
    first_block = {p: np.cumsum(s) - s for p, s in subs.items()}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ring, pivot, spread = annulus(b), b["pivot"].to_numpy(), b["spread"].to_numpy()
            at = np.zeros(len(b), np.int64)
            for p in np.unique(pivot).tolist():
                i = pivot == p
                at[i] = first_block[p][ring[i]] + spread[i] % subs[p][ring[i]]
            yield b[["id", "pivot", "dist", "row"]].assign(block=at)

    dealt = keyed.withColumn("spread", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30)))
    dealt = dealt.mapInPandas(deal, "id long, pivot int, dist double, row binary, block long")

    def gather(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["dist", "id"])
        return pd.DataFrame({"pivot": g["pivot"].iloc[:1].to_numpy(), "block": g["block"].iloc[:1].to_numpy(), "low": [g["dist"].min()], "high": [g["dist"].max()],
                             "n": [len(g)], "ids": [g["id"].to_numpy(np.int64).tobytes()], "matrix": [b"".join(g["row"])]})

    blocks = dealt.groupBy("pivot", "block").applyInPandas(gather, "pivot int, block long, low double, high double, n long, ids binary, matrix binary")
    fitted["annuli"] = sum(parts.values())
    fitted["most_blocks"] = int(max((s.sum() for s in subs.values()), default=1))
    return materialise(blocks, "topk-index"), fitted


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """The k best candidates of each query in one block."""
    scores = (q @ x.T).astype(np.int64)
    out = []
    for qid, s in zip(q_ids.tolist(), scores, strict=True):
        own = ids != qid
        s, c = s[own], ids[own]
        if len(s) > k:
            least = np.partition(s, len(s) - k)[len(s) - k]
            top = np.flatnonzero(s >= least)
        else:
            top = np.arange(len(s))
        top = top[np.lexsort((c[top], -s[top]))][:k]
        out.append(pd.DataFrame({"query_id": qid, "vec_id": c[top], "score": s[top]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


FOUND = "query_id long, vec_id long, score long"


def _compare(pairs: DataFrame, dims: int, k: int) -> DataFrame:
    """Rows are a block of queries and a block of candidates; ``radius`` (and the queries' distances to the pivot) prune."""
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                q_ids, q = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.q_matrix).reshape(-1, dims)
                at, radius = np.frombuffer(r.q_dist), np.frombuffer(r.q_radius)
                beyond = np.maximum(np.maximum(at - r.high, r.low - at), 0)
                use = beyond <= radius * (1 + SLACK) + SLACK
                if use.any():
                    yield _best(q_ids[use], q[use], np.frombuffer(r.ids, np.int64), np.frombuffer(r.matrix).reshape(-1, dims), k)

    return pairs.mapInPandas(compare, FOUND)


QUERIES = "pivot int, slab int, part long, q_ids binary, q_matrix binary, q_dist binary, q_radius binary"


def _pack_queries(routed: DataFrame) -> DataFrame:
    """Queries for one slab, in blocks of about ``QUERY_BLOCK`` of similar distance."""
    def gather(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"pivot": g["pivot"].iloc[:1].to_numpy(), "slab": g["slab"].iloc[:1].to_numpy(), "part": g["part"].iloc[:1].to_numpy(), "q_ids": [g["id"].to_numpy(np.int64).tobytes()],
                             "q_matrix": [b"".join(g["row"])], "q_dist": [g["dist"].to_numpy(float).tobytes()], "q_radius": [g["radius"].to_numpy(float).tobytes()]})

    return routed.groupBy("pivot", "slab", "part").applyInPandas(gather, QUERIES)


def _merge(found: DataFrame, k: int) -> DataFrame:
    """Best k per query; each task keeps k per query before the shuffle."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS, block: int = BLOCK, slab: int = SLAB) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row ``(id, v)`` of ``queries``, the k best of ``vectors``."""
    spark = ship(vectors.sparkSession)
    blocks, fitted = build_index(vectors, pivots, block=block)
    dims, norm, centres = fitted["dims"], fitted["norm"], fitted["pivots"]
    if not dims:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    slab = max(slab, -(-fitted["most_blocks"] // MOST_SLABS))
    blocks = blocks.withColumn("slab", F.floor(F.col("block") / slab).cast("int"))
    ranges = blocks.groupBy("pivot", "slab").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("pivot", "slab").toPandas()  # at most MOST_SLABS per pivot
    slab_pivot, slab_of, low, high = (ranges[c].to_numpy() for c in ("pivot", "slab", "low", "high"))
    n_parts = max(1, round(queries.count() / QUERY_BLOCK))
    asked = queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(n_parts)))
    used = np.unique(slab_pivot)
    column = np.searchsorted(used, slab_pivot)  # of each slab's pivot in the distances

    def route(first: bool):
        def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for whole in batches:
                for at in range(0, len(whole), ROUTED):  # queries by slabs in memory
                    b = whole.iloc[at:at + ROUTED]
                    x = _matrix(b["v"], dims)
                    d = distances(lifted(x, None), centres[used])
                    own = column[None, :] == d.argmin(1)[:, None]
                    if first:
                        who, to = np.nonzero(own)
                        radius = np.full(len(who), np.inf)
                    else:
                        least = b["least"].to_numpy(float)  # NaN: fewer than k found so far
                        size = (x * x).sum(1) + norm * norm
                        radius_of = np.where(np.isnan(least), np.inf, np.sqrt(np.maximum(size - 2 * least, 0)))
                        far = d[:, column]
                        beyond = np.maximum(np.maximum(far - high, low - far), 0)
                        who, to = np.nonzero(~own & (beyond <= radius_of[:, None] * (1 + SLACK) + SLACK))  # own: searched in the first pass
                        radius = radius_of[who]
                    yield pd.DataFrame({"id": b["id"].to_numpy()[who], "part": b["part"].to_numpy()[who], "pivot": slab_pivot[to], "slab": slab_of[to],
                                        "dist": d[who, column[to]], "radius": radius, "row": [x[i].tobytes() for i in who]})
        return go

    routed = "id long, part long, pivot int, slab int, dist double, radius double, row binary"
    near = _pack_queries(asked.mapInPandas(route(True), routed))
    first = materialise(_merge(_compare(near.join(blocks, ["pivot", "slab"]), dims, k), k).drop("rank"), "topk-first")
    least = first.groupBy(F.col("query_id").alias("id")).agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    again = asked.join(least.where(F.col("n") >= k).select("id", F.col("least").cast("double").alias("least")), "id", "left")
    pairs = _pack_queries(again.mapInPandas(route(False), routed)).join(blocks, ["pivot", "slab"])
    return _merge(first.unionByName(_compare(pairs, dims, k)), k).select("query_id", "rank", "vec_id", "score")
