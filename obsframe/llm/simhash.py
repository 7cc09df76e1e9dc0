"""SimHash fingerprints and near-duplicate groups by pigeonring filtering.

Fingerprint: 64 bits; a bit is set when more than half of the XXH64 hashes (seed 42)
of all word shingles, repeats included, have it set. Two documents are linked when
their fingerprints differ in at most ``max_bits`` = 3 bits; groups are the connected
components of these links.

Pigeonring filter. The 64 bits form a ring of eight 8-bit segments. If two fingerprints
differ in at most 3 bits, some segment starts a chain of consecutive segments whose
cumulative difference after l segments is at most 3 l / 8 for *every* l = 1..8, that is
0, 0, 1, 1, 1, 2, 2, 3. So two consecutive segments agree, and of the next three at
least two agree: the index key is the start, the choice of two of three, and the 32 bits
of those four segments (24 keys per fingerprint). Pairs sharing a key must pass the whole
chain from that start before the full Hamming distance is checked. No pair within
3 bits is lost.

Documents enter the index once per distinct fingerprint, so copies cost nothing. Inside
a bucket, a breadth-first search over unvisited members emits only a spanning forest of
the links, never all pairs. A bucket beyond ``HOT_BUCKET`` members is first split by the
pigeonhole principle over its remaining bits, so no task holds an unbounded bucket.

Defined results: a null or blank text has fingerprint 0, linked like any other; fewer
words than a shingle give one shingle of all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import connected_components, cut, materialise, ship

SHINGLE = 3
MAX_BITS = 3
HOT_BUCKET = 20_000
SEGMENTS, WIDTH = 8, 8
BUDGET = [MAX_BITS * n // SEGMENTS for n in range(1, SEGMENTS + 1)]
_PICKS = ((2, 3), (3, 4), (2, 4))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), 42)]
    else:
        hashes = [digest(b" ".join(w), 42) for w in zip(*(words[i:] for i in range(shingle)))]
    total, n = np.zeros(64, np.int64), len(hashes)
    for i in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = np.frombuffer(b"".join(hashes[i:i + (1 << 16)]), np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def simhash_of(docs: DataFrame):
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))

    return simhash


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fp)``: the fingerprint as a signed long."""
    return docs.select(F.col(key).alias(key), simhash_of(docs)(F.col(text)).alias("fp"))


def _masks() -> list[tuple[int, int, int]]:
    """(table, start, mask of the four agreeing segments), as unsigned 64-bit masks."""
    out = []
    for start in range(SEGMENTS):
        for pick, rest in enumerate(_PICKS):
            mask = 0
            for s in (0, 1, *rest):
                mask |= 0xFF << (WIDTH * ((start + s) % SEGMENTS))
            out.append((start * len(_PICKS) + pick, start, mask))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def index_keys(distinct: DataFrame) -> DataFrame:
    """24 rows ``(t, key, fp, rep)`` per distinct fingerprint."""
    parts = [F.struct(F.lit(t).cast("byte").alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
             for t, _, m in _masks()]
    return distinct.select(F.inline(F.array(*parts)), "fp", "rep")


def chain_holds(diff: np.ndarray, start: int) -> np.ndarray:
    """Whether the chain of segments from ``start`` keeps its proportional budget at every length."""
    ok, total = np.ones(len(diff), bool), np.zeros(len(diff), np.uint8)
    for n in range(SEGMENTS):
        s = np.uint64(WIDTH * ((start + n) % SEGMENTS))
        total = total + np.bitwise_count((diff >> s) & np.uint64(0xFF))
        ok &= total <= BUDGET[n]
    return ok


def link_bucket(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Spanning forest (pairs of positions) of the links found in one bucket of distinct fingerprints."""
    left, edges = np.arange(len(fps)), []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            diff = fps[left] ^ fps[at]
            near = np.flatnonzero(np.bitwise_count(diff) <= MAX_BITS) if len(left) < 32 else _near(diff, start)
            if len(near):
                found = left[near]
                edges += [(at, f) for f in found]
                queue += list(found)
                left = np.delete(left, near)
    return edges


def _near(diff: np.ndarray, start: int) -> np.ndarray:
    kept = np.flatnonzero(chain_holds(diff, start))
    return kept[np.bitwise_count(diff[kept]) <= MAX_BITS]


def _pairs_of_small(fps: np.ndarray, group: np.ndarray, sizes: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Positions (i, j) of all linked pairs in the buckets of at most 8 members, all buckets at once."""
    rows, out = np.flatnonzero(sizes[group] <= 8), []
    for d in range(1, 8):
        i = rows[rows + d < len(fps)]
        i = i[group[i] == group[i + d]]
        if not len(i):
            break
        diff = fps[i] ^ fps[i + d]
        for start in range(SEGMENTS):
            of = np.flatnonzero(t[i] // len(_PICKS) == start)
            keep = of[_near(diff[of], start)]
            out.append(np.stack([i[keep], i[keep] + d], 1))
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def _link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (t, key, sub); a bucket cut by a batch border is carried over."""
    names, held = ["t", "key", "sub"], []

    def flush(b: pd.DataFrame) -> pd.DataFrame:
        k = b[names].to_numpy()
        group = np.cumsum(np.append(True, (k[1:] != k[:-1]).any(1))) - 1
        sizes = np.bincount(group)
        fps, rep, t = b["fp"].to_numpy().view(np.uint64), b["rep"].to_numpy(), b["t"].to_numpy()
        pairs = [_pairs_of_small(fps, group, sizes, t)]
        first = np.concatenate(([0], np.cumsum(sizes)))
        for g in np.flatnonzero(sizes > 8):
            lo, hi = first[g], first[g + 1]
            if e := link_bucket(fps[lo:hi], int(t[lo]) // len(_PICKS)):
                pairs.append(np.array(e, np.int64) + lo)
        p = np.concatenate(pairs)
        return pd.DataFrame({"a": rep[p[:, 0]], "b": rep[p[:, 1]]}).drop_duplicates()

    for b in batches:
        if not len(b):
            continue
        last = b[names].iloc[-1]
        cut_at = int((b[names] != last).any(axis=1).to_numpy().nonzero()[0].max(initial=-1)) + 1
        if cut_at == 0 and held and (held[-1][names].iloc[-1] == last).all():
            held.append(b)
            continue
        held.append(b.iloc[:cut_at])
        ready = pd.concat(held)
        held = [b.iloc[cut_at:]]
        if len(ready):
            yield flush(ready)
    if held and len(held[0]):
        yield flush(pd.concat(held))


def link_distinct(distinct: DataFrame, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """Links ``(a, b)`` between the representatives of distinct fingerprints ``(fp, rep)`` that span their groups."""
    ship(distinct.sparkSession)
    keys = index_keys(distinct)
    counts = keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = cut(counts)
    keys = keys.join(counts, ["t", "key"])  # buckets of one member have no links
    # A hot bucket is split: of the four segments outside the key at least one agrees within 3 bits.
    free = [F.lit(m) for m in range(4)]
    outside = F.col("fp").bitwiseXOR(F.col("key"))  # the bits that the key leaves open
    rest = []
    for k, _ in enumerate(free):
        # k-th free segment: which one depends on the table, so build it per table
        expr = F.lit(0).cast("long")
        for t, _, m in _masks():
            seg = [s for s in range(SEGMENTS) if not (m >> (WIDTH * s)) & 0xFF][k]
            expr = F.when(F.col("t") == t, F.shiftrightunsigned(outside, WIDTH * seg).bitwiseAND(F.lit(0xFF))).otherwise(expr)
        rest.append(expr + F.lit((k + 1) * 256))
    if counts.where(F.col("n") > hot_bucket).isEmpty():
        keys = keys.select("t", "key", F.lit(0).cast("long").alias("sub"), "fp", "rep")
    else:
        sub = F.when(F.col("n") > hot_bucket, F.array(*rest)).otherwise(F.array(F.lit(0).cast("long")))
        keys = keys.select("t", "key", F.explode(sub).alias("sub"), "fp", "rep")
    dealt = keys.repartition("t", "key", "sub").sortWithinPartitions("t", "key", "sub", "fp")
    return dealt.mapInPandas(_link, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``key``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest
    id of its group). Rows with a null key or a repeated one keep their own row."""
    fps = materialise(fingerprints(docs, key, text), "simhash")
    distinct = fps.groupBy("fp").agg(F.min(key).alias("rep")).where(F.col("rep").isNotNull())
    distinct = cut(distinct)
    groups = connected_components(link_distinct(distinct))
    of = (distinct.join(groups, distinct["rep"] == groups["node"], "left")
          .select("fp", F.coalesce("component", "rep").alias("component_id")))
    return (fps.join(of, "fp", "left")
            .select(key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that are near duplicates of one with a smaller id.

    Of rows that share an id and a fingerprint (repeated rows among them) one stays; rows without an id all stay."""
    groups = near_duplicates(docs, key, text)
    kept = docs.join(groups.where(F.col("component_id") < F.col(key)).select(key), key, "left_anti").select(docs.columns)
    twice = cut(docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key))
    if twice.isEmpty():
        return kept
    again = kept.join(twice, key, "left_semi").withColumn("__fp", simhash_of(docs)(F.col(text)))
    again = again.dropDuplicates([key, "__fp"]).select(docs.columns)
    return kept.join(twice, key, "left_anti").select(docs.columns).unionByName(again)
