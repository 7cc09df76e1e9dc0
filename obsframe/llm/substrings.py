"""Exact removal of long repeated byte strings (suffix-array dedup).

A byte is removed when a ``LENGTH``-byte string that covers it also starts earlier: in a document of
smaller order, or earlier in the same document. Strings are judged on the input; matches never cross documents.

1. Anchors. Each window of ``LENGTH`` bytes picks the ``GRAM``-byte string inside it with the smallest hash (leftmost
   of equals). Equal windows pick equal strings at equal places, so equal windows always meet at one anchor value, and
   each window belongs to exactly one anchor. The windows of one anchor form one segment of text.
2. Segments that are equal throughout need no sorting: of those with one anchor and one segment hash, the earliest
   stays. Copies inside a task are settled there, so a passage that a third of all documents hold arrives once per chunk.
3. Shards. Anchors whose segments differ (the edges of shared passages) are dealt to shards, all segments of an anchor
   to one. A shard concatenates its segments, sorts their suffixes by Larsson-Sadakane refinement in numpy (ranks
   double in depth, and only groups that are still tied are sorted again), takes the common prefixes of neighbours by
   Kasai's method, and so finds the runs of equal windows; the earliest of a run stays.
4. Hot anchors, with more than ``HOT`` differing segments, are not gathered in a shard. Their windows go out one by one
   by two 64-bit hashes over all tasks, which sort them and keep each window's first; shards are not merged with one another.
   Anchors with three or more differing segments in a chunk are counted before step 2 and, if hot, skip it; all others are
   counted from what step 2 leaves, so that no hot anchor reaches a shard.

Windows meet by two independent 64-bit hashes, one of them BLAKE2b of their bytes (steps 2 and 4), or byte by byte (step 3). Texts are read whole, in overlapping
chunks if long. All shuffles are spread by hash; the largest group that a task holds is a shard of ``HOT`` segments.

Defined results: a null text is empty. A repeated or null id is ordered by (id, nulls last, hash of the text), so of
repeated rows one keeps its bytes.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import materialise, ship

LENGTH = 100
GRAM = 24
CHUNK = 1 << 20
HOT = 1024
MOST_HOT = 1 << 20
SHARD_BYTES = 1 << 20
ODD, ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
LOW = np.uint64((1 << 24) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _powers(n: int, r: np.uint64) -> np.ndarray:
    p = np.ones(n, np.uint64)
    p[1:] = r
    return np.cumprod(p, dtype=np.uint64)


@lru_cache(maxsize=2)
def _tables(r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random odd number per byte value, the powers of r and those of its inverse modulo 2^64."""
    inverse = pow(r, -1, 1 << 64)
    n = CHUNK + 2 * LENGTH
    byte = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(r)) | np.uint64(1)
    return byte, _powers(n, np.uint64(r)), _powers(n, np.uint64(inverse))


def digests(buf: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """64 bits of BLAKE2b of each substring. It decides whether bytes are equal; sums modulo 2^64 as in ``Rolling`` collide by construction on some texts."""
    data = memoryview(buf.tobytes())
    found = b"".join([blake2b(data[a:b], digest_size=8).digest() for a, b in zip(low.tolist(), high.tolist(), strict=True)])
    return np.frombuffer(found, np.uint64)


class Rolling:
    """Hashes of all substrings of a buffer, from prefix sums: to choose anchors and to deal rows, not to compare bytes."""

    def __init__(self, buf: np.ndarray, r: np.uint64):
        byte, power, self.inverse = _tables(int(r))
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(byte[buf] * power[:len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hash of [start, end), with places counted from ``at``."""
        return (self.sums[end] - self.sums[start]) * self.inverse[at]


def chunks(rows: Iterator[tuple[int, bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents and parts of long ones (with the overlap that windows need), some ``CHUNK`` bytes at a time:
    the buffer, and of each part the document, its offset in the document and its end in the buffer."""
    docs, offsets, parts, size = [], [], [], 0

    def out():
        return (np.frombuffer(b"".join(parts), np.uint8), np.array(docs, np.int64), np.array(offsets, np.int64),
                np.cumsum([len(p) for p in parts]))

    for doc, data in rows:
        for a in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
            part = data[a:a + CHUNK + LENGTH - 1]
            if size and size + len(part) > CHUNK:
                yield out()
                docs, offsets, parts, size = [], [], [], 0
            docs.append(doc)
            offsets.append(a)
            parts.append(part)
            size += len(part)
    if parts:
        yield out()


class Anchors:
    """Anchors of a chunk: value ``h``, segment hash ``g``, document, first window start and number of windows."""

    def __init__(self, buf: np.ndarray, docs: np.ndarray, offsets: np.ndarray, ends: np.ndarray):
        n = len(buf)
        self.buf, self.rolling = buf, Rolling(buf, ODD)
        place = np.arange(n - GRAM + 1)
        gram = _mix(self.rolling.of(place, place + GRAM, place))
        least = (gram & ~LOW) | place.astype(np.uint64)  # of equal hashes, the leftmost
        span, wanted = 1, LENGTH - GRAM + 1
        while span * 2 <= wanted:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        least = np.minimum(least[:len(least) - (wanted - span)], least[wanted - span:]) if wanted > span else least
        starts = np.append(0, ends[:-1])
        inside = np.zeros(n + 1, np.int8)
        inside[starts] += 1
        inside[ends - LENGTH + 1] -= 1
        window = np.flatnonzero(np.cumsum(inside)[:len(least)])
        at = (least[window] & LOW).astype(np.int64)
        part = np.searchsorted(ends, window, side="right")
        new = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (part[1:] != part[:-1])))
        self.at, self.low = at[new], window[new]
        self.n = np.diff(np.append(new, len(window)))
        high = self.low + self.n - 1 + LENGTH
        self.h = gram[self.at]
        self.g = _mix(digests(buf, self.low, high) + (self.at - self.low).astype(np.uint64) * ODD2 + self.n.astype(np.uint64))
        part = part[new]
        self.doc, self.start = docs[part], self.low - starts[part] + offsets[part]

    def first(self) -> np.ndarray:
        """Whether an anchor is the earliest of its (h, g) in the chunk."""
        order = np.lexsort((self.start, self.doc, self.g, self.h))
        h, g = self.h[order], self.g[order]
        out = np.empty(len(order), bool)
        out[order] = np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))
        return out

    def windows(self, rows: np.ndarray) -> pd.DataFrame:
        """Each window of the given anchors by itself, with two hashes."""
        n = self.n[rows]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        place = np.repeat(self.low[rows], n) + inner
        return pd.DataFrame({"k": _mix(self.rolling.of(place, place + LENGTH, place)).view(np.int64), "g": digests(self.buf, place, place + LENGTH).view(np.int64),
                             "doc": np.repeat(self.doc[rows], n), "start": np.repeat(self.start[rows], n) + inner, "n": 0})


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
    """Intervals per document with those that touch joined."""
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    lift = np.cumsum(np.append(0, doc[1:] != doc[:-1])) if len(doc) else np.empty(0, np.int64)
    step = int(end.max(initial=0)) + 1
    reach = np.maximum.accumulate(end + lift * step) if len(doc) else end
    new = np.append(True, (start + lift * step)[1:] > reach[:-1])[:len(doc)]
    i = np.flatnonzero(new)
    return pd.DataFrame({"doc": doc[i], "start": start[i], "end": (reach - lift * step)[np.append(i[1:], len(doc)) - 1] if len(i) else end})


def _bytes(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, bytes]]:
    for b in batches:
        for doc, text in zip(b["doc"].tolist(), b["text"], strict=True):
            if text:
                yield doc, text.encode("utf-8", "surrogatepass")


def settle_in_tasks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """First pass: the intervals that earlier copies in the same chunk cover (``n`` 0), and anchors with three or more
    differing segments in a chunk (``n`` of them)."""
    for c in chunks(_bytes(batches)):
        a = Anchors(*c)
        first = a.first()
        late = np.flatnonzero(~first)
        cover = merged(a.doc[late], a.start[late], a.start[late] + a.n[late] - 1 + LENGTH)
        yield cover.assign(h=0, n=0)[["h", "n", "doc", "start", "end"]]
        h, n = np.unique(a.h[first], return_counts=True)
        yield pd.DataFrame({"h": h[n > 2].view(np.int64), "n": n[n > 2], "doc": 0, "start": 0, "end": 0})


def windows_of(doc: np.ndarray, start: np.ndarray, n: np.ndarray, segments: list[bytes]) -> pd.DataFrame:
    """Each window of the given segments by itself, with the two hashes of ``Anchors.windows``; windows that are repeated among
    them are settled (``n`` -1)."""
    sizes = np.array([len(s) for s in segments])
    buf = np.frombuffer(b"".join(segments), np.uint8)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    place = np.repeat(np.cumsum(sizes) - sizes, n) + inner
    k, g = _mix(Rolling(buf, ODD).of(place, place + LENGTH, place)).view(np.int64), digests(buf, place, place + LENGTH).view(np.int64)
    w = pd.DataFrame({"k": k, "g": g, "doc": np.repeat(doc, n), "start": np.repeat(start, n) + inner}).sort_values(["k", "g", "doc", "start"])
    return w.assign(n=np.where(w.duplicated(["k", "g"]), -1, 0))


def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (k, g, doc, start): later rows of equal (k, g) are covered (``k`` null in the result); segments of an
    anchor with several (k, g) go on to a shard. One row is carried from batch to batch."""
    carry, carried = None, False  # the first row of the last (k, g), and whether it has gone on
    for b in batches:
        if not len(b):
            continue
        known = b[b["n"] < 0]
        if len(known):
            yield pd.DataFrame({"k": pd.array([None], "Int64").repeat(len(known)), "doc": known["doc"], "start": known["start"], "n": 0, "end": known["start"] + LENGTH})
            b = b[b["n"] >= 0]
            if not len(b):
                continue
        rows = pd.concat([carry, b], ignore_index=True) if carry is not None else b
        k, g, n, start = (rows[c].to_numpy() for c in ("k", "g", "n", "start"))
        new_k = np.append(True, k[1:] != k[:-1])
        new = new_k | np.append(True, g[1:] != g[:-1])
        late = np.flatnonzero(~new)
        yield pd.DataFrame({"k": pd.array([None], "Int64").repeat(len(late)), "doc": rows["doc"].to_numpy()[late], "start": start[late],
                            "n": n[late], "end": start[late] + np.maximum(n[late], 1) - 1 + LENGTH})
        heads = np.flatnonzero(new_k)
        of = np.searchsorted(heads, np.arange(len(k)), side="right") - 1  # the run of each row, by binary search
        several = np.bincount(of, new) > 1
        several[0] |= carried
        go = np.flatnonzero(new & several[of] & (n > 0))
        last = int(np.flatnonzero(new)[-1])
        gone = bool(len(go)) and bool(go[-1] == last)
        if carried:
            go = go[go > 0]
        out = rows.iloc[go]
        yield pd.DataFrame({"k": out["k"].astype("Int64"), "doc": out["doc"], "start": out["start"], "n": out["n"], "end": 0})
        carry, carried = rows.iloc[last:last + 1], gone


def suffix_sort(symbols: np.ndarray) -> np.ndarray:
    """Places in order of their suffixes; symbols are below 257.

    Larsson-Sadakane: after sorting by seven symbols, groups of equal rank are sorted by the rank of the place as
    many symbols further on; the compared length doubles, and places alone in their group are left out."""
    n = len(symbols)
    padded = np.concatenate((symbols.astype(np.uint64), np.zeros(8, np.uint64)))
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = key * np.uint64(257) + padded[j:j + n]
    order = np.argsort(key)
    key = key[order]
    new = np.append(True, key[1:] != key[:-1])
    head = np.flatnonzero(new)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = head[np.cumsum(new) - 1]
    length = 7
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(tied):
        place = order[tied]
        mine, further = rank[place], rank[np.minimum(place + length, n)] + 1
        by = np.argsort((mine.astype(np.uint64) << np.uint64(32)) | further.astype(np.uint64))
        place, mine, further = place[by], mine[by], further[by]
        order[tied] = place
        new = np.append(True, (mine[1:] != mine[:-1]) | (further[1:] != further[:-1]))
        rank[place] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        length *= 2
        tied = tied[~(new & np.append(new[1:], True))]
    return order


def common_prefixes(symbols: np.ndarray, order: np.ndarray, most: int = LENGTH, lane: int = 256) -> np.ndarray:
    """Length, up to ``most``, of the prefix that each suffix in ``order`` shares with the one before it.

    Kasai: going through the text, a suffix shares at most one symbol less than the suffix one place earlier did. The text
    is walked in lanes of ``lane`` places side by side."""
    n = len(symbols)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    text = np.concatenate((symbols.astype(np.int32), np.arange(-1, -most - 10, -1, dtype=np.int32)))  # ends match nothing
    shared = np.zeros(n, np.int16)
    lanes = np.arange(0, n, lane)
    h = np.zeros(len(lanes), np.int64)
    for t in range(lane):
        at = lanes + t
        at = at[at < n]
        h = np.maximum(h[:len(at)] - 1, 0)
        other = before[at]
        h[other < 0] = 0
        live = np.flatnonzero((other >= 0) & (h < most))
        while len(live):
            same = text[at[live] + h[live]] == text[other[live] + h[live]]
            live = live[same]
            h[live] += 1
            live = live[h[live] < most]
        shared[at] = h
    return shared[order]


def repeated_in_shard(doc: np.ndarray, start: np.ndarray, n: np.ndarray, segments: list[bytes]) -> pd.DataFrame:
    """Intervals of a shard's windows that also start earlier."""
    sizes = np.array([len(s) + 1 for s in segments])
    base = np.cumsum(sizes) - sizes
    symbols = np.zeros(int(sizes.sum()), np.uint16)
    flat = np.frombuffer(b"".join(segments), np.uint8)
    inside = np.ones(len(symbols), bool)
    inside[base + sizes - 1] = False
    symbols[inside] = flat.astype(np.uint16) + 1
    order = suffix_sort(symbols)
    run = np.cumsum(common_prefixes(symbols, order) < LENGTH)
    seg = np.repeat(np.arange(len(segments)), sizes)
    inner = np.arange(len(symbols)) - base[seg]
    keep = inner[order] < n[seg[order]]  # only places where a window starts
    place, run = order[keep], run[keep]
    s = seg[place]
    d, p = doc[s], start[s] + inner[place]
    by = np.lexsort((p, d, run))
    d, p, run = d[by], p[by], run[by]
    head = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    head = head[np.searchsorted(head, np.arange(len(run)), side="right") - 1]
    late = (d != d[head]) | (p != p[head])
    return merged(d[late], p[late], p[late] + LENGTH)


def sort_shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by anchor; a shard ends where an anchor does."""
    held: list[pd.DataFrame] = []
    size = 0

    def out(b: pd.DataFrame) -> pd.DataFrame:
        return repeated_in_shard(b["doc"].to_numpy(), b["start"].to_numpy(), b["n"].to_numpy(), b["segment"].tolist())

    for b in batches:
        held.append(b)
        size += int(b["segment"].str.len().sum())
        if size >= SHARD_BYTES:
            rows = pd.concat(held, ignore_index=True)
            cut = int(np.flatnonzero((rows["k"] == rows["k"].iloc[-1]).to_numpy())[0])
            if cut:
                yield out(rows.iloc[:cut])
                held = [rows.iloc[cut:]]
                size = int(held[0]["segment"].str.len().sum())
    if held:
        rows = pd.concat(held, ignore_index=True)
        if len(rows):
            yield out(rows)


def in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(doc, id, text)``: doc numbers the documents in order. It is the id itself where ids are unique and not null."""
    d = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))  # ids travel as text, so nulls do not turn them into floats
    ids = d.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1 OR id IS NULL").isEmpty():
        return d.select(F.col("id").cast("long").alias("doc"), F.col("id").cast("string").alias("id"), "text")
    placed = d.orderBy(F.col("id").asc_nulls_last(), F.xxhash64("text"), F.octet_length("text"))
    numbered = placed.select(F.col("id").cast("string").alias("id"), "text").rdd.zipWithIndex().map(lambda r: (r[1], r[0]["id"], r[0]["text"]))
    out = d.sparkSession.createDataFrame(numbered, "doc long, id string, text string")
    return materialise(out, "substring-documents")


ROWS = "k long, g long, doc long, start long, n int"
COVER = "doc long, start long, end long"


def packed(docs: DataFrame) -> DataFrame:
    """Documents with compressed texts, for the shuffles that need them."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pd.DataFrame({"doc": b["doc"], "id": b["id"], "z": [press.compress((t or "").encode("utf-8", "surrogatepass")) for t in b["text"]]})

    return docs.mapInPandas(pack, "doc long, id string, z binary")


def find_repeats(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Intervals ``(doc, start, end)`` of the bytes to remove, overlapping ones included."""
    ship(docs.sparkSession)
    texts = docs.select("doc", "text")
    local = materialise(texts.mapInPandas(settle_in_tasks, "h long, n int, " + COVER), "substring-local")
    limit = hot
    counts = materialise(local.where("n > 0").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") > hot), "substring-hot")
    while (n_hot := counts.where(F.col("n") > limit).count()) > MOST_HOT:  # what is broadcast stays below 8 MB
        limit *= 2
    hot_values = np.array([r["h"] for r in counts.where(F.col("n") > limit).collect()] if n_hot else [], np.int64)
    hot_values = docs.sparkSession.sparkContext.broadcast(np.sort(hot_values.view(np.uint64)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = hot_values.value
        for c in chunks(_bytes(batches)):
            a = Anchors(*c)
            first = a.first()
            is_hot = known[np.minimum(np.searchsorted(known, a.h), len(known) - 1)] == a.h if len(known) else np.zeros(len(a.h), bool)
            i = np.flatnonzero(first & ~is_hot)
            yield pd.DataFrame({"k": a.h[i].view(np.int64), "g": a.g[i].view(np.int64), "doc": a.doc[i], "start": a.start[i], "n": a.n[i]})
            i = np.flatnonzero(first & is_hot)
            if len(i):
                w = a.windows(i).sort_values(["k", "g", "doc", "start"])
                again = w.duplicated(["k", "g"])  # settled here, as copies of whole segments are
                late = w[again]
                yield pd.DataFrame({"k": late["k"], "g": late["g"], "doc": late["doc"], "start": late["start"], "n": -1})
                yield w[~again]

    rows = texts.mapInPandas(deal, ROWS)
    rows = rows.repartition("k", F.when(F.col("n") < 0, F.xxhash64("doc", "start")).otherwise(0)).sortWithinPartitions("k", "g", "doc", "start")
    found = materialise(rows.mapInPandas(resolve, "k long, doc long, start long, n int, end long"), "substring-found")
    differ = found.where("k IS NOT NULL")
    spread = materialise(differ.groupBy("k").agg(F.count(F.lit(1)).alias("segments")).where(F.col("segments") > hot), "substring-hot-anchors")
    n = F.when(F.col("segments").isNull(), F.col("n")).otherwise(-F.col("n"))  # below 0: segments of hot anchors
    asked = differ.join(spread, "k", "left").groupBy("doc").agg(F.flatten(F.collect_list(F.array("k", "start", n))).alias("asked"))

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for doc, z, asked in zip(b["doc"].tolist(), b["z"], b["asked"], strict=True):
                data = press.decompress(z)
                out += [(k, 0, doc, a, n, data[a:a + abs(n) - 1 + LENGTH]) for k, a, n in np.asarray(asked).reshape(-1, 3).tolist()]
            rows = pd.DataFrame(out, columns=["k", "g", "doc", "start", "n", "segment"])
            yield rows[rows["n"] > 0]
            rows = rows[rows["n"] < 0]
            for i in range(0, len(rows), HOT):
                part = rows.iloc[i:i + HOT]
                yield windows_of(part["doc"].to_numpy(), part["start"].to_numpy(), -part["n"].to_numpy(), part["segment"].tolist()).assign(segment=None)

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Windows come first, then the segments."""
        batches, left = iter(batches), []

        def windows() -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b[b["n"] <= 0]
                if (b["n"] > 0).any():
                    left.append(b[b["n"] > 0])
                    return

        for b in resolve(windows()):
            yield b[["doc", "start", "end"]]
        yield from sort_shards(itertools.chain(left, batches))

    segments = packed(docs).join(asked, "doc").mapInPandas(fetch, ROWS + ", segment binary")
    segments = segments.repartition("k", F.when(F.col("n") < 0, F.xxhash64("doc", "start")).otherwise(0))
    sorted_ = segments.sortWithinPartitions(F.col("n") > 0, "k", "g", "doc", "start").mapInPandas(settle, COVER)
    cover = [local.where("n = 0"), found.where("k IS NULL")]
    return cover[0].select("doc", "start", "end").unionByName(cover[1].select("doc", "start", "end")).unionByName(sorted_)


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", hot: int = HOT) -> DataFrame:
    """One row per document: key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (start and end of
    the maximal removed runs, in bytes)."""
    ordered = in_order(docs, key, text)
    cover = find_repeats(ordered, hot).groupBy("doc").agg(F.flatten(F.collect_list(F.array("start", "end"))).alias("cover"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for ident, z, cover in zip(b["id"], b["z"], b["cover"], strict=True):
                data, spans = press.decompress(z), []
                if cover is not None and len(cover):
                    s, e = np.asarray(cover).reshape(-1, 2).T
                    spans = merged(np.zeros(len(s), np.int64), s, e)[["start", "end"]].to_numpy().tolist()
                digest, at = hashlib.sha256(), 0
                for s, e in spans:
                    digest.update(data[at:s])
                    at = e
                digest.update(data[at:])
                out.append((ident, len(data), sum(e - s for s, e in spans), len(spans), digest.hexdigest(), [{"start": s, "end": e} for s, e in spans]))
            yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    done = packed(ordered).join(cover, "doc", "left").mapInPandas(
        finish, "id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>")
    return done.select(F.col("id").cast(docs.schema[key].dataType).alias(key), "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
