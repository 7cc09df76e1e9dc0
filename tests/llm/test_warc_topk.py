import gzip
import hashlib
import math
import random
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from obsframe.llm import topk, warc
from tests.llm.test_lines import same

PAGES = "page_id long, url string, html string, file string, offset string"


def test_given_pages_match_sql(spark):
    same(spark, "op4_warc_index")


def pages():
    big, small = "<p>é " + "x" * 2000, "<p>y"
    rows = [(1, "http://a/1", big), (2, "http://a/%0D\r\nX: y", big), (3, None, big), (4, "u4", small), (5, "u5", small), (6, "u", None), (7, "u", ""),
            (8, "u", "WARC/1.1\r\n\r\n" * 300), (9, "u", "z" * 3_000_000), (None, "n", big), (None, "n", "q" * 1000), (10, "d", "w" * 999), (11, "d", "w" * 999),
            (12, "e", "v" * 1000), (13, "e", "v" * 1000), (13, "e", "v" * 1000)]
    return [(*r, "clash", "clash") for r in rows] + [(100 + i, f"h/{i}", "copy " * 400, "", "") for i in range(300)]


def brute(rows):
    last = {}
    for k, _, h, *_ in rows:
        if h and len(h.encode()) >= 1000 and k is not None:
            last[h] = max(last.get(h, k), k)
    out = []
    for k, _, h, *_ in rows:
        data, to = (h or "").encode(), last.get(h)
        if to is not None and to == k or sum(r[2] == h for r in rows) == 1:
            to = None
        out.append((k, len(data), hashlib.sha1(data).hexdigest(), "response" if to is None else "revisit", to))
    return out


def test_round_trip(spark, tmp_path):
    rows, folder = pages(), f"file:{tmp_path}/archives"
    index = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), folder, file_bytes=20_000)
    out = warc.read_records(index, folder).collect()
    key = lambda t: tuple((x is not None, x) for x in t)
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out], key=key) == sorted(brute(rows), key=key)
    html, urls = {r[0]: r[2] or "" for r in rows if r[0]}, {r[0]: r[1] for r in rows if r[0]}
    assert all(r.payload == html[r.page_id] for r in out if r.record_type == "response" and r.page_id)
    assert all(r.url == urls[r.page_id] for r in out if r.page_id)
    # a selection reads only its records, and the index's ranges tile each file
    some = warc.read_records(index.where("page_id in (3, 8, 150)"), folder).collect()
    assert {r.page_id for r in some} == {3, 8, 150}
    for name, g in index.toPandas().sort_values(["file", "offset"]).groupby("file"):
        data = Path(tmp_path, "archives", name).read_bytes()
        assert g["offset"].tolist() == [0, *np.cumsum(g["length"])[:-1]] and g["length"].sum() == len(data)
        assert gzip.decompress(data).count(b"WARC-Record-ID: ") == len(g)


def test_no_pages(spark, tmp_path):
    index = warc.write_archives(spark.createDataFrame([], PAGES), str(tmp_path))
    assert warc.read_records(index, str(tmp_path)).count() == 0


def test_reads_are_dealt_by_bytes(spark):
    """64 blocks of archive in a few tiny index rows are 64 tasks, none of which holds much of them."""
    index = spark.range(640).selectExpr("'f' as file", "id * 100 as offset", "100L as length")
    dealt = warc.deal_reads(index, block_bytes=1000)
    held = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert dealt.rdd.getNumPartitions() == 64 and sum(held) == 640 and max(held) <= 80
    assert warc.deal_reads(index.limit(0)).count() == 0


def test_coalesced_spans():
    assert warc.spans([0, 10, 30, 500], [10, 10, 5, 5], gap=10, most=100) == [(0, 3, 0, 35), (3, 4, 500, 505)]
    assert warc.spans([0, 10, 20], [10, 10, 10], gap=0, most=20) == [(0, 2, 0, 20), (2, 3, 20, 30)]
    assert warc.spans([], []) == []


def test_given_vectors_match_sql(spark):
    same(spark, "op5_exact_topk")


def brute_topk(rows, queries, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in ok:
        if qi in queries:
            s = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in ok if i != qi)[:k]
            out += [(qi, n + 1, i, -score) for n, (score, i) in enumerate(s)]
    return sorted(out)


def test_topk_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1 + i % 3) for _ in range(6)]) for i in range(900)]
    rows += [(1000 + i, list(rows[7][1])) for i in range(500)]  # a third are one vector
    rows += [(2000, None), (2001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (2004, [0.0] * 6), (2005, [1.0, 2.0]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1.0, "x") for i, v in rows], "vec_id long, embedding array<double>, dist double, block string")
    v = topk.quantise(df, "vec_id", "embedding")
    wanted = {i for i, _ in rows if i is not None and i % 50 == 0} | {2004, 2005}
    for slab in (1, 3, topk.SLAB):
        got = topk.search(v, v.where(v["id"].isin(*wanted)), pivots=12, block=40, slab=slab)
        assert sorted(map(tuple, got.collect())) == brute_topk(rows, wanted, 5)


def test_topk_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    df = topk.quantise(spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], schema), "vec_id", "embedding")
    assert sorted(map(tuple, topk.search(df, df.where("id = 0")).collect())) == [(0, 1, 1, 131072), (0, 2, 2, -65536)]
    assert topk.search(df.limit(0), df.limit(0)).count() == 0
    assert topk.search(df, df.where("id > 5")).count() == 0


def test_topk_hot_vector_is_many_blocks(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(400)] + [(1000 + i, [0.5, -0.25, 0.75, 1.0]) for i in range(3000)]
    v = topk.quantise(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    blocks, _ = topk.build_index(v, pivots=6, block=40)
    sizes = [r.n for r in blocks.select("n").collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 3 * 40
    wanted = {0, 7, 1000, 3999}
    assert sorted(map(tuple, topk.search(v, v.where(v["id"].isin(*wanted)), pivots=6, block=40).collect())) == brute_topk(rows, wanted, 5)
