import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from obsframe.llm import substrings as S
from obsframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute(rows):
    """rows in order: (id, text) -> (id, n_bytes, n_removed, n_spans, sha256)."""
    seen, out = set(), []
    for k, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            w = data[i:i + 100]
            if w in seen:
                gone[i:i + 100] = b"\1" * 100
            else:
                seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((k, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def key(t):
    return tuple((x is not None, x) for x in t)


def check(df, want, **options):
    out = S.dedup(df, **options)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    for r in out.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_given_documents(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    got = [tuple(r) for r in QUERIES["op1_suffix_dedup"](spark, SF_SMALL).collect()]
    assert sorted(got) == sorted(brute(rows))


def thue_morse():
    """Two texts that differ in a Thue-Morse block, beside a 24-byte string that every window with it picks as anchor.

    Sums of letters times powers are most alike for such blocks. These two did not collide in the sums used formerly either."""
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"
    grams = ["".join(rng.choices(letters, k=24)) for _ in range(20_000)]
    buf = np.frombuffer("".join(grams).encode(), np.uint8)
    at = np.arange(len(grams)) * 24
    gram = grams[int(S._mix(S.Rolling(buf, S.ODD).of(at, at + 24, at)).argmin())]
    left, right = ("".join(rng.choices(letters, k=100)) for _ in range(2))
    one, two = ("".join("ab"[i.bit_count() % 2 ^ flip] for i in range(64)) for flip in (0, 1))
    return [(1, left + one + gram + right), (2, left + two + gram + right)]


def test_segments_of_one_anchor_that_differ_in_a_thue_morse_block():
    (_, one), (_, two) = thue_morse()
    n = len(one)
    a = S.Anchors(np.frombuffer((one + two).encode(), np.uint8), np.array([1, 2]), np.array([0, 0]), np.array([n, 2 * n]))
    at = [np.flatnonzero((a.doc == d) & (a.n == 77))[0] for d in (1, 2)]
    assert a.h[at[0]] == a.h[at[1]] and a.g[at[0]] != a.g[at[1]]


def test_texts_that_differ_in_a_thue_morse_block(spark):
    rows = thue_morse()
    check(spark.createDataFrame(rows, "doc_id long, text string"), brute(rows))


def texts():
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, long = prose(60), prose(3000)
    out = [prose(rng.randint(0, 200)) for _ in range(40)]
    for _ in range(80):  # a shared passage between texts of their own, and cut short at either end
        a, b = rng.randint(0, 60), rng.randint(0, 60)
        out.append(prose(rng.randint(0, 20)) + passage[a:len(passage) - b] + prose(rng.randint(0, 20)))
    out += [long, long[:5000] + "X" + long[5000:], long[2000:9000], "z" * 500, "z" * 99, "z" * 100, "ab" * 300, "", None, "é" * 120, long, prose(30) + out[3], out[3], out[3][:99]]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("hot", [4096, 5])
def test_brute_force(spark, hot):
    rows = [(i * 7 - 100, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, doc string, start int").repartition(6)
    check(df, brute(rows), hot=hot)


def test_small_chunks_and_shards(spark, monkeypatch):
    rows = list(enumerate(texts()))
    monkeypatch.setattr(S, "CHUNK", 700)
    S._tables.cache_clear()
    data = [(i, (t or "").encode()) for i, t in rows if t]
    cover, deal = [], []
    for c in S.chunks(iter(data)):
        a = S.Anchors(*c)
        assert len(c[0]) <= 2 * 700 + 99
        deal.append(pd.DataFrame({"k": a.h.view(np.int64), "g": a.g.view(np.int64), "doc": a.doc, "start": a.start, "n": a.n}))
    S._tables.cache_clear()
    rows_ = pd.concat(deal).sort_values(["k", "g", "doc", "start"], ignore_index=True)
    assert rows_["n"].sum() == sum(max(0, len(d) - 99) for _, d in data)  # every window has one anchor
    for size in (1, 3, 50):  # whatever the batches are
        got = pd.concat(S.resolve(rows_.iloc[i:i + size] for i in range(0, len(rows_), size)))
        late, go = got[got["k"].isna()], got[got["k"].notna()]
        by = dict(data)
        go = go.assign(segment=[by[d][s:s + n + 99] for d, s, n in zip(go["doc"], go["start"], go["n"])]).sort_values("k")
        monkeypatch.setattr(S, "SHARD_BYTES", 3000)
        shard = pd.concat(S.sort_shards(go.iloc[i:i + 7] for i in range(0, len(go), 7)))
        all_ = pd.concat([late[["doc", "start", "end"]], shard])
        total = S.merged(*(all_[c].to_numpy(np.int64) for c in ("doc", "start", "end")))
        removed = (total["end"] - total["start"]).groupby(total["doc"]).sum().to_dict()
        assert removed == {k: r for k, _, r, _, _ in brute(rows) if r}
    del cover


def test_repeated_and_null_ids(spark):
    t = " ".join(f"word{i}" for i in range(60))
    rows = [(5, t), (5, t), (5, t), (None, t), (9, "own " + t), (2**60 + 1, "some other text"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in S.dedup(df).collect()), key=key)
    n = len(t)
    assert out == sorted([(5, n, 0), (5, n, n), (5, n, n), (None, n, n), (9, n + 4, n), (2**60 + 1, 15, 0), (None, 0, 0)], key=key)
    assert S.dedup(df.limit(0)).count() == 0


def test_suffixes_and_prefixes():
    rng = np.random.default_rng(0)
    for size, letters in ((1, 3), (50, 2), (700, 2), (700, 200)):
        x = rng.integers(1, letters + 1, size).astype(np.uint16)
        x[size // 3:size // 3 + 200] = x[:len(x[size // 3:size // 3 + 200])]
        order = S.suffix_sort(x)
        cut = [tuple(x[i:]) for i in order]
        assert cut == sorted(cut)
        shared = S.common_prefixes(x, order, lane=16)
        for a, b, n in zip(cut, cut[1:], shared[1:]):
            same = next((i for i, (p, q) in enumerate(zip(a, b)) if p != q), min(len(a), len(b)))
            assert n == min(same, 100)


def test_no_hot_anchor_reaches_a_shard(spark, monkeypatch):
    """A phrase in changing contexts, once per chunk."""
    rng = random.Random(3)
    own = lambda: "".join(rng.choices("abcdefgh ", k=150))
    phrase = own()[:120]
    rows = [(i, own() + phrase + own()) for i in range(40)]
    sort = S.sort_shards

    def checked(batches):
        held = list(batches)
        assert not held or pd.concat(held)["k"].value_counts().max() <= 8, "hot anchor in a shard"
        return sort(iter(held))

    monkeypatch.setattr(S, "sort_shards", checked)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(40)
    check(df, brute(rows), hot=8)
