import random

import numpy as np
import xxhash

from obsframe.llm import simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, rep string"


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    comp = {i: i for i in fps}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                lo, hi = sorted((root(a), root(b)))
                comp[hi] = lo
    return {i: root(i) for i in ids}


def docs():
    rng = random.Random(3)
    vocab = ["w%d" % i for i in range(400)]
    texts = [" ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 30, 200]))) for _ in range(60)]
    for base in (texts[0], " ".join(vocab)):
        for _ in range(25):
            w = base.split()
            w[rng.randrange(len(w))] = rng.choice(vocab)
            texts.append(" ".join(w))
    texts += [None, "", " \t\n", "ÀB c", "àB C", "x " * 70_000] + [texts[5]] * 12
    return [(i * 3, t, "en", "s", 1, "clash", "clash") for i, t in enumerate(texts)]


def test_matches_brute_force(spark):
    rows = docs()
    out = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    fps = {r[0]: brute_print(r[1]) for r in rows}
    assert {k: r.fingerprint for k, r in out.items()} == {k: f"{v:016x}" for k, v in fps.items()}
    assert {k: r.component_id for k, r in out.items()} == brute_components(fps)


def test_shared_buckets_and_hot_split(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 8, dtype=np.uint64)
    fps = {}
    for i in range(500):
        x = int(base[i % 8])
        for b in rng.choice(64, rng.integers(0, 6), replace=False):
            x ^= 1 << int(b)
        fps[x] = i
    distinct = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x, i) for x, i in fps.items()], "fp long, rep long")
    want = brute_components({i: x for x, i in fps.items()})
    for hot in (20_000, 10):
        got = {r.node: r.component for r in simhash.connected_components(simhash.link_distinct(distinct, hot)).collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_chain_budget_loses_no_pair():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3):
        for _ in range(300):
            diff = sum(1 << int(b) for b in rng.choice(64, n, replace=False))
            found = [t for t, start, m in simhash._masks() if diff & m == 0 and simhash.chain_holds(np.array([diff], np.uint64), start)[0]]
            assert found


def test_empty_and_keep_one(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    long = " ".join(f"word{i}" for i in range(50))
    df = spark.createDataFrame([(4, long, None, None, 1, "", ""), (2, long, None, None, 1, "", ""), (9, "other text here now", None, None, 1, "", ""), (None, "a b c", None, None, 1, "", "")], SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {2, 9, None}


def test_keep_one_of_repeated_rows(spark):
    long, other = " ".join(f"word{i}" for i in range(50)), " ".join(f"else{i}" for i in range(50))
    rows = [(3, long), (3, long), (3, long), (5, long), (3, other), (8, other), (None, long), (None, long)]
    df = spark.createDataFrame([(i, t, None, None, k, "", "") for k, (i, t) in enumerate(rows)], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=str)
    assert kept == sorted([(3, long), (3, other), (None, long), (None, long)], key=str)
