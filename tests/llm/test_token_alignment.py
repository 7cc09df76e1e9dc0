import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from obsframe.llm import token_alignment
from obsframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, row long, groups string"


def tokens(encoder, text):
    """(A ids, A bytes, B ids, B bytes) of a whole text by the tokenizers, or None."""
    if not text:
        return None
    a, b = encoder.a.encode(" " + text, add_special_tokens=False).ids, encoder.b.encode(text)
    a_bytes, b_bytes = [encoder.a_bytes[i] for i in a], [encoder.b_bytes[i] for i in b]
    said = (" " + text).encode()
    return (a, a_bytes, b, b_bytes) if b"".join(a_bytes) == said == b"".join(b_bytes) else None


def spans(pieces):
    ends = np.cumsum([len(p) for p in pieces]).tolist()
    return list(zip([0, *ends], ends))


def brute(rows):
    """Rows of the query, by plain loops over byte ranges."""
    encoder = token_alignment._encoder(*token_alignment.default_tokenizers())
    docs, count = [], Counter()
    for k, text in rows:
        found = tokens(encoder, text)
        if not found:
            docs.append((k, None))
            continue
        a, a_bytes, b, b_bytes = found
        sa, sb = spans(a_bytes), spans(b_bytes)
        links, low = [], 0
        for i, (s, e) in enumerate(sa):
            while sb[low][1] <= s:
                low += 1
            j = low
            while j < len(sb) and sb[j][0] < e:
                links.append((a[i], b[j]))
                j += 1
        both = sorted({e for _, e in sa} & {e for _, e in sb})
        groups = [(",".join(str(i) for i, (s, e) in zip(a, sa) if lo <= s and e <= hi), ",".join(str(i) for i, (s, e) in zip(b, sb) if lo <= s and e <= hi))
                  for lo, hi in zip([0, *both], both)] if len(both) < 400 else None
        count.update(set(links))
        docs.append((k, (len(a), len(b), len(both), links, groups)))
    highest = defaultdict(int)
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = []
    for k, d in docs:
        if d is None:
            out.append((k, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, links, groups = d
            text = None if groups is None else hashlib.sha256(";".join(f"{x}|{y}" for x, y in groups).encode()).hexdigest()
            out.append((k, n_a, n_b, n_groups, len(links), sum(count[x] == highest[x[0]] for x in links), sum(count[x] for x in links), text))
    return out


def same(found, expected):
    found = sorted((tuple(r) for r in found), key=str)
    expected = sorted(expected, key=str)
    assert len(found) == len(expected)
    left = Counter(x[:-1] for x in expected)
    assert left == Counter(x[:-1] for x in found)
    texts = {x[-1] for x in found}
    assert all(x[-1] is None or x[-1] in texts for x in expected)


def test_given_documents(spark):
    out = QUERIES["op13_token_alignment"](spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    same(out.collect(), brute([tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]))


EDGES = [(1, None), (2, ""), (3, " "), (4, "  two  spaces   three\n\n new\tline "), (5, "a<|endoftext|>b </s> <s> <unk> <0x41>"), (6, "mark ▁ inside ▁▁ here"),
         (7, "école Ünï 中文字 🙂👍🏽 ﬁ é  nbsp　wide ​zero"), (8, "don't I'LL we've 's 12 34.5 x²½"), (9, "\x00 \x1c \x1f\x85 \x7f"), (10, "x" * 3000),
         (11, "the cat " * 2000), (None, "the cat"), (11, "the cat"), (11, "the cat"), (12, "İstanbul ſ ß Σ")]


@pytest.mark.parametrize("shard_keys, fan, slice_bytes, parts", [(1 << 15, 16, 64 << 20, 3), (8, 2, 5000, 6), (500, 2, 4000, 3)])
def test_edge_texts(spark, shard_keys, fan, slice_bytes, parts):
    df = spark.createDataFrame([(k, t, 0, "clash") for k, t in EDGES], SCHEMA).repartition(parts)
    out = token_alignment.align_documents(df, shard_keys=shard_keys, fan=fan, slice_bytes=slice_bytes)
    same([(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in out.collect()], brute(EDGES))


def test_empty_table(spark):
    assert token_alignment.align_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_chunks_equal_whole_texts():
    encoder = token_alignment._encoder(*token_alignment.default_tokenizers())
    rng = random.Random(5)
    letters = "ab cdeAZ  .,'!?-09\n\té中🙂 　\x1c\x85'st▁"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    for text, (a, b) in zip(texts, encoder.encode(texts), strict=True):
        found = tokens(encoder, text) or ([], None, [], None)
        assert np.frombuffer(a, encoder.a_type).tolist() == found[0]
        assert np.frombuffer(b, encoder.b_type).tolist() == found[2]


@pytest.mark.parametrize("n", [0, 1, 2, 100, 30_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n))
    slots = token_alignment.PerfectHash.build(keys).slots(keys)
    assert np.array_equal(np.sort(slots), np.arange(len(keys)))


def test_memory_keeps_recent_chunks_within_its_bound(monkeypatch):
    encoder, learnt = token_alignment.Encoder(*token_alignment.default_tokenizers(), kept=1000), []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda new: (learnt.extend(new), learn(new)))
    texts = ["bad\u2581 word"] + [f"the cat {' '.join(f'w{i}x{j}' for j in range(100))}" for i in range(40)] + ["bad\u2581 word"]
    for t in texts:
        a, b = next(encoder.encode([t]))
        want = tokens(encoder, t) or ([], None, [], None)
        assert (np.frombuffer(a, encoder.a_type).tolist(), np.frombuffer(b, encoder.b_type).tolist()) == (want[0], want[2])
        assert len(encoder.met) + len(encoder.older) <= 1000 + 2 * 102 and encoder.bad <= encoder.met.keys() | encoder.older.keys()
    assert learnt.count("the") == learnt.count("cat") == 1  # the former memory was emptied when full


def test_groups_of_many_documents():
    """Groups written by arrays equal those put together one by one."""
    v = token_alignment.Vocabulary.of(token_alignment.default_tokenizers())
    texts = ["", "x" * 300, "the cat", "中文字 🙂👍🏽", "", "don't I'LL we've 12 34.5", "tokenization alignment "]
    ids = list(token_alignment._encoder(*token_alignment.default_tokenizers()).encode(texts))
    some, names = token_alignment.Aligned(v, *map(list, zip(*ids))), token_alignment.id_names(max(len(v.a_bytes), v.width))
    want, x, y = [], 0, 0
    for i, j in zip((some.at_a + 1).tolist(), (some.at_b + 1).tolist()):
        want.append(",".join(map(str, some.a[x:i].tolist())) + "|" + ",".join(map(str, some.b[y:j].tolist())))
        x, y = i, j
    ends = np.cumsum(some.n_groups).tolist()
    assert some.groups(names) == [";".join(want[s:e]) for s, e in zip([0, *ends], ends)]
    assert token_alignment.Aligned(v, [], []).groups(names) == []
