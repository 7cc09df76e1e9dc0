import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from obsframe.llm import packing
from obsframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, piece string, length string"


def ids_of(text):
    tokenizer = packing._ids(packing.default_tokenizer()).tokenizer
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def check(out, texts):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for k, rs in by_doc.items():
        ids = ids_of(texts[k])
        for i, r in enumerate(sorted(rs, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (i, 2048 * i)
            assert r.length == min(2048, len(ids) - r.start)
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
        assert sum(r.length for r in rs) == len(ids)
    for rs in by_seq.values():
        rs.sort(key=lambda r: r.offset)
        at = 0
        for r in rs:
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert set(by_doc) == set(texts)
    return len(by_seq), -(-sum(r.length for r in out) // 2048)


def test_given_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    made, least = check(QUERIES["op8_best_fit_packing"](spark, SF_SMALL).collect(), texts)
    assert made <= least * 1.01 + 1


def test_edge_texts(spark):
    texts = {1: None, 2: "", 3: " \n", 4: "a b<|endoftext|>c <|x|>", 5: "a b​c\x1cd\x85e", 6: "don't 's12 ½ &&'s x'S I'LL", 7: "ÁB İI ß ſ Σ ΑΣ",
             8: "a\x00b \x7f", 9: "word " * 9000, 10: "e ́x", 11: "x" * 5000}
    df = spark.createDataFrame([(k, t, "en", "clash", "clash") for k, t in texts.items()], SCHEMA)
    check(packing.pack_documents(df).collect(), texts)
    assert packing.pack_documents(df.limit(0)).count() == 0


def test_words_put_together_equal_whole_texts(spark):
    ids = packing._ids(packing.default_tokenizer())
    words = ["École", "İstanbul", "ſtraße", "Ǆ", "naïve's", "ÀÉÎÕÜ¡¿", "x²½", "e\u0301cole", "ÿŸ", "\u00ad", "µm", "ŉa", "ĿL", "中文", "Ωmega", "a\u200b"]
    texts = [w.join((" ", "x ", "")) for w in words] + [" ".join(words)]
    texts += [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert all(ids.encode(t) == ids.direct(t) for t in texts)


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, "some words here", None, None, None)] * 3 + [(7, "again", None, None, None)] * 500
    out = packing.pack(packing.pieces(spark.createDataFrame(rows, SCHEMA)), group_pieces=100).collect()
    assert len(out) == 503 and sum(r.doc_id is None for r in out) == 3
    places = {(r.sequence_id, r.offset) for r in out}
    assert len(places) == 503


def brute_sum_of_squares(lengths, size):
    bins, where = [], []
    for s in lengths:
        def cost(i):
            gaps = [size - b - (s if j == i else 0) for j, b in enumerate(bins)]
            return sum(gaps.count(g) ** 2 for g in set(gaps) if g)
        fits = [i for i, b in enumerate(bins) if b + s <= size]
        if fits:
            best = min(fits, key=lambda i: (cost(i), size - bins[i]))
            where.append(bins[best])
            bins[best] += s
        else:
            where.append(0)
            bins.append(s)
    return sorted(bins), where


def test_rule_against_brute_force():
    rng = random.Random(2)
    for _ in range(30):
        lengths = np.array([rng.randint(1, 20) for _ in range(40)])
        bins, offsets = packing.sum_of_squares(lengths, 20)
        fill = defaultdict(int)
        for b, s in zip(bins, lengths):
            fill[b] += int(s)
        assert (sorted(fill.values()), offsets.tolist()) == brute_sum_of_squares(lengths.tolist(), 20)


def test_word_memory_is_exact_and_keeps_frequent_words():
    ids = packing.WordIds(packing.default_tokenizer())
    rng, letters = random.Random(3), "abCD éÑßİıſœŸªµ'.,;:!?)*&9\u0307中"
    texts = ["İ. İi, ſ! ª) µ; Œuvre. a's don't. x.. (x) <|endoftext|>. 中文. n̈o, é́."] + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(2000)]
    for t in texts:
        assert ids.encode(t) == ids.direct(t), t
    made, few = Counter(), packing.Recent(lambda k: (made.update([k]), k.encode())[1], 100)
    for i in range(1000):
        assert few["the"] == b"the" and few[f"w{i}"] == b"w%d" % i and len(few) + len(few.older) <= 100
    assert made["the"] == 1 and len(made) == 1001  # emptied when full, it would be made again


def test_texts_are_encoded_together(monkeypatch):
    """Of some texts at once each unit goes to the tokenizer once, with all others in one call, whatever forms and words it is in."""
    monkeypatch.setattr(packing, "AT_ONCE", 1000)
    ids, asked = packing.WordIds(packing.default_tokenizer()), []
    make_all = ids.units.make_all
    ids.units.make_all = lambda units: (asked.append(list(units)), make_all(units))[1]
    texts = pa.array(["Tree, tree's TREE. été", None, "", " tree;été 中文 ſ\xa0İ", "a\x1cb tree", "x" * 3000, "tree ñ <|endoftext|>."])
    assert ids.encode_all(texts) == [ids.direct(t or "") for t in texts.to_pylist()]
    assert len(asked) == 3 and sorted(asked[0]) == sorted(["tree", ",", "'s", ".", ";", "été", "ſ", "a", "b"])
    assert asked[1] == ["x" * 3000] and asked[2] == ["ñ"]
    assert ids.encode_all(texts.slice(3, 1)) == [ids.direct(texts[3].as_py())] and ids.encode_all(texts.slice(1, 1)) == [b""] and ids.encode_all(texts[:0]) == []


def test_every_character_beside_others():
    ids, seen = packing.WordIds(packing.default_tokenizer()), [*range(1, 0x250), 0x300, 0x307, 0x3A3, 0x3C3, 0x1E9E, 0x2019, 0x200B, 0x212A, 0x3000, 0x4E2D, 0xFB01, 0x1F600]
    texts = [form.replace("_", chr(c)) for c in seen for form in ("_", "a_", "_B", "'_", "'s_", "_'LL", "X _ 9_.", ".'_re", "_" * 3, "\u00ad_ <|_")]
    assert ids.encode_all(pa.array(texts)) == [ids.direct(t) for t in texts]


def test_memory_of_many_keys():
    made, few = Counter(), packing.Recent(lambda k: (made.update([k]), k.encode())[1], 100)
    for i in range(0, 1000, 10):
        keys = ["the", *(f"w{j}" for j in range(i, i + 10))]
        assert few.many(keys) == [k.encode() for k in keys] and len(few) + len(few.older) <= 100
    assert made["the"] == 1 and len(made) == 1001
    keys = [f"v{i}" for i in range(500)]
    assert few.many(keys) == [k.encode() for k in keys] and few.many([]) == []


def test_a_vocabulary_without_marks_is_encoded_unit_by_unit():
    ids = packing.WordIds(packing.default_tokenizer())
    ids.last[:] = False
    assert ids.encode("some words, été") == ids.direct("some words, été")


def test_a_batch_is_cut_without_the_ids_of_all_its_texts():
    """A task holds the ids of some texts, not those of its whole batch."""
    ids, texts = packing.WordIds(packing.default_tokenizer()), pa.array(["many small words, " * 3000] * 160)

    def peak(work):
        tracemalloc.start()
        work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    ids.encode_all(texts[:1])  # so that the words are known
    whole = 160 * 4 * 3000 * 4
    assert peak(lambda: ids.encode_all(texts)) > whole
    assert peak(lambda: packing.cut_documents(ids, pa.array(range(160)), texts)) < whole


def test_large_ids_beside_null_ids(spark):
    rows = [((1 << 60) + 1, "some words", None, None, None), (None, None, None, None, None)]
    out = packing.pieces(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()
    assert {r.doc_id for r in out} == {(1 << 60) + 1, None}  # null ids made floats of the others
