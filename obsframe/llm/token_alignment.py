"""Alignment of two tokenizers over documents, with corpus-wide counts of the id pairs that they link.

A document is encoded by a byte-level BPE (A, of a space and the text) and by a sentence-piece BPE (B, of the text; it adds
the space). Both give token bytes; byte offsets where tokens of both end cut them into groups, and an A and a B token whose
byte ranges overlap are linked. The count of an id pair is the number of documents that hold it linked.

1. Whole texts are encoded once, and both id arrays stored.
2. First pass: every document is aligned; a task adds up, per pair, its documents that hold it. These partial counts are stored.
3. The distinct pairs, dealt to shards by remainder, get a minimal perfect hash per shard: levels of bits, where a level keeps
   those keys that have a bit to themselves and passes the others on; a key's slot is the rank of its bit. Each slot keeps its key.
4. Partial counts become dense vectors indexed by the hash, one per shard and ``FAN`` tasks, which are added up in a tree of fan-in ``FAN``.
5. Second pass: every document is aligned again, and its pairs' counts are looked up; the key in the slot is verified. The table is
   broadcast in slices of at most ``SLICE_BYTES``; there is one slice unless the distinct pairs outgrow it (then one pass a slice, and their
   sums are added). The highest count of each A id is a vector as long as A's vocabulary.

Aligning is arithmetic on sorted arrays of byte offsets: every stretch between two neighbouring ends, of either tokenizer, is the overlap of
one A and one B token, and so one link. Neither tokenizer joins anything across a single space between two other characters (B has no
piece with a space after another character, which is checked), so texts are encoded chunk by chunk between such spaces, and a worker
remembers the chunks it has met (``CHUNKS_KEPT``; those not met for long are forgotten). Pairs are counted in the task before any shuffle, so frequent ones
cost one row a task.

Defined results: texts null, empty, or whose joined A or B bytes differ from a space and the text have no tokens, zeros and empty
``groups``. Repeated rows and null ids are documents like others. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import materialise, ship

CHUNKS_KEPT = 400_000
TOKENS_AT_ONCE = 1 << 16
DOCS_AT_ONCE = 256
PAIRS_HELD = 1 << 20
SHARD_KEYS = 1 << 15
FAN = 16
SLICE_BYTES = 64 << 20
SPACES = re.compile(r"(?<=\S) (?=\S)")
ODD_SPACE = re.compile(r"[^\S \n]")
MARK = "▁"
STATS = ("n_a", "n_b", "n_groups", "n_links")


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Encoder:
    """Both tokenizers, and the ids of the chunks met so far."""

    def __init__(self, a_path: str, b_path: str, kept: int = CHUNKS_KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a, self.b, self.kept = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path), kept
        self.a.encode_special_tokens = True
        # byte-level vocabularies show a byte as its printable Latin-1 character, and the others, in order, from U+0100 on
        plain = [x for x in range(256) if 0x21 <= x <= 0x7E or 0xA1 <= x <= 0xFF and x != 0xAD]
        shown = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
        self.a_bytes = [bytes(shown.get(c, 63) for c in self.a.id_to_token(i)) for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_type, self.b_type = (f"<u{2 if len(x) <= 1 << 16 else 4}" for x in (self.a_bytes, self.b_bytes))
        self.whole = any(MARK in p.lstrip(MARK) for p in pieces)  # then texts cannot be cut
        self.met: dict[str, tuple[bytes, bytes]] = {}
        self.older, self.bad = self.met, set()  # chunks met before these, and those that their tokens do not spell

    def chunks(self, text: str) -> list[str]:
        if self.whole:
            return [text]
        if "  " in text or " \n" in text or "\n " in text or " " in (text[0], text[-1]) or ODD_SPACE.search(text):
            return SPACES.split(text)
        return text.split(" ")

    def learn(self, new: list[str]) -> None:
        a = [e.ids for e in self.a.encode_batch_fast([" " + c for c in new], add_special_tokens=False)]
        b = self.b.encode(new, num_threads=1)
        said = (" " + " ".join(new)).encode()
        same = [b"".join(map(table.__getitem__, itertools.chain.from_iterable(ids))) == said for table, ids in ((self.a_bytes, a), (self.b_bytes, b))]
        for c, x, y in zip(new, a, b, strict=True):
            if not all(same) and any(b"".join(map(table.__getitem__, ids)) != b" " + c.encode() for table, ids in ((self.a_bytes, x), (self.b_bytes, y))):
                self.bad.add(c)
                self.met[c] = b"", b""
            else:
                self.met[c] = array(self.a_type, x), array(self.b_type, y)

    def meet(self, chunks: set[str]) -> None:
        """Make sure that these chunks are remembered. What was not met while half of the memory filled up is forgotten."""
        if len(self.met) > self.kept // 2:
            self.older, self.met = self.met, {}
            self.bad &= self.older.keys()
        new = chunks.difference(self.met)
        known = new.intersection(self.older)
        self.met.update(zip(known, map(self.older.__getitem__, known)))
        if new := list(new.difference(known)):
            self.learn(new)

    def encode(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """A and B ids of each text, both empty for texts without tokens."""
        for i in range(0, len(texts), DOCS_AT_ONCE):
            some = [self.chunks(t) if t else [] for t in texts[i:i + DOCS_AT_ONCE]]
            self.meet(set().union(*some))
            for t in some:
                if not t or self.bad and not self.bad.isdisjoint(t):
                    yield b"", b""
                else:
                    found = list(map(self.met.__getitem__, t))
                    yield b"".join([x for x, _ in found]), b"".join([y for _, y in found])


@lru_cache(maxsize=256)
def _packer(kind: str, n: int) -> struct.Struct:
    return struct.Struct(f"<{n}{'H' if kind == '<u2' else 'I'}")


def array(kind: str, ids: list[int]) -> bytes:
    return _packer(kind, len(ids)).pack(*ids)


@lru_cache(maxsize=1)
def _encoder(a_path: str, b_path: str) -> Encoder:
    return Encoder(a_path, b_path)


class Vocabulary(NamedTuple):
    """What aligning needs: how ids are stored, and how many bytes each token has."""

    a_type: str
    b_type: str
    a_bytes: np.ndarray
    b_bytes: np.ndarray

    @classmethod
    def of(cls, paths: tuple[str, str]) -> Vocabulary:
        e = _encoder(*paths)
        return cls(e.a_type, e.b_type, *(np.array([len(x) for x in t], np.int64) for t in (e.a_bytes, e.b_bytes)))

    @property
    def width(self) -> int:
        return len(self.b_bytes)


class Aligned:
    """Some documents aligned at once: links as ``pairs`` (a * width + b) with the ``doc`` of each, and the numbers of each document."""

    def __init__(self, v: Vocabulary, a: list[bytes], b: list[bytes]):
        self.n_a, self.n_b = (np.array([len(x) for x in t], np.int64) // np.dtype(kind).itemsize for t, kind in ((a, v.a_type), (b, v.b_type)))
        self.a, self.b = np.frombuffer(b"".join(a), v.a_type), np.frombuffer(b"".join(b), v.b_type)
        self.a_ends, self.b_ends = np.cumsum(v.a_bytes[self.a]), np.cumsum(v.b_bytes[self.b])  # documents end at the same byte in both
        ends = np.sort(np.concatenate((self.a_ends, self.b_ends)), kind="stable")  # merges two sorted runs
        last = np.append(ends[1:] != ends[:-1], len(ends) > 0)[:len(ends)]
        ends = ends[last]
        common = np.diff(np.flatnonzero(last), prepend=-1) == 2
        i = np.zeros(len(ends) + 1, np.int64)  # tokens of A that end before each stretch's end
        i[np.searchsorted(ends, self.a_ends) + 1] = 1
        i = np.cumsum(i[:-1])
        j = np.arange(len(ends)) - i + np.cumsum(common) - common
        self.pairs = self.a[i].astype(np.int64) * v.width + self.b[j]
        self.doc = np.repeat(np.arange(len(a)), self.n_a)[i]
        self.at_a, self.at_b = i[common], j[common]  # last tokens of each group
        self.n_links = np.bincount(self.doc, minlength=len(a))
        self.n_groups = np.bincount(self.doc[common], minlength=len(a))

    def groups(self, names: list[str]) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document. ``names`` are ``id_names``."""
        n = len(names) // 3
        a, b = self.a.astype(np.int64), self.b.astype(np.int64)
        a[self.at_a] += n
        b[self.at_b] += 2 * n
        codes = np.empty(len(a) + len(b), np.int64)  # a group's A tokens come after the B tokens of the groups before, its B tokens after all its A tokens
        codes[np.arange(len(a)) + np.repeat(np.append(0, self.at_b[:-1] + 1)[:len(self.at_b)], np.diff(self.at_a, prepend=-1))] = a
        codes[np.arange(len(b)) + np.repeat(self.at_a + 1, np.diff(self.at_b, prepend=-1))] = b
        said, ends = list(map(names.__getitem__, codes.tolist())), np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(said[s:e])[:-1] for s, e in zip([0, *ends], ends)]


def id_names(n: int) -> list[str]:
    """Decimal ids below ``n`` as ``groups`` writes them: followed by a comma, then all by a bar, then all by a semicolon."""
    return [f"{i}{mark}" for mark in ",|;" for i in range(n)]


def some_at_once(v: Vocabulary, b: pa.RecordBatch) -> Iterator[tuple[slice, Aligned]]:
    """The documents of a batch, aligned ``TOKENS_AT_ONCE`` at a time (a longer document is alone)."""
    ids = [b.column(c).to_pylist() for c in ("a", "b")]
    start, size = 0, 0
    for i, x in enumerate(ids[0]):
        if size and size + len(x) > 2 * TOKENS_AT_ONCE:
            yield slice(start, i), Aligned(v, ids[0][start:i], ids[1][start:i])
            start, size = i, 0
        size += len(x)
    if len(ids[0]):
        yield slice(start, len(ids[0])), Aligned(v, ids[0][start:], ids[1][start:])


def mix(keys: np.ndarray, level: int) -> np.ndarray:
    """64-bit hashes of keys, different for each level."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)
        for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # the finaliser of splitmix64, a public generator
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct keys to 0 .. n - 1. ``sizes`` are the levels' bits, ``words`` all bits; ``ranks`` bits set before each word."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.ranks = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, words, left = [], [], keys
        while len(left):
            size = -(-3 * len(left) // 128) * 64
            place = (mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[place]]
        return cls(np.array(sizes, np.int64), np.concatenate(words) if words else np.empty(0, "<u8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; of a key that was not built in, any slot, or -1."""
        out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            place = (mix(keys[left], level) % np.uint64(size)).astype(np.int64) + base
            word, bit = self.words[place >> 6], (place & 63).astype(np.uint64)
            set_ = (word >> bit & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[set_]] = self.ranks[place[set_] >> 6] + below[set_]
            left, base = left[~set_], base + size
        return out


def encode(docs: DataFrame, key: str, text: str, paths: tuple[str, str]) -> DataFrame:
    """Stored ``row, k, a, b``: the ids of both tokenizers as little-endian binary."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*paths)
        for b in batches:
            found = list(encoder.encode(b.column("t").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("k"), *(pa.array([x[i] for x in found], pa.binary()) for i in (0, 1))], ["row", "k", "a", "b"])

    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("k"), F.col(text).alias("t"))
    return materialise(d.mapInArrow(run, f"row long, k {kind}, a binary, b binary"), "alignment-ids")


def partial_counts(ids: DataFrame, v: Vocabulary) -> DataFrame:
    """``(part, pair, n)``: per task, the number of its documents that hold a pair linked."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, most = TaskContext.get().partitionId(), len(v.a_bytes) * v.width
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def add(pairs: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            found, where = np.unique(pairs, return_inverse=True)
            return found, np.bincount(where, n, len(found)).astype(np.int64)

        def out(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs), part, np.int32)), pa.array(pairs), pa.array(n)], ["part", "pair", "n"])

        for b in batches:
            for _, some in some_at_once(v, b):
                held.append(np.unique(np.unique(some.doc * most + some.pairs) % most, return_counts=True))
                if sum(len(x) for x, _ in held) > PAIRS_HELD:
                    held = [add(*map(np.concatenate, zip(*held, strict=True)))]
                    if len(held[0][0]) > PAIRS_HELD // 2:
                        yield out(*held.pop())
        if held:
            yield out(*add(*map(np.concatenate, zip(*held, strict=True))))

    return ids.select("a", "b").mapInArrow(count, "part int, pair long, n long")


HASHES = "shard int, n int, sizes binary, words binary, keys binary"


def hash_pairs(pairs: DataFrame, shards: int) -> DataFrame:
    """A minimal perfect hash per shard of distinct ``pair`` values, with the keys in slot order."""

    def build(table: pa.Table) -> pa.Table:
        keys = np.sort(table.column("pair").to_numpy())
        h = PerfectHash.build(keys)
        kept = np.empty(len(keys), np.int64)
        kept[h.slots(keys)] = keys
        row = (int(table.column("shard")[0].as_py()), len(keys), h.sizes.tobytes(), h.words.tobytes(), kept.tobytes())
        return pa.Table.from_arrays([pa.array([x], t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                                    [c.split()[0] for c in HASHES.split(", ")])

    return pairs.select((F.col("pair") % shards).cast("int").alias("shard"), "pair").groupBy("shard").applyInArrow(build, HASHES)


def read_hash(sizes: bytes, words: bytes) -> PerfectHash:
    return PerfectHash(np.frombuffer(sizes, np.int64), np.frombuffer(words, "<u8"))


def tree_sum(partial: DataFrame, hashes: DataFrame, shards: int, parts: int, fan: int = FAN) -> DataFrame:
    """``(shard, counts)``: dense vectors in slot order, added up ``fan`` at a time."""
    schema = "shard int, leaf int, counts binary"

    def row(shard: int, leaf: int, counts: np.ndarray) -> pa.Table:
        return pa.Table.from_arrays([pa.array([shard], pa.int32()), pa.array([leaf], pa.int32()), pa.array([counts.tobytes()], pa.binary())], ["shard", "leaf", "counts"])

    def first(found: pa.Table, known: pa.Table) -> pa.Table:
        h = known.to_pylist()[0]
        pairs, n = found.column("pair").to_numpy(), found.column("n").to_numpy()
        slots = read_hash(h["sizes"], h["words"]).slots(pairs)
        if not np.array_equal(np.frombuffer(h["keys"], np.int64)[slots], pairs):
            raise ValueError("a pair is not in its slot")
        return row(h["shard"], h["leaf"], np.bincount(slots, n, h["n"]).astype(np.int64))

    def again(some: pa.Table) -> pa.Table:
        rows = some.to_pylist()
        return row(rows[0]["shard"], rows[0]["leaf"], sum(np.frombuffer(r["counts"], np.int64) for r in rows))

    leaves = -(-parts // fan)
    found = partial.select((F.col("pair") % shards).cast("int").alias("shard"), F.floor(F.col("part") / fan).cast("int").alias("leaf"), "pair", "n")
    wanted = materialise(found.select("shard", "leaf").distinct(), "alignment-leaves").join(hashes, "shard")
    sums = found.groupBy("shard", "leaf").cogroup(wanted.groupBy("shard", "leaf")).applyInArrow(first, schema)
    while leaves > 1:
        sums = materialise(sums, "alignment-counts").withColumn("leaf", F.floor(F.col("leaf") / fan).cast("int"))
        sums = sums.groupBy("shard", "leaf").applyInArrow(again, schema)
        leaves = -(-leaves // fan)
    return sums.select("shard", "counts")


class Lookup:
    """Counts of the pairs of some shards."""

    def __init__(self, rows: list, shards: int):
        self.shards = shards
        self.of = {r["shard"]: (read_hash(r["sizes"], r["words"]), np.frombuffer(r["keys"], np.int64), np.frombuffer(r["counts"], np.int64)) for r in rows}

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        """The count of each of these distinct pairs, 0 if its shard is not among these."""
        out, shard = np.zeros(len(pairs), np.int64), pairs % self.shards
        order = np.argsort(shard.astype(np.uint16) if self.shards <= 1 << 16 else shard, kind="stable")  # short keys are sorted by radix
        for rows in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(pairs) else []:
            if known := self.of.get(int(shard[rows[0]])):
                h, keys, counts = known
                slots = h.slots(pairs[rows])
                if not np.array_equal(keys[slots], pairs[rows]):
                    raise ValueError("a pair was not counted")
                out[rows] = counts[slots]
        return out


def look_up(ids: DataFrame, slice_, best, v: Vocabulary, whole: bool = True) -> DataFrame:
    """``row, k``, the numbers of each document, ``n_best`` and ``count_sum`` over the pairs of one slice and, if ``whole``, ``groups``."""
    kind = ids.schema["k"].dataType.simpleString()
    schema = f"row long, k {kind}, " + ", ".join(f"{c} long" for c in (*STATS, "n_best", "count_sum")) + ", groups string"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, highest = slice_.value, best.value
        names = id_names(max(len(v.a_bytes), v.width))
        for b in batches:
            for rows, some in some_at_once(v, b):
                n = len(some.n_a)
                pairs, where = np.unique(some.pairs, return_inverse=True)
                counts = lookup(pairs)
                top = (counts > 0) & (counts == highest[pairs // v.width])
                sums = (np.bincount(some.doc, w[where], n).astype(np.int64) for w in (top, counts))
                groups = some.groups(names) if whole else [None] * n
                part = b.slice(rows.start, n)
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("k"), *(pa.array(x) for x in (some.n_a, some.n_b, some.n_groups, some.n_links, *sums)),
                                                  pa.array(groups, pa.string())], [c.split()[0] for c in schema.split(", ")])

    return ids.mapInArrow(count, schema)


def align_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizers: tuple[str, str] | None = None,
                    shard_keys: int = SHARD_KEYS, fan: int = FAN, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """One row per document: key, ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and ``groups``."""
    spark, paths = ship(docs.sparkSession), tokenizers or default_tokenizers()
    sc, v = spark.sparkContext, Vocabulary.of(paths)
    ids = encode(docs, key, text, paths)
    partial = materialise(partial_counts(ids, v), "alignment-partial")
    pairs = materialise(partial.select("pair").distinct(), "alignment-pairs")
    shards = max(1, -(-pairs.count() // shard_keys))
    shards += next(i for i in range(10) if (shards + i) % 2 and (shards + i) % 5)  # remainders of a * width + b spread evenly
    hashes = materialise(hash_pairs(pairs, shards), "alignment-hashes")
    parts = (partial.agg(F.max("part")).first()[0] or 0) + 1
    table = materialise(hashes.join(tree_sum(partial, hashes, shards, parts, fan), "shard"), "alignment-table")

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                a, n = np.frombuffer(r["keys"], np.int64) // v.width, np.frombuffer(r["counts"], np.int64)
                found = np.unique(a)
                most = np.zeros(len(found), np.int64)
                np.maximum.at(most, np.searchsorted(found, a), n)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(most)], ["a", "n"])

    highest = np.zeros(len(v.a_bytes), np.int64)
    for r in table.select("keys", "counts").mapInArrow(tops, "a long, n long").groupBy("a").agg(F.max("n").alias("n")).collect():  # at most A's vocabulary
        highest[r["a"]] = r["n"]
    best = sc.broadcast(highest)

    size = F.octet_length("sizes") + F.octet_length("words") + F.octet_length("keys") + F.octet_length("counts")
    total, largest = table.agg(F.sum(size), F.max(size)).first()
    slices = min(shards, -(-total // max(1, slice_bytes - largest))) if (total or 0) > slice_bytes else 1
    passes = []
    for i in range(slices):
        rows = table.where(F.col("shard") % slices == i).collect()  # about slice_bytes at most
        passes.append(look_up(ids, sc.broadcast(Lookup(rows, shards)), best, v, whole=i == 0))
    out = passes[0]
    if slices > 1:
        rest = passes[1].select("row", "n_best", "count_sum")
        for p in passes[2:]:
            rest = rest.unionByName(p.select("row", "n_best", "count_sum"))
        rest = rest.groupBy("row").agg(F.sum("n_best").alias("more_best"), F.sum("count_sum").alias("more_sum"))
        out = out.join(rest, "row").withColumns({"n_best": F.col("n_best") + F.col("more_best"), "count_sum": F.col("count_sum") + F.col("more_sum")})
    return out.select(F.col("k").alias(key), *STATS, "n_best", "count_sum", "groups")
