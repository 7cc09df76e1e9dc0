"""Best-fit packing of tokenised documents by the sum-of-squares rule.

A document is its token ids followed by id 0. Only documents longer than a sequence are
cut, into pieces of one sequence each and a rest. Pieces that fill a sequence take one
each; the others are dealt evenly (by hash) to groups of about ``GROUP_PIECES`` and
packed group by group: each piece goes to the open sequence for which the sum, over all
residual gaps, of the squared number of open sequences with that gap becomes smallest; a
new sequence is started only when no open one has room. Pieces of a group come largest
first, so the small ones close the gaps that large ones leave; a group leaves at most a
few sequences part-filled, which is a vanishing share of its sequences.

Tokenising is one map-only pass over whole texts, some megabytes of them at once: their
distinct words are cut into units, and each distinct unit is encoded once. Units recur, so each Python worker
remembers the ids of the units it has met (a bounded memory that forgets units not met for long).

Defined results: a null or empty text is the single id 0. Repeated rows are packed like
any other rows.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import materialise, ship

SEQUENCE = 2048
GROUP_PIECES = 60_000
END = b"\x00\x00\x00\x00"
WORDS_KEPT = 240_000
AT_ONCE = 2 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Recent(dict):
    """Remembered results of ``make``, at most ``most``: those not asked for while half of them came anew are forgotten, frequent ones stay.

    ``many`` asks for distinct keys at once, and ``make_all`` makes the new ones; of one call all are kept, even beyond ``most``.
    """

    def __init__(self, make: Callable, most: int, make_all: Callable | None = None):
        super().__init__()
        self.make, self.half, self.older = make, max(1, most // 2), {}
        self.make_all = make_all or (lambda keys: map(make, keys))

    def __missing__(self, key):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        self.room(1)
        self[key] = found
        return found

    def room(self, coming: int) -> None:
        if len(self) + coming > self.half:
            self.older = self.copy()
            self.clear()

    def many(self, keys: list) -> list:
        found = [*map(self.get, keys)]
        absent = [k for k, v in zip(keys, found, strict=True) if v is None]
        known = {k: v for k in absent if (v := self.older.get(k)) is not None}
        new = [k for k in absent if k not in known]
        known.update(zip(new, self.make_all(new), strict=True))
        self.room(len(known))
        self.update(known)
        return [known[k] if v is None else v for k, v in zip(keys, found, strict=True)]


def strings(a: pa.Array) -> list[str]:
    return a.to_numpy(zero_copy_only=False).tolist()


def joined(parts: pa.LargeBinaryArray, cuts: np.ndarray) -> pa.LargeBinaryArray:
    """The bytes of neighbouring parts as one value, from each cut to the next; nothing is copied."""
    _, offsets, data = parts.buffers()
    ends = np.frombuffer(offsets, np.int64, len(parts) + 1)[cuts]
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(ends), data or pa.py_buffer(b"")])


class WordIds:
    """Whole-text token ids as little-endian unsigned 32-bit bytes, put together word by word.

    The tokenizer normalises and splits within white space, so a text's ids are those of its
    words in order; and within a word those of the units that its split pattern finds.
    """

    # The tokenizer file's own split pattern; the space between words that are cut at once.
    UNITS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+| ")
    ODD_SPACE = "[\x1c-\x1f]"  # Arrow and the tokenizer disagree on these four
    # Words other than plain Latin go to the tokenizer as they are. Of Latin letters only U+0130 has a lower case of two
    # characters, none has one that depends on its neighbours, and all are in normal form.
    ODD_WORD = r"[^\x21-\x7e\x{a1}-\x{17f}]|\x{ad}|\x{130}|<\|"
    LAST = "</w>"  # ends the last piece of each unit

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.bare = Tokenizer(self.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for piece, i in vocabulary.items() if piece.endswith(self.LAST)]] = True
        self.units, self.odd = Recent(self.unit, WORDS_KEPT, self.encode_units), Recent(self.direct, WORDS_KEPT)
        # byte-level vocabularies show a byte as its printable Latin-1 character, and the others, in order, from U+0100 on
        plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
        odd = [b for b in range(256) if b not in plain]
        self.shown = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)} | {ord(" "): " "}  # units have no space

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def show(self, units: str) -> str:
        return units if units.isascii() else units.encode().decode("latin-1").translate(self.shown)

    def unit(self, u: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(self.show(u))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of each unit: all are encoded at once, and cut after the last pieces."""
        ids = np.array(self.bare.encode_batch_fast([self.show(" ".join(units))], add_special_tokens=False)[0].ids, "<u4")
        cuts = [0, *(4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()]
        if len(cuts) != len(units) + 1 or cuts[-1] != 4 * len(ids):  # a vocabulary that does not mark them so
            return [self.unit(u) for u in units]
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_words(self, words: pa.Array) -> pa.LargeBinaryArray:
        """The ids of each of distinct words."""
        odd = pc.match_substring_regex(words, self.ODD_WORD)
        whole = pc.and_not(pc.utf8_is_alpha(words), odd)
        alone = pc.utf8_lower(words.filter(whole))
        mixed = strings(words.filter(pc.invert(pc.or_(whole, odd))))
        found = pa.array(self.UNITS.findall(" ".join(mixed).lower()), alone.type)
        spaces = pc.equal(found, " ")
        units = pa.concat_arrays([alone, pc.if_else(spaces, None, found)]).dictionary_encode()
        ids = pa.array(self.units.many(strings(units.dictionary)), pa.large_binary()).take(units.indices)
        ends = np.flatnonzero(spaces.to_numpy(zero_copy_only=False))  # a space has no ids
        ids = joined(ids, np.r_[0:len(alone) + 1, len(alone) + ends, [len(ids)] * bool(mixed)].astype(int))
        others = pa.array(self.odd.many(strings(words.filter(odd))), pa.large_binary())
        kind = pc.if_else(odd, 2, pc.if_else(whole, 0, 1)).to_numpy()
        return pa.concat_arrays([ids, others]).take(pa.array(np.argsort(np.argsort(kind, kind="stable"))))

    def encode_some(self, texts: pa.Array) -> list[bytes]:
        split = pc.utf8_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        ids = joined(self.encode_words(words.dictionary).take(words.indices), split.offsets.to_numpy()).to_pylist()
        for i in np.flatnonzero(pc.fill_null(pc.match_substring_regex(texts, self.ODD_SPACE), False).to_numpy(zero_copy_only=False)).tolist():
            ids[i] = self.direct(texts[i].as_py())
        return ids

    def encode_parts(self, texts: pa.Array) -> Iterator[list[bytes]]:
        """The ids of each text (of null none), about ``AT_ONCE`` bytes of text at a time: a list of each such part."""
        low, ends = 0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        while low < len(texts):
            high = max(low + 1, int(ends.searchsorted((ends[low - 1] if low else 0) + AT_ONCE, "right")))
            yield self.encode_some(texts[low:high])
            low = high

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        return [x for part in self.encode_parts(texts) for x in part]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]


@lru_cache(maxsize=2)
def _ids(path: str) -> WordIds:
    return WordIds(path)


def cut_document(ids: bytes, sequence: int = SEQUENCE) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of the pieces of one document's ids."""
    n, step = len(ids) // 4, sequence
    return [(i, s, min(step, n - s), zlib.crc32(ids[4 * s:4 * (s + step)])) for i, s in enumerate(range(0, n, step))]


def cut_documents(ids: WordIds, keys: pa.Array, texts: pa.Array, sequence: int = SEQUENCE) -> pa.RecordBatch:
    """The ``PIECES`` of a batch. The ids are dropped part by part, and what Arrow's pool keeps for later goes back at the end."""
    n, rows = [], []
    for part in ids.encode_parts(texts):
        for x in part:
            found = cut_document(x + END, sequence)
            n.append(len(found))
            rows += found
    pa.default_memory_pool().release_unused()
    piece, start, length, crc = zip(*rows, strict=True) if rows else ([],) * 4
    doc = keys.take(pa.array(np.repeat(np.arange(len(n)), np.array(n, int))))
    return pa.RecordBatch.from_arrays([doc, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                                      ["doc_id", "piece", "start", "length", "ids_crc32"])


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None,
           sequence: int = SEQUENCE) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document."""
    path = tokenizer or default_tokenizer()
    ship(docs.sparkSession)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(path)
        for b in batches:
            yield cut_documents(ids, b.column("k"), b.column("t"), sequence)

    return docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t")).mapInArrow(tokenise, PIECES)


def sum_of_squares(lengths: np.ndarray, sequence: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each length, in the order given.

    ``open_bins[g]`` counts open bins of gap g. Moving a bin from gap g to g - s changes the sum of
    squares by 2 (open_bins[g - s] - open_bins[g] + 1), closing one by 1 - 2 open_bins[s]. Ties go to the
    smallest gap. A bin is started only when no open one has room.
    """
    open_bins = np.zeros(sequence + 1, np.int64)
    by_gap: list[list[int]] = [[] for _ in range(sequence + 1)]
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    never = np.iinfo(np.int64).max
    for i, s in enumerate(lengths.tolist()):
        before, after = open_bins[s:], open_bins[:sequence - s + 1]
        change = np.where(before > 0, 2 * (after - before + 1), never)
        if before[0] > 0:
            change[0] = 1 - 2 * before[0]
        best = int(change.argmin())
        if change[best] < never:
            gap = s + best
            at = by_gap[gap].pop()
            open_bins[gap] -= 1
        else:
            gap, at, made = sequence, made, made + 1
        bins[i], offsets[i] = at, sequence - gap
        if gap > s:
            by_gap[gap - s].append(at)
            open_bins[gap - s] += 1
    return bins, offsets


def pack(found: DataFrame, sequence: int = SEQUENCE, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    ship(found.sparkSession)
    n = found.where(F.col("length") < sequence).count()
    groups = max(1, round(n / group_pieces))
    row = F.xxhash64(F.monotonically_increasing_id())  # spreads repeated rows too
    rest = found.where(F.col("length") < sequence).withColumn("grp", F.pmod(row, F.lit(groups)))

    def place(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        bins, g["offset"] = sum_of_squares(g["length"].to_numpy(), sequence)
        g["sequence_id"] = bins * groups + int(key[0])
        return g[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    schema = PIECES + ", sequence_id long, offset long"
    packed = rest.groupBy("grp").applyInPandas(place, schema)
    full = found.where(F.col("length") == sequence).select(
        "*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> DataFrame:
    """Tokenise, cut and pack ``docs``; the pieces are written once, so that a lost executor never re-tokenises."""
    return pack(materialise(pieces(docs, key, text, tokenizer), "packing-pieces"))
