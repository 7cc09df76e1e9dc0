"""Binary files of token ids, each document compressed by itself with one shared, trained dictionary.

Format. A folder holds ``dictionary-<sha256>`` (zstandard), data files, and two tables:

* data file ``part-<shard>-<unique>.ids``: magic ``OFIDS001``, one byte for the width of an id (2 or 4), the 32 bytes of
  the dictionary's SHA-256, then one zstandard frame per document (its ids, little-endian, with the end id);
* ``index``: per document, in order, its id, shard, file, byte offset and length, the ids before it in its shard and its
  number of ids, so that one short document is one ranged read and one small frame;
* ``shards``: per shard, the ids before it.

Steps. The dictionary is trained on serialised id arrays of at most ``SAMPLE`` documents (those whose hashed ids are least;
of each, one piece of at most ``PIECE`` bytes at a hashed place), which bounds what reaches the driver by ``2 * SAMPLE * PIECE``
bytes; it affects sizes only, never ids. One map-only pass tokenises and compresses whole texts; the frames are stored.
A range shuffle by document id deals the frames, not the texts, to shards, which are written in order. Starts are sums within a shard
plus a running sum over the shards, one row each. Reading deals index rows in contiguous ranges of about ``READ_BLOCK`` bytes, by
sizes that the index knows, and coalesces neighbouring ranges; the dictionary's hash, the frame's own checksum and the number of
ids are verified.

Files are written through ``pyarrow.fs`` to a folder that all executors share. Names are unique per attempt, and only the
index of the attempt that succeeded names a file, so a task that runs again leaves at most an unnamed file behind.

Defined results: a null or empty text is the end id alone. Null ids come first. Rows that share an id are ordered by the hash of
their frame; equal rows are one document each. Too few ids to train on: the samples themselves are the dictionary. Extra
columns are ignored; an empty table has an empty index.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsframe.llm.common import materialise, ship
from obsframe.llm.packing import _ids, default_tokenizer
from obsframe.llm.warc import file_system, spans
from obsframe.session import scratch_path

END_ID = 1
SAMPLE = 1000
PIECE = 8 << 10
DICTIONARY_BYTES = 32 << 10
LEVEL = 3
READ_BLOCK = 16 << 20
MAGIC = b"OFIDS001"
HEADER = len(MAGIC) + 1 + 32


def new_folder(spark: SparkSession) -> str:
    """A new folder in the shared scratch space."""
    return scratch_path(spark, f"token-files-{uuid.uuid4().hex}")


def id_width(tokenizer: str) -> int:
    return 2 if _ids(tokenizer).tokenizer.get_vocab_size() <= 1 << 16 else 4


def serialised(tokenizer: str, texts: pa.Array, width: int, end_id: int = END_ID) -> list[bytes]:
    """The ids of each whole text and the end id, ``width`` bytes each."""
    end = end_id.to_bytes(4, "little")
    return [np.frombuffer(ids + end, "<u4").astype(f"<u{width}").tobytes() for ids in _ids(tokenizer).encode_all(texts)]


def train(docs: DataFrame, key: str, text: str, tokenizer: str, sample: int = SAMPLE) -> bytes:
    """The dictionary's bytes."""
    ship(docs.sparkSession)
    least = F.xxhash64(key).alias("h")
    last = docs.select(least).orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    if last is None:
        return b"\x00"
    width = id_width(tokenizer)
    chosen = docs.where(F.xxhash64(key) <= last).select(F.col(text).alias("t")).limit(2 * sample)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for data in serialised(tokenizer, b.column("t"), width):
                at = zlib.crc32(data) % max(1, len(data) - PIECE) // 4 * 4
                out.append(data[at:at + PIECE])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["piece"])

    samples = sorted(bytes(r["piece"]) for r in chosen.mapInArrow(pieces, "piece binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too little to train on
        return b"".join(samples)[-DICTIONARY_BYTES:]


def write(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", tokenizer: str | None = None) -> None:
    """Write the files and tables of ``docs`` below ``folder``."""
    spark, path = ship(docs.sparkSession), tokenizer or default_tokenizer()
    dictionary, width = train(docs, key, text, path), id_width(path)
    digest = hashlib.sha256(dictionary).digest()
    store, base = file_system(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/dictionary-{digest.hex()}", compression=None) as f:
        f.write(dictionary)
    kind = docs.schema[key].dataType.simpleString()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary)
        shared.precompute_compress(level=LEVEL)  # else every document would load it again
        press = zstandard.ZstdCompressor(dict_data=shared, write_checksum=True)
        for b in batches:
            ids = serialised(path, b.column("t"), width)
            frames = pa.array([press.compress(x) for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("k"), pa.array([len(x) // width for x in ids], pa.int64()), frames], ["k", "n_tokens", "frame"])

    frames = materialise(docs.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(compress, f"k {kind}, n_tokens long, frame binary"), "token-frames")
    place = ("k", "h", "row")  # the row's number only splits rows that are equal
    dealt = (frames.withColumns({"h": F.xxhash64("frame"), "row": F.monotonically_increasing_id()})
             .repartitionByRange(*place).sortWithinPartitions(*place).select("k", "n_tokens", "frame"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, name, at, start = TaskContext.get().partitionId(), None, "", HEADER, 0
        store, base = file_system(folder)
        try:
            for b in batches:
                if out is None:
                    name = f"part-{shard:05d}-{uuid.uuid4().hex}.ids"
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    out.write(MAGIC + bytes([width]) + digest)
                found = b.column("frame").to_pylist()
                lengths = np.array([len(x) for x in found], np.int64)
                counts = b.column("n_tokens").to_numpy()
                out.write(b"".join(found))
                ends, sums = at + np.cumsum(lengths), start + np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [b.column("k"), pa.array([shard] * len(found), pa.int32()), pa.array([name] * len(found)), pa.array(ends - lengths), pa.array(lengths),
                     pa.array(sums - counts), pa.array(counts)], ["key", "shard", "file", "offset", "length", "start", "n_tokens"])
                at, start = int(ends[-1]) if len(ends) else at, int(sums[-1]) if len(sums) else start
        finally:
            if out is not None:
                out.close()

    index = dealt.mapInArrow(put, f"key {kind}, shard int, file string, offset long, length long, start long, n_tokens long")
    index.write.parquet(f"{folder}/index")
    totals = spark.read.parquet(f"{folder}/index").groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"))
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row a shard
    totals.select("shard", before.alias("first")).write.parquet(f"{folder}/shards")


def read(index: DataFrame, folder: str) -> DataFrame:
    """``key, start, n_tokens`` and ``ids`` (little-endian unsigned 32-bit) of the documents that the index rows name."""
    spark = ship(index.sparkSession)
    parts = max(1, -(-(index.agg(F.sum("length")).first()[0] or 0) // READ_BLOCK))
    index = index.join(spark.read.parquet(f"{folder}/shards"), "shard").withColumn("start", F.col("start") + F.col("first"))
    dealt = index.select("key", "shard", "file", "offset", "length", "start", "n_tokens").repartitionByRange(parts, "shard", "offset").sortWithinPartitions("shard", "offset")
    kind = index.schema["key"].dataType.simpleString()

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        known: dict[bytes, zstandard.ZstdDecompressor] = {}

        def press(digest: bytes) -> zstandard.ZstdDecompressor:
            if digest not in known:
                with store.open_input_file(f"{base}/dictionary-{digest.hex()}") as f:
                    data = f.read()
                if hashlib.sha256(data).digest() != digest:
                    raise ValueError("dictionary does not match its hash")
                known[digest] = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data))
            return known[digest]

        for b in batches:
            files = np.array(b.column("file").to_pylist(), object)
            cuts = [0, *(np.flatnonzero(files[1:] != files[:-1]) + 1), len(files)] if len(files) else [0]
            for low, high in zip(cuts, cuts[1:]):
                part = b.slice(low, high - low)
                offsets, lengths, counts = (part.column(c).to_pylist() for c in ("offset", "length", "n_tokens"))
                with store.open_input_file(f"{base}/{files[low]}") as f:
                    head = f.read_at(HEADER, 0)
                    if head[:len(MAGIC)] != MAGIC:
                        raise ValueError("not a file of token ids")
                    width, frames = head[len(MAGIC)], press(head[len(MAGIC) + 1:])
                    for lo, hi, start, end in spans(offsets, lengths):
                        data, ids = f.read_at(end - start, start), []
                        for o, n, count in zip(offsets[lo:hi], lengths[lo:hi], counts[lo:hi], strict=True):
                            found = np.frombuffer(frames.decompress(data[o - start:o - start + n]), f"<u{width}")
                            if len(found) != count:
                                raise ValueError("a document's ids do not match the index")
                            ids.append(found.astype("<u4").tobytes())
                        some = part.slice(lo, hi - lo)
                        yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("key", "start", "n_tokens")), pa.array(ids, pa.binary())], ["key", "start", "n_tokens", "ids"])

    return dealt.mapInArrow(fetch, f"key {kind}, start long, n_tokens long, ids binary")


def read_all(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark.read.parquet(f"{folder}/index"), folder)
