import hashlib
import os
import zlib

import numpy as np
import pytest

from obsframe.llm import packing, token_files
from obsframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, frame string, n_tokens string, k string"


def expected(rows):
    """(doc_id, start, n_tokens, crc32) in ascending order, by the tokenizer on whole texts."""
    tokenizer, out, start = packing._ids(packing.default_tokenizer()).tokenizer, [], 0
    for k, t in rows:
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    out = QUERIES["op12_token_files"](spark, SF_SMALL)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in out.collect()) == expected(rows)


@pytest.mark.parametrize("parts", [1, 7])
def test_edge_texts(spark, tmp_path, parts):
    rows = [(None, "first"), (1, None), (2, ""), (3, " \n"), (4, "a b<|endoftext|>c"), (5, "word " * 30_000), (6, "ÁB İI ß 中文 \x00"), (-9, "low")]
    df = spark.createDataFrame([(k, t, "clash", "clash", "clash") for k, t in rows], SCHEMA).repartition(parts)
    folder = str(tmp_path / "f")
    token_files.write(df, folder)
    out = token_files.read_all(spark, folder).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(((r.key, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in out), key=lambda r: r[1]) == expected(order)


def test_repeated_ids_and_rows(spark, tmp_path):
    df = spark.createDataFrame([(7, "again and again", None, None, None)] * 500 + [(7, "other", None, None, None)] * 3 + [(8, "x", None, None, None)], SCHEMA)
    folder = str(tmp_path / "f")
    token_files.write(df.repartition(5), folder)
    out = sorted(token_files.read_all(spark, folder).collect(), key=lambda r: r.start)
    assert len(out) == 504 and [r.key for r in out] == [7] * 503 + [8]
    at = 0
    for r in out:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "f")
    token_files.write(spark.createDataFrame([], SCHEMA), folder)
    assert token_files.read_all(spark, folder).count() == 0


def test_short_documents_alone_and_checks(spark, tmp_path):
    """One document is read by its index row; files name their dictionary, and a changed byte is found."""
    folder = str(tmp_path / "f")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    token_files.write(docs, folder)
    index = spark.read.parquet(f"{folder}/index")
    one = index.orderBy("length").first()
    got = token_files.read(index.where(f"key = {one['key']}"), folder).collect()
    text = docs.where(f"doc_id = {one['key']}").first()["text"]
    ids = packing._ids(packing.default_tokenizer()).tokenizer.encode(text, add_special_tokens=False).ids
    assert [r.ids for r in got] == [np.array([*ids, 1], "<u4").tobytes()]
    names = [f for f in os.listdir(folder) if f.startswith("dictionary-")]
    with open(f"{folder}/{names[0]}", "rb") as f:
        data = f.read()
    assert names == [f"dictionary-{hashlib.sha256(data).hexdigest()}"] and len(data) <= token_files.DICTIONARY_BYTES
    with open(f"{folder}/{one['file']}", "rb") as f:
        assert f.read(token_files.HEADER) == token_files.MAGIC + b"\x02" + hashlib.sha256(data).digest()
    plain = sum(2 * r.n_tokens for r in index.collect())
    assert sum(r.length for r in index.collect()) < plain
    path = f"{folder}/{one['file']}"
    with open(path, "r+b") as f:
        f.seek(one["offset"] + one["length"] - 5)
        byte = f.read(1)[0]
        f.seek(-1, 1)
        f.write(bytes([255 - byte]))
    with pytest.raises(Exception, match="(?i)zstd|decompress|match"):
        token_files.read(index, folder).collect()
