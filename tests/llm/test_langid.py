from zlib import crc32

from obsframe.llm import langid
from obsframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL

WORDS = {"en": "the of and thing tion with her ing", "de": "der die und schl keit ung ver einer",
         "fr": "les que dans eaux tion pour une avec", "es": "los que ción para una ado ando ñar"}


def labelled():
    rows = []
    for i in range(400):
        lang = list(WORDS)[i % 4]
        w = WORDS[lang].split()
        rows.append((i, " ".join(w[(i * 7 + j * (1 + i % 5)) % 8] for j in range(5 + i % 30)), lang, "s", "x", 2.0))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, lang_pred string, score double"


def test_held_out_accuracy(spark):
    out = QUERIES["op10_language_id"](spark, SF_SMALL).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(out) == len(truth)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_labels_of_held_out_rows_are_never_read(spark):
    rows = labelled()
    swapped = [(*r[:2], "zz" if crc32(str(r[0]).encode()) % 5 == 0 else r[2], *r[3:]) for r in rows]
    a, b = ({(r.doc_id, r.lang_pred, r.score) for r in langid.identify_languages(spark.createDataFrame(x, SCHEMA)).collect()} for x in (rows, swapped))
    assert a == b


def test_edge_rows(spark):
    rows = labelled() + [(1000, None, "en", None, None, None), (1001, "", None, "s", "x", 1.0), (1002, "12 34 &&&", "de", "s", "x", 1.0),
                         (1003, "der die und " * 40_000, None, None, None, None), (None, "les que dans", "fr", "s", "x", 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = langid.identify_languages(df)
    assert out.columns == [*df.columns, "held_out"]
    got = {r.doc_id: r for r in out.collect()}
    assert [got[i].lang_pred for i in (1000, 1001, 1002, 1003, None)] == ["und", "und", "und", "de", "fr"]
    assert got[1000].score == 0 and got[None].held_out is True


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([(1, "the of", None, "s", "x", 1.0)], SCHEMA)
    assert [r.lang_pred for r in langid.identify_languages(none).collect()] == ["und"]
    assert langid.identify_languages(none.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "the of", "en", "s", "x", 1.0), (2, "le la", None, "s", "x", 1.0)], SCHEMA)
    assert {r.lang_pred for r in langid.identify_languages(one).collect()} == {"en"}
