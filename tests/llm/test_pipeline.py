"""The pipeline's rows against a brute-force version of its stages (the learned language model is the operator's own)."""

import corpus_pipeline
import pandas as pd
from pyspark.sql import functions as F

from obsframe.llm import langid, lines, mixing
from tests.conftest import SF_SMALL
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_packing import check as check_packing
from tests.llm.test_simhash import brute_components, brute_print


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").toPandas()
    extra = [(10**6 + i, t, "en", s, 0) for i, (t, s) in enumerate([(None, "src1"), ("", None), ("12 34", "src2"), (docs.text[3], "src9"), (docs.text[4] + " more", None)])]
    docs = pd.concat([docs, pd.DataFrame(extra, columns=docs.columns)], ignore_index=True)
    spark.createDataFrame(list(docs.itertuples(index=False, name=None)), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    sf = str(tmp_path)

    model = langid.fit(spark.read.parquet(f"{sf}/documents.parquet").where(~langid.held_out()))
    rows = [r for r in docs.itertuples(index=False, name=None) if langid.predict_text(model, r[1])[0] != "und"]
    groups, least_id = brute_components({r[0]: brute_print(r[1]) for r in rows}), {}
    for r in rows:  # of each group one page a source votes
        least_id[r[3], groups[r[0]]] = min(r[0], least_id.get((r[3], groups[r[0]]), r[0]))
    voters = [(r[0], r[1], r[3]) for r in rows if least_id[r[3], groups[r[0]]] == r[0]]
    texts = brute_lines([(r[0], r[1], r[3]) for r in rows], 0.05, voters)
    groups = brute_components({r[0]: brute_print(t) for r, t in zip(rows, texts)})
    rows = [(r[0], t, r[2], r[3], r[4]) for r, t in zip(rows, texts) if groups[r[0]] == r[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    chance = {r.doc_id: r.probability for r in mixing.calibrate(df).collect()}
    uniform = {r[0]: r[1] for r in df.select("doc_id", mixing.uniform()).collect()}
    kept = {r[0]: r[1] for r in rows if uniform[r[0]] < chance[r[0]]}

    out = corpus_pipeline.run(spark, sf).collect()
    made, least = check_packing(out, kept)
    assert made <= 1.02 * least + 1


def test_stages_keep_columns_and_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, topic string, score double"
    rows = [(1, None, None, None, None, None, None), (2, "", "en", "a", 0, "x", 1.0), (None, "some words", None, "a", 3, None, None),
            (4, "the of and words", "en", "a", 3, "x", 1.0), (4, "the of and words", "en", "a", 3, "x", 1.0), (5, "w " * 20_000, "en", None, 3, "x", 1.0)]
    full = spark.createDataFrame(rows, schema)
    for docs in (full, full.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_SMALL)
            assert docs.columns == full.columns
            assert {r.topic for r in docs.where("doc_id = 4").collect()} <= {"x"}
        out = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
        assert out.columns[0] == "doc_id"
        out.agg(F.count("*")).collect()


def test_copies_of_an_article_keep_its_text(spark):
    article = "\n".join(f"line {j} of the copied article" for j in range(6))
    rows = [(i, "menu home\n" + "\n".join(f"own {i} {j}" for j in range(4)), "en", "a", 0) for i in range(60)]
    rows += [(100 + i, "menu home\n" + article, "en", "a", 0) for i in range(30)]  # a third of the source
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, SF_SMALL).collect()}
    assert {out[100 + i] for i in range(30)} == {article}
    assert not any("menu" in t for t in out.values()) and out[7] == "\n".join(f"own 7 {j}" for j in range(4))


def test_near_copies_of_an_article_keep_its_text(spark):
    """A third of a source are near copies, each with a word of its own; null ids vote too."""
    body = "\n".join(f"line {j} of the copied article with words {j * 7} {j * 11} {j * 13} and some more of them {j * 17}" for j in range(40))
    rows = [(i, "menu home\n" + "\n".join(f"own {i} {j}" for j in range(4)), "en", "a", 0) for i in range(60)]
    rows += [(100 + i, f"menu home\n{body}\ncopy number{i}", "en", "a", 0) for i in range(30)] + [(None, "menu home\nno id", "en", "a", 0), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, SF_SMALL).collect()}
    assert all(out[100 + i] == f"{body}\ncopy number{i}" for i in range(30))
    assert not any("menu" in (t or "") for t in out.values())
    kept = [r.text for r in corpus_pipeline.near_dedup(spark, corpus_pipeline.line_dedup(spark, docs, SF_SMALL), SF_SMALL).where("doc_id >= 100").collect()]
    assert kept == [f"{body}\ncopy number0"]


def test_stage_names():
    assert [n.split()[0] for n, _ in corpus_pipeline.STAGES] == ["language", "line", "SimHash", "mixing", "best-fit"]


def test_voters_of_line_dedup_are_found_without_shuffling_texts(spark, monkeypatch):
    def joined(node):
        """The columns that joins of a plan take in."""
        below = [node.children().apply(i) for i in range(node.children().size())]
        own = {b.output().apply(i).name() for b in below for i in range(b.output().size())} if node.nodeName() == "Join" else set()
        return own.union(*map(joined, below))

    found, write = set(), lines.materialise
    monkeypatch.setattr(lines, "materialise", lambda df, name: (found.update(joined(df._jdf.queryExecution().optimizedPlan())), write(df, name))[1])
    rows = [(i % 50 if i % 9 else None, f"menu\nown {i % 40}\nand {i % 30} more", "en", ["a", "b", None][i % 3], 0) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = corpus_pipeline.line_dedup(spark, docs, SF_SMALL).collect()
    assert len(out) == 90 and not any("menu" in r.text for r in out)
    assert "lines" in found and "text" not in found
