import re
from collections import Counter

from obsframe.llm import quality
from obsframe.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed


def check(out, texts):
    for r in out:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)


def test_given_documents(spark):
    out = QUERIES["op7_quality_rules"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(out) == len(texts)
    check(out, texts)
    # junk carries symbols; labelled good documents of 20 words or more stay
    kept = {r.doc_id: r.kept for r in out}
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    long = {r.doc_id for r in out if r.n_words >= 20}
    assert all(kept[r.doc_id] for r in labels if r.quality == 1 and r.doc_id in long)
    assert not any(kept[r.doc_id] for r in labels if r.quality == 0)


def test_edge_rows(spark):
    words = " ".join(f"w{i}" for i in range(30))
    texts = {1: None, 2: "", 3: " \n\t ", 4: words, 5: words + "\n" + words, 6: "a " * 60_000, 7: "a\n a\nb\n\na\x1fb ",
             8: " ".join("abcdefg") + " " + words, 9: "😀 " * 25, 10: "x y " + words + " w0 w1 w2 w3 w4 w5 w6 w7 " + words}
    rows = [(k, t, None if k % 2 else "en", None if k % 3 else "s", 0, "clash", "clash") for k, t in texts.items()]
    rows += [rows[3]] * 3 + [(None, words, "xx", "s", 0, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = quality.judge(df).collect()
    assert len(out) == len(rows)
    texts[None] = words
    check(out, texts)
    kept = {r.doc_id: r.kept for r in out}
    assert kept[4] and kept[None] and not kept[1] and not kept[5]
    assert quality.judge(df.limit(0)).count() == 0


def test_fences_follow_the_group(spark):
    """What one source finds usual, another finds odd."""
    rows = [(i, " ".join(f"word{j}" + ("&" if j % 5 == 0 and src == "code" else "") for j in range(40)), "en", src, 0, "", "")
            for i, src in enumerate(["code"] * 60 + ["prose"] * 60)]
    rows.append((500, " ".join(f"word{j}" + ("&&" if j % 2 == 0 else "") for j in range(40)), "en", "prose", 0, "", ""))
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(kept[i] for i in range(120)) and not kept[500]
