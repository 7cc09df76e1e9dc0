import warnings
from collections import Counter, defaultdict

import pytest

from obsframe.llm import mixing
from tests.llm.test_lines import same

CELL = "source string, lang string, topic string, docs long, tokens long"


def test_mixing_matches_sql(spark):
    same(spark, "op9_source_mixing")


def cells_of(spark, tokens):
    grid = [(s, g, t) for s in ("a", "b", None) for g in ("en", "de") for t in ("list", "prose")]
    return spark.createDataFrame([(*k, 1, tokens(i)) for i, k in enumerate(grid)], CELL)


def test_expected_tokens_meet_given_margins(spark):
    cells = cells_of(spark, lambda i: 100 * (1 + i))
    want = {"source": {"a": 0.1, "b": 0.5, None: 0.4}, "lang": {"en": 0.4, "de": 0.6}}
    r = mixing.rake(cells, want, budget=0.5)
    p = r.toPandas()
    total = p["tokens"].sum()
    given = p["probability"] * p["tokens"]
    assert p["probability"].between(0, 1).all() and abs(given.sum() / total - 0.5) < 1e-8
    for dim, shares in want.items():
        for k, share in shares.items():
            assert abs(given[p[dim].isna() if k is None else p[dim] == k].sum() / given.sum() - share) < 1e-8
    for m in mixing.margins(r).collect():
        assert abs(m.expected - m.goal) < 1e-6 * total


def test_full_cells_leave_the_rest_to_others(spark):
    """A source that has less than its target gives all it has; the budget is still reached, the others share the rest as asked."""
    cells = cells_of(spark, lambda i: 10 if i < 4 else 1000)  # source a: 40 tokens of 8040
    r = mixing.rake(cells, {"source": {"a": 0.2, "b": 0.2, None: 0.6}}, budget=0.6)
    m = {(x.dimension, x.value): x for x in mixing.margins(r).collect()}
    assert m["source", "a"].share == pytest.approx(0.2) and m["source", "a"].goal == 40 and m["source", "a"].expected == pytest.approx(40)
    assert m["source", None].expected == pytest.approx(3 * m["source", "b"].expected)
    assert sum(x.expected for x in m.values() if x.dimension == "source") == pytest.approx(0.6 * 8040)


def test_unmet_targets_are_reported(spark):
    """One language per source: shares of both cannot be met together."""
    cells = spark.createDataFrame([("a", "en", "prose", 1, 1000), ("b", "de", "prose", 1, 1000)], CELL)
    with pytest.warns(UserWarning, match="not met together"):
        r = mixing.rake(cells, {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.8, "de": 0.2}}, budget=0.5, most_sweeps=4)
    gaps = {(m.dimension, m.value): m.expected - m.goal for m in mixing.margins(r).collect()}
    assert gaps["source", "a"] == pytest.approx(300) and gaps["lang", "en"] == pytest.approx(0)


def test_sampled_shares(spark):
    """Shares of the tokens really sampled, not only of the expected ones."""
    rows = [(i, "word " * (5 + i % 11), ["en", "de"][i % 3 == 0], ["hot", "hot", "hot", "b", "c"][i % 5]) for i in range(30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = {"source": {"hot": 0.4, "b": 0.3, "c": 0.3}, "lang": {"en": 0.5, "de": 0.5}}
    with warnings.catch_warnings():
        warnings.filterwarnings("error", message="mixing targets")
        out = mixing.sample(docs, targets=want, budget=0.4).collect()
    total, by = sum(r.n_tokens for r in out), defaultdict(int)
    for r in out:
        by[r.source] += r.n_tokens
        by[r.lang] += r.n_tokens
    assert abs(total / sum(5 + i % 11 for i in range(30_000)) - 0.4) < 0.01
    for shares in want.values():
        for k, share in shares.items():
            assert abs(by[k] / total - share) < 0.015, k


def test_mixing_edges(spark):
    schema = "doc_id long, text string, lang string, source string, topic string, probability string"
    rows = [(i, "word " * (1 + i % 7), ["en", None][i % 2], ["hot", "hot", "b", None][i % 4], "x", "y") for i in range(400)]
    rows += [(None, None, None, None, None, None), (900, "", "zz", "zz", None, None), (901, "w " * 50_000, "en", "b", None, None)] + [(902, "1 2 3", "en", "b", "", "")] * 4
    df = spark.createDataFrame(rows, schema)
    out = mixing.calibrate(df).collect()
    assert len(out) == len(rows) and all(0 < r.probability <= 1 for r in out)
    assert {r.probability for r in out if r.doc_id == 900} == {1.0}
    kept = mixing.sample(df)
    assert Counter(kept.collect()) == Counter(mixing.sample(df.repartition(7)).collect())
    assert mixing.sample(df.limit(0)).count() == 0
