"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Documents fall into cells of source, language and topic. A cell's documents are sampled with one probability,
``min(1, ratio)``. The ratios are raked: each sweep scales the cells so that their expected tokens match the goals of the
sources, then of the languages, then of the topics, with the cells that have reached probability 1 counted as what
they can give. Sweeps go on until the largest gap between a goal and the expected tokens is below
``TOLERANCE`` of the budget. Sampling compares the probability with a fixed uniform number per document
(of the md5 of its id), so a re-run, or a recomputed task, samples the same rows.

Target shares default to each dimension's token shares to the power ``ALPHA``, normalised: under 1,
it evens out dominant values. Own shares can be given per dimension. A value's goal is its share of ``budget`` of all tokens, but no
more than the tokens it has; what it lacks goes to the dimension's other values in proportion to their shares.
Where the goals of several dimensions cannot be met together (one language per source and uneven targets) no sweep
settles it: after ``MOST_SWEEPS`` a warning names the gap. ``margins`` returns the target, the goal and the expected tokens of every
value, so what was not reached can be read in any case.

The cell table has a row per combination that occurs. It is combined on the map side
before its shuffle, so a source holding a third of all rows is a few partial rows per task.

Defined results: nulls in source, language or topic are categories of their own. A null
or blank text has no tokens; its cell's probability applies to it too (a cell without any token
has probability 1). Rows with a repeated id share one uniform number; a null id counts as
the empty string.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsframe.llm.common import cut, materialise

DIMENSIONS = ("source", "lang", "topic")
ALPHA = 0.7
BUDGET = 0.6
TOLERANCE = 1e-9
MOST_SWEEPS = 40
MOST_ROUNDS = 20
HIGHEST = 1e6


def tokens(text: str = "text") -> Column:
    """Number of words."""
    return F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def topic(text: str = "text") -> Column:
    """A coarse topic from the text's form: ``numeric`` (2 digits in 100 characters or more), ``list`` (a line end in
    100 characters or more), ``long`` (5,000 characters or more), else ``prose``."""
    t = F.coalesce(F.col(text), F.lit(""))
    n = F.length(t)
    digits = n - F.length(F.regexp_replace(t, "[0-9]", ""))
    ends = n - F.length(F.regexp_replace(t, "\n", ""))
    return (F.when((n > 0) & (50 * digits >= n), "numeric").when((n > 0) & (100 * ends >= n), "list")
            .when(n >= 5000, "long").otherwise("prose"))


def goals(cells: DataFrame, dim: str, given: dict | None, alpha: float, tokens_wanted: float) -> DataFrame:
    """``(k, share_<dim>, goal_<dim>)`` for each value with tokens: its target share, and its tokens wanted. Rounds hand
    on what values lack; each makes at least one more value give all it has, so they end."""
    sums = cells.groupBy(F.col(dim).alias("k")).agg(F.sum("tokens").cast("double").alias("t")).where("t > 0")
    if given is not None:
        raw = F.lit(None).cast("double")
        for k, v in given.items():
            raw = F.when(F.col("k").eqNullSafe(F.lit(k)), F.lit(float(v))).otherwise(raw)
        sums = sums.withColumn("raw", F.coalesce(raw, F.lit(0.0)))
    else:
        sums = sums.withColumn("raw", F.pow("t", F.lit(alpha)))
    total = sums.agg(F.sum("raw")).first()[0] or 1.0  # one number
    sums = cut(sums.select("k", "t", (F.col("raw") / total).alias("share")))
    scale = tokens_wanted
    for _ in range(MOST_ROUNDS):
        all_given = F.col("share") * F.lit(scale) >= F.col("t")
        s = sums.agg(F.sum(F.when(all_given, F.col("t")).otherwise(0.0)).alias("full"), F.sum(F.when(all_given, 0.0).otherwise(F.col("share"))).alias("open")).first()
        if not s["open"] or (tokens_wanted - s["full"]) / s["open"] <= scale:
            break
        scale = (tokens_wanted - s["full"]) / s["open"]
    return sums.select("k", F.col("share").alias(f"share_{dim}"), F.least("t", F.col("share") * F.lit(scale)).alias(f"goal_{dim}"))


def _sweep(c: DataFrame) -> DataFrame:
    """One pass over the dimensions. Below its goal, a value's open cells (not yet at probability 1) are scaled to give what the full
    ones cannot; above it all its cells are scaled down. Neither step goes past the goal."""
    for dim in DIMENSIONS:
        w, goal = Window.partitionBy(dim), F.col(f"goal_{dim}")
        have = F.sum(F.least(F.lit(1.0), F.col("ratio")) * F.col("tokens")).over(w)
        left = F.sum(F.when(F.col("ratio") < 1, F.col("ratio") * F.col("tokens")).otherwise(0.0)).over(w)
        c = c.withColumns({"_have": have, "_open": left})
        factor = (F.when((goal >= F.col("_have")) & (F.col("_open") > 0), (goal - F.col("_have") + F.col("_open")) / F.col("_open"))
                  .when(F.col("_have") > 0, goal / F.col("_have")).otherwise(F.lit(1.0)))
        c = c.withColumn("ratio", F.least(F.lit(HIGHEST), F.col("ratio") * factor)).drop("_have", "_open")
    return c


def margins(raked: DataFrame) -> DataFrame:
    """``(dimension, value, share, goal, expected)``: target share, tokens wanted and expected tokens of each value."""
    out = None
    for dim in DIMENSIONS:
        m = raked.where("tokens > 0").groupBy(F.lit(dim).alias("dimension"), F.col(dim).cast("string").alias("value")).agg(
            F.max(f"share_{dim}").alias("share"), F.max(f"goal_{dim}").alias("goal"), F.sum(F.col("probability") * F.col("tokens")).alias("expected"))
        out = m if out is None else out.unionByName(m)
    return out


def rake(cells: DataFrame, targets: dict[str, dict] | None = None, alpha: float = ALPHA, budget: float = BUDGET,
         tolerance: float = TOLERANCE, most_sweeps: int = MOST_SWEEPS) -> DataFrame:
    """``cells`` (dimensions, ``docs`` and ``tokens``) that have tokens, with ``probability`` and each dimension's share and goal."""
    wanted = budget * float(cells.agg(F.sum("tokens")).first()[0] or 0)
    c = cells.where("tokens > 0").withColumn("ratio", F.lit(float(budget)))
    for dim in DIMENSIONS:
        goal = goals(cells, dim, (targets or {}).get(dim), alpha, wanted)
        c = c.join(goal, c[dim].eqNullSafe(goal["k"])).drop("k")
    done, gap = 0, float("inf")
    probability = F.least(F.lit(1.0), F.col("ratio")).alias("probability")
    while done < most_sweeps and gap > tolerance:
        for _ in range(min(2, most_sweeps - done)):
            c, done = _sweep(c), done + 1
        c = cut(c)
        gap = (margins(c.select("*", probability)).agg(F.max(F.abs(F.col("expected") - F.col("goal")))).first()[0] or 0.0) / max(wanted, 1e-300)
    if gap > tolerance:
        warnings.warn(f"mixing targets not met together: the largest gap is {gap:.3g} of the budget (see margins)", stacklevel=2)
    return c.select("*", probability).drop("ratio")


def uniform(key: str = "doc_id") -> Column:
    digits = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def calibrate(docs: DataFrame, key: str = "doc_id", text: str = "text", targets: dict[str, dict] | None = None,
              alpha: float = ALPHA, budget: float = BUDGET, topic_of: Column | None = None) -> DataFrame:
    """``docs`` with ``topic``, ``n_tokens`` and ``probability`` (columns of these names are replaced)."""
    marked = docs.withColumns({"topic": topic(text) if topic_of is None else topic_of, "n_tokens": tokens(text)})
    cells = materialise(marked.groupBy(*DIMENSIONS).agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens")), "mixing-cells")
    p = materialise(rake(cells, targets, alpha, budget), "mixing-probabilities")
    p = p.select(*[F.col(d).alias(f"__cell_{d}") for d in DIMENSIONS], F.col("probability").alias("__cell_probability"))
    same = None
    for d in DIMENSIONS:
        on = marked[d].eqNullSafe(p[f"__cell_{d}"])
        same = on if same is None else same & on
    return (marked.join(p, same, "left").withColumn("probability", F.coalesce("__cell_probability", F.lit(1.0)))
            .drop("__cell_probability", *[f"__cell_{d}" for d in DIMENSIONS]))


def sample(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The sampled documents, with ``topic``, ``n_tokens`` and ``probability``."""
    return calibrate(docs, key, **options).where(uniform(key) < F.col("probability"))


def oracle(alpha: float = ALPHA, budget: float = BUDGET, sweeps: int = MOST_SWEEPS, rounds: int = MOST_ROUNDS) -> str:
    t = "coalesce(text, '')"
    q = [f"""WITH marked AS MATERIALIZED (SELECT doc_id, source, lang,
  CASE WHEN length({t}) > 0 AND 50 * (length({t}) - length(regexp_replace({t}, '[0-9]', '', 'g'))) >= length({t}) THEN 'numeric'
       WHEN length({t}) > 0 AND 100 * (length({t}) - length(replace({t}, chr(10), ''))) >= length({t}) THEN 'list'
       WHEN length({t}) >= 5000 THEN 'long' ELSE 'prose' END AS topic,
  len(list_filter(regexp_split_to_array({t}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))::BIGINT AS n_tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM marked GROUP BY ALL)"""]
    q.append(f"budget AS (SELECT {budget}::DOUBLE * sum(tokens) AS b FROM cells)")
    for d in DIMENSIONS:
        q.append(f"""share_{d} AS MATERIALIZED (SELECT {d}, sum(tokens) AS t, pow(sum(tokens), {alpha}) / sum(pow(sum(tokens), {alpha})) OVER () AS share
  FROM cells GROUP BY {d} HAVING sum(tokens) > 0)""")
        q.append(f"{d}_0 AS (SELECT b AS s FROM budget)")
        for i in range(rounds):
            q.append(f"""{d}_{i + 1} AS MATERIALIZED (SELECT greatest(s, coalesce((b - sum(CASE WHEN share * s >= t THEN t ELSE 0 END)) / nullif(sum(CASE WHEN share * s >= t THEN 0 ELSE share END), 0), s)) AS s
  FROM share_{d}, {d}_{i}, budget GROUP BY s, b)""")
        q.append(f"goal_{d} AS MATERIALIZED (SELECT {d}, least(t, share * s) AS goal FROM share_{d}, {d}_{rounds})")
    joins = " ".join(f"JOIN goal_{d} g{i} ON c.{d} IS NOT DISTINCT FROM g{i}.{d}" for i, d in enumerate(DIMENSIONS))
    q.append(f"r0 AS MATERIALIZED (SELECT c.*, {', '.join(f'g{i}.goal AS goal_{d}' for i, d in enumerate(DIMENSIONS))}, {budget}::DOUBLE AS ratio FROM cells c {joins} WHERE tokens > 0)")
    n = 0
    for _ in range(sweeps):
        for d in DIMENSIONS:
            have, left = f"sum(least(1.0, ratio) * tokens) OVER (PARTITION BY {d})", f"sum(CASE WHEN ratio < 1 THEN ratio * tokens ELSE 0.0 END) OVER (PARTITION BY {d})"
            q.append(f"""r{n + 1} AS MATERIALIZED (SELECT * EXCLUDE (have, left_) REPLACE (least({HIGHEST:.0f}::DOUBLE, ratio * CASE WHEN goal_{d} >= have AND left_ > 0 THEN (goal_{d} - have + left_) / left_
  WHEN have > 0 THEN goal_{d} / have ELSE 1.0 END) AS ratio) FROM (SELECT *, {have} AS have, {left} AS left_ FROM r{n}))""")
            n += 1
    q.append(f"p AS (SELECT source, lang, topic, least(1.0, ratio) AS probability FROM r{n})")
    return ",\n".join(q) + """
SELECT m.doc_id, m.source, m.lang, m.topic, m.n_tokens, round(coalesce(p.probability, 1.0), 6) AS probability
FROM marked m LEFT JOIN p ON m.source IS NOT DISTINCT FROM p.source AND m.lang IS NOT DISTINCT FROM p.lang AND m.topic = p.topic
WHERE ('0x' || substr(md5(coalesce(m.doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < coalesce(p.probability, 1.0)"""
