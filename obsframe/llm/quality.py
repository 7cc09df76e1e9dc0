"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each document gets text measures; mergeable quantile sketches (``percentile_approx``,
Greenwald-Khanna summaries that Spark merges from its tasks' partial sketches) of five
ratios are taken per language and source and, from the same rows, per language and over
all; the thresholds that follow from them are joined back to the documents.

A ratio's fence is its group's median plus ``SPREADS`` times the distance from the lower
quartile to the median, and at least ``floor`` above the median. The lower half of a
group is used so that even a group half full of junk keeps a sound fence, and the floor
keeps clean documents of very uniform groups. A group of fewer than ``MIN_GROUP``
documents takes its language's fences, and if that is small too, the corpus's. Documents
that fail the base rules do not enter the sketches.

Where most of a group's ratios are 0 or close together the spread is below ``floor``, and the fence is the median plus a
fixed distance; the README has figures. The repeat ratio's fence cannot reject: the base rule fails what lies beyond it.

Defined results: a null text has no words, fails the base rules and is not kept. A null
language or source is a group of its own. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import materialise

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
SPREADS = 6.0
ACCURACY = 10_000
MIN_GROUP = 30
# ratio -> least distance of its fence from the group's median
FLOORS = {"symbol_ratio": 0.03, "dup_line_ratio": 0.4, "repeat_ratio": 0.3, "word_length": 2.5, "echo_ratio": 0.1}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where a lambda inside refers to it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; position i covers i .. i+7."""
    def of_sorted(s: Column) -> Column:
        def same(j: Column) -> Column:
            return F.get(s, j)["h"]

        repeated = F.filter(s, lambda x, j: (F.coalesce(x["h"] == same(j - 1), F.lit(False)))
                            | (F.coalesce(x["h"] == same(j + 1), F.lit(False))))
        at = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
        return F.aggregate(at, start, lambda a, p: F.struct(
            p.alias("last"), (a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total")))["total"]

    pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return let(F.sort_array(pairs), of_sorted)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_echo_words, base_failed``."""
    clean = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(clean, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(clean, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.withColumns({"_words": words, "_lines": lines})
    n = F.size("_words")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)),
                                              lambda i: F.xxhash64(F.slice("_words", i, WINDOW))))
    d = d.withColumn("_windows", windows)
    d = d.withColumns({
        "n_words": n.cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length(clean) - F.length(F.regexp_replace(clean, SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("_lines").cast("long"),
        "n_echo_words": F.size(F.filter("_words", lambda w, i: w == F.get(F.col("_words"), i - 1))).cast("long"),  # equal to the word before
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # most documents repeat no window: sorting positions is left to those that do
        "n_repeat_words": F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), _covered(F.col("_windows")))
                           .otherwise(0).cast("long"),
    }).drop("_words", "_lines", "_windows")
    return d.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def ratios() -> dict[str, Column]:
    some = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {"symbol_ratio": some("n_symbols", "word_chars"), "dup_line_ratio": some("n_dup_lines", "n_lines"),
            "repeat_ratio": some("n_repeat_words", "n_words"), "word_length": some("word_chars", "n_words"),
            "echo_ratio": some("n_echo_words", "n_words")}


def fences(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per language and source: ``high_<ratio>`` for each ratio and ``low_word_length``."""
    base = measured.select(F.col(lang).alias("lang"), F.col(source).alias("source"), "base_failed",
                           *[c.alias(n) for n, c in ratios().items()])
    good = ~F.col("base_failed")
    sketches = [F.percentile_approx(F.when(good, F.col(n)), [0.25, 0.5], ACCURACY).alias(n) for n in FLOORS]
    rolled = (base.rollup("lang", "source").agg(F.grouping_id().alias("level"), F.count_if(good).alias("n"), *sketches))
    rolled = materialise(rolled, "quality-sketches")
    own = rolled.where("level = 0")
    of_lang = rolled.where("level = 1").select(F.col("lang").alias("l_lang"), F.col("n").alias("l_n"), *[F.col(n).alias(f"l_{n}") for n in FLOORS])
    top = rolled.where("level = 3").first()  # one row
    joined = own.join(of_lang, own["lang"].eqNullSafe(of_lang["l_lang"]), "left")
    out = [F.col("lang"), F.col("source")]
    for n, floor in FLOORS.items():
        q = (F.when(F.col("n") >= MIN_GROUP, F.col(n)).when(F.col("l_n") >= MIN_GROUP, F.col(f"l_{n}"))
             .otherwise(F.array(*map(F.lit, top[n])) if top and top[n] else F.lit(None).cast("array<double>")))
        reach = F.greatest(F.lit(floor), SPREADS * (q[1] - q[0]))
        out.append((q[1] + reach).alias(f"high_{n}"))
        if n == "word_length":
            out.append((q[1] - reach).alias(f"low_{n}"))
    return joined.select(*out)


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: key, measures, ratios, ``base_failed`` and ``kept``.

    The measures are written once: the sketches and the filter both read them."""
    m = measure(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source")))
    m = materialise(m.drop("text"), "quality-measures")
    f = fences(m)
    rates = ratios()
    ok = rates["word_length"] >= F.col("low_word_length")
    for n in FLOORS:
        ok = ok & (rates[n] <= F.col(f"high_{n}"))
    f = f.withColumnsRenamed({"lang": "f_lang", "source": "f_source"})
    joined = m.join(f, m["lang"].eqNullSafe(f["f_lang"]) & m["source"].eqNullSafe(f["f_source"]), "left")
    return joined.select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(ok, F.lit(False))).alias("kept"),
                         *[rates[n].alias(n) for n in FLOORS])


def oracle() -> str:
    space = r"[\x20\x09-\x0D]"
    ratio = {"symbol_ratio": "n_symbols / nullif(word_chars, 0)", "dup_line_ratio": "n_dup_lines / nullif(n_lines, 0)",
             "repeat_ratio": "n_repeat_words / nullif(n_words, 0)", "word_length": "word_chars / nullif(n_words, 0)",
             "echo_ratio": "n_echo_words / nullif(n_words, 0)"}
    at = "list_sort(list({c}) FILTER (WHERE NOT base_failed))[greatest(1, ceil({q} * count(*) FILTER (WHERE NOT base_failed)))::BIGINT]"
    picks = ", ".join(f"{at.format(c=c, q=q)} AS {c}_{n}" for c in ratio for n, q in (("lo", 0.25), ("mid", 0.5)))
    good = "count(*) FILTER (WHERE NOT base_failed) AS n"

    def of(c: str, n: str) -> str:
        return f"CASE WHEN o.n >= {MIN_GROUP} THEN o.{c}_{n} WHEN l.n >= {MIN_GROUP} THEN l.{c}_{n} ELSE a.{c}_{n} END"

    fence = ", ".join(f"{of(c, 'mid')} AS {c}_mid, greatest({floor}, {SPREADS} * ({of(c, 'mid')} - {of(c, 'lo')})) AS {c}_reach"
                      for c, floor in FLOORS.items())
    inside = " AND ".join(f"{c} <= {c}_mid + {c}_reach" for c in FLOORS) + " AND word_length >= word_length_mid - word_length_reach"
    return f"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '{space}+'), lambda x: x <> '') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
gram AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ') AS g
         FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w WHERE len(w) >= {WINDOW})),
again AS (SELECT doc_id, i FROM gram QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
step AS (SELECT doc_id, least({WINDOW}, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {WINDOW})) AS s FROM again),
covered AS (SELECT doc_id, sum(s)::BIGINT AS n FROM step GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echo_words, coalesce(covered.n, 0) AS n_repeat_words
      FROM w LEFT JOIN covered USING (doc_id)),
r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             {", ".join(f"coalesce({e}, 0.0)::DOUBLE AS {c}" for c, e in ratio.items())} FROM m),
o AS (SELECT lang, source, {good}, {picks} FROM r GROUP BY lang, source),
l AS (SELECT lang, {good}, {picks} FROM r GROUP BY lang),
a AS (SELECT {picks} FROM r),
f AS (SELECT o.lang, o.source, {fence} FROM o LEFT JOIN l ON o.lang IS NOT DISTINCT FROM l.lang, a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({inside}, false) AS kept
FROM r LEFT JOIN f ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source"""
