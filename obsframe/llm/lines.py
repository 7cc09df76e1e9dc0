"""Line dedup by site-relative frequency, in DataFrame functions.

Pages are grouped by host. For each host and line, the pages that contain the line are
counted (once per page, blank lines left out) and divided by the host's page total. A line of two
pages or more is boilerplate of that host, and is dropped from its pages, if the lower end of the
Wilson interval of its share (``z`` standard errors) exceeds ``ratio``; every other line stays as it is. That is one
rule for hosts of any size: with 2 pages both must hold the line, of 50 pages 6, of very many any share
above ``ratio``.

Lines are compared by two 64-bit hashes of the text without outer white space. Only
(host, hashes) pairs are shuffled, combined on the map side first, so a line that a third
of all pages carry arrives as one partial count per task. A host has at most
(mean lines per page) / ``ratio`` boilerplate lines, so they fit one array per host, and the
documents' texts meet them in a join on the host which Spark broadcasts if the array
table is small and splits where a host is skewed.

Defined results: a null text stays null with no lines. A null host is a host of its own.
Repeated rows count as pages of their own, unless ``copies_once`` is set: then a host's equal
texts vote once, so that a page is not its host's boilerplate because it has many copies; ``groups`` does so for
groups of near copies. Which pages vote is found on their ids and line hashes; no text is shuffled. A document that loses all lines keeps its row
with an empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.llm.common import materialise

RATIO = 0.05
Z = 1.96


def _above(n: str, total: str, ratio: float, z: float) -> str:
    """SQL (Spark's and DuckDB's): the lower end of the Wilson interval of n / total is above ``ratio``."""
    over = f"({n} - {ratio}e0 * {total})"  # e0: doubles in both
    return f"({n} >= 2 AND {over} > 0 AND {over} * {over} > {z * z * ratio * (1 - ratio):.12f}e0 * {total})"


def _bare(line: Column) -> Column:
    return F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "")


def _hashed(text: Column) -> Column:
    """One struct of two hashes per line; null for a blank line."""
    def of(line: Column) -> Column:
        return F.when(line.rlike(r"[^\x20\x09-\x0D]"), F.struct(F.xxhash64(_bare(line)).alias("h"),
                                                                F.xxhash64(F.lit("line"), _bare(line)).alias("g")))

    return F.transform(F.split(text, "\n"), of)


def hashed_pages(docs: DataFrame, host: Column, text: str = "text", copies_once: bool = False, key: str | None = None) -> DataFrame:
    """``(__boilerplate_host, lines)`` of each page, the hashes of its different lines; with ``copies_once`` also those of its whole
    text, ``t`` and ``u``, and with a key that column."""
    return docs.select(host.alias("__boilerplate_host"), F.array_distinct(F.array_compact(_hashed(F.col(text)))).alias("lines"),
                       *([F.xxhash64(text).alias("t"), F.xxhash64(F.lit("page"), text).alias("u")] if copies_once else []),
                       *([F.col(key).alias("__page")] if key else []))


def boilerplate(docs: DataFrame, host: Column, text: str = "text", ratio: float = RATIO, z: float = Z,
                copies_once: bool = False, groups: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """``(__boilerplate_host, __boilerplate)``: the hashes of each host's boilerplate lines. With ``copies_once``, pages of
    a host with equal texts are one page, in the counts of lines and in the total; with ``groups``, those of one group are."""
    pages = hashed_pages(docs, host, text, copies_once, None if groups is None else key)
    if groups is not None:
        pages = one_of_each_group(pages, groups.withColumnRenamed(key, "__page"), F.col("__boilerplate_host"), "__page").drop("__page")
    if copies_once:
        pages = pages.dropDuplicates(["__boilerplate_host", "t", "u"]).drop("t", "u")  # copies are combined on the map side
    if copies_once or groups is not None:
        pages = materialise(pages, "line-pages")  # read for the totals and for the lines
    totals = pages.groupBy("__boilerplate_host").agg(F.count(F.lit(1)).alias("total"))
    seen = (pages.select("__boilerplate_host", F.explode("lines").alias("line")).select("__boilerplate_host", "line.h", "line.g")
            .groupBy("__boilerplate_host", "h", "g").agg(F.count(F.lit(1)).alias("n")).where("n >= 2"))
    t = totals.withColumnRenamed("__boilerplate_host", "t_host")
    common = (seen.join(t, seen["__boilerplate_host"].eqNullSafe(t["t_host"])).where(_above("n", "total", ratio, z)))
    return common.groupBy("__boilerplate_host").agg(F.collect_list(F.struct("h", "g")).alias("__boilerplate"))


def one_of_each_group(pages: DataFrame, groups: DataFrame, host: Column, key: str = "doc_id") -> DataFrame:
    """The pages that vote where a host's pages of one group count once: the one with the smallest id, and every
    page without an id. ``groups`` gives ``key`` and ``component_id``; its groups may reach across hosts. Only ids and hosts are grouped,
    combined on the map side, and the pages meet them on their ids, so a group of a third of all pages is in no one task. ``pages`` are
    shuffled as they come, so they should hold hashes, not texts; the join is an inner one of distinct voters, because
    a semi-join would be moved below the hashing and shuffle the texts."""
    first = (pages.select(F.col(key).alias("__voter"), host.alias("__voter_host")).where("__voter is not null")
             .join(groups.select(F.col(key).alias("__voter"), "component_id").distinct(), "__voter")
             .groupBy("__voter_host", "component_id").agg(F.min("__voter").alias("__voter")))
    first = materialise(first.select("__voter", "__voter_host").distinct(), "line-voters")
    same = (F.col(key) == F.col("__voter")) & host.eqNullSafe(F.col("__voter_host"))
    voters = pages.where(F.col(key).isNotNull()).join(first, same).select(pages.columns)
    return voters.unionByName(pages.where(F.col(key).isNull()))


def drop_boilerplate(docs: DataFrame, host: Column, text: str = "text", ratio: float = RATIO, z: float = Z,
                     copies_once: bool = False, groups: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``, and ``n_lines`` and ``n_dropped`` added
    (columns of these names are replaced). All pages count or, with ``groups`` (``key`` and ``component_id``), one of each group and host."""
    common = materialise(boilerplate(docs, host, text, ratio, z, copies_once, groups, key), "boilerplate-lines")
    d = docs.withColumn("__line_host", host).join(common, F.col("__line_host").eqNullSafe(F.col("__boilerplate_host")), "left")
    lines = F.split(F.col(text), "\n")
    # hosts without boilerplate, and texts without such a line, pass unread
    marked = F.when(F.col("__boilerplate").isNotNull(), _hashed(F.col(text)))
    d = d.withColumn("__line_marks", marked)
    kept = F.filter(lines, lambda _, i: ~F.coalesce(F.array_contains(F.col("__boilerplate"), F.get(F.col("__line_marks"), i)), F.lit(False)))
    d = d.withColumn("__line_kept", F.when(F.arrays_overlap("__line_marks", "__boilerplate"), kept))
    return (d.withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)))
            .withColumn("n_dropped", F.coalesce(F.col("n_lines") - F.size("__line_kept"), F.lit(0)))
            .withColumn(text, F.when(F.col("__line_kept").isNotNull(), F.array_join("__line_kept", "\n")).otherwise(F.col(text)))
            .drop("__line_host", "__boilerplate_host", "__boilerplate", "__line_marks", "__line_kept"))


def oracle(ratio: float = RATIO, z: float = Z) -> str:
    trim = r"regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"
    return f"""
WITH line AS (SELECT doc_id, source, i, l, {trim} AS bare
              FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS l,
                           generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
total AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
common AS (SELECT b.source, b.bare FROM (SELECT source, bare, count(DISTINCT doc_id) AS n FROM line WHERE bare <> '' GROUP BY ALL) b
           JOIN total t ON b.source IS NOT DISTINCT FROM t.source WHERE {_above('n', 'total', ratio, z)}),
kept AS (SELECT l.doc_id, count(*) AS n_lines, count(c.bare) AS n_dropped,
                coalesce(string_agg(l.l, chr(10) ORDER BY i) FILTER (WHERE c.bare IS NULL), '') AS text
         FROM line l LEFT JOIN common c ON l.source IS NOT DISTINCT FROM c.source AND l.bare = c.bare GROUP BY l.doc_id)
SELECT d.doc_id, d.source, coalesce(n_lines, 0)::INTEGER AS n_lines, coalesce(n_dropped, 0)::INTEGER AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN k.text END AS text
FROM documents d LEFT JOIN kept k USING (doc_id)"""
