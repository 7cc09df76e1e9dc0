"""Corpus pipeline over ``documents``: each stage is written as Parquet and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.llm import langid, lines, mixing, packing, simhash
from obsframe.llm.common import materialise, table


def _beside(docs: DataFrame, names: list[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``operator`` adds columns ``names``; columns of ``docs`` with such a name are set aside meanwhile."""
    aside = {n: f"__aside_{n}" for n in names if n in docs.columns}
    return operator(docs.withColumnsRenamed(aside)).drop(*names).withColumnsRenamed({v: k for k, v in aside.items()}).select(docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents whose language cannot be determined go; all others keep their columns."""
    return _beside(docs, ["held_out", "lang_pred", "score"],
                   lambda d: langid.identify_languages(d).where(F.col("lang_pred") != langid.UNDETERMINED))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6 with the source as the host: lines common to a source's documents are taken out of the texts.
    Of a source's near copies one votes, so the near-dedup after it still finds what a group of copies holds. Every document stays; ``n_chars`` follows its new text."""
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    groups = simhash.near_duplicates(docs)
    return _beside(docs, ["n_lines", "n_dropped"],
                   lambda d: lines.drop_boilerplate(d, F.col("source"), copies_once=True, groups=groups).withColumn("n_chars", n_chars))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each group of near duplicates, the document with the smallest id stays."""
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents are sampled with probabilities calibrated to source, language and topic shares."""
    return _beside(docs, ["topic", "n_tokens", "probability"], mixing.sample)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: one row per piece with its place in a sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing to target weights", mix),
    ("best-fit packing", pack),
]

#: Language ID, SimHash and packing cannot be expressed in SQL; tests/llm/test_pipeline.py holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
