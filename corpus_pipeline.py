"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; `run` writes every stage's
result to the shared folder and reads it again, so a lost executor repeats one stage at
most. All stages but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm.common import documents
from rivulet.llm.decontaminate import drop_contaminated
from rivulet.llm.line_dedup import drop_shared_lines
from rivulet.llm.mixing import mix
from rivulet.llm.near_dedup import keep_one, text_groups
from rivulet.llm.quality import score_documents
from rivulet.util import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    scored = score_documents(docs, documents(spark, sf_dir, "labels"))
    return scored.where(F.col("kept")).select(docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten sources and ten distinct texts or more share;
    near copies, as the next stage finds them, count as one text and stay whole for it."""
    groups = text_groups(docs, shingle=5, percent=80)
    stripped = drop_shared_lines(docs, "source", 10, by_text=True, groups=groups)
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
        stripped = stripped.withColumn("n_chars", F.coalesce(size, F.col("n_chars")))
    return stripped.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with a similarity of 0.8 or more on five-word shingles."""
    return keep_one(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return drop_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source weights; a document taken twice is there twice (`copy` counts)."""
    return mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
]

# No SQL: hashed n-grams, MinHash, SimHash and pivotal draws are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over all documents."""
    docs = documents(spark, sf_dir)
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
