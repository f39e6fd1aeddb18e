"""From raw documents to sharded, mixed training data, stage by stage.

Each stage is written and read again as the next one's documents, so a failure costs
the stage at hand, and every stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm import decontamination, language, mixing, sharding, weighted_minhash
from rowgate.llm.frames import read, shipped, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the classifier is fitted on ``docs``.

    Without any labelled text nothing can be recognised and every document is kept.
    """
    model = language.fit(docs)
    if not model.languages:
        return docs
    judged = language.predicted(docs.withColumn("_row", F.struct("*")), model)
    return judged.filter(~F.col("rejected")).select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, the first of the table.

    Rows are numbered and judged by their own text, whatever their doc_id: rows that
    share one stay if their texts differ. Texts without words stay once each.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    numbered = docs.select(F.monotonically_increasing_id().alias("doc_id"), row.alias("row"))
    # Written, so that every row keeps its number when a task is run again.
    numbered = written(numbered, "numbered")
    classes = weighted_minhash.near_duplicates(numbered.select("doc_id", F.col("row.text").alias("text")))
    kept = classes.filter("doc_id = class_id").select("doc_id")
    # What is kept grows with the corpus, so it is joined by shuffle at every size.
    return numbered.join(kept.hint("merge"), "doc_id", "left_semi").select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; every row is judged by its own text."""
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated towards tempered source weights and shuffled."""
    rates = written(mixing.tempered_rates(docs), "rates")
    return mixing.mixed(docs, rates).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard; copies of a document share one."""
    return sharding.assign(docs, "doc_id")


STAGES = [
    ("language", shipped(identify_language)),
    ("near_duplicates", shipped(drop_near_duplicates)),
    ("decontamination", shipped(decontaminate)),
    ("mixing", shipped(mix_sources)),
    ("sharding", shipped(shard)),
]

# A learned classifier and the edit distance are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
