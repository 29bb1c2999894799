"""A training corpus from raw documents, stage by stage.

A stage takes what its predecessor kept and returns documents with all their columns; the
last returns packed sequences. Each result is written as Parquet and read again.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickermood.llm import toxicity
from tickermood.llm.common import saved, unused
from tickermood.llm.line_dedup import dedup_lines
from tickermood.llm.packing import pack_documents
from tickermood.llm.secret_scan import mask_secrets
from tickermood.llm.simhash import without_duplicates


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = unused(docs.columns, "toxicity_score")
    scored = toxicity.scored(docs, toxicity.fit(docs, labels), score=score)
    return scored.where(F.col(score) < toxicity.REJECT_AT).drop(score)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir) -> DataFrame:
    """Documents without the lines that ten or more of them share; ``n_chars`` follows the text."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir) -> DataFrame:
    """One document of each group whose fingerprints are linked."""
    return without_duplicates(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir) -> DataFrame:
    """Documents with every secret replaced by a mask; ``n_chars`` follows the text."""
    return mask_secrets(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir) -> DataFrame:
    """Pieces of the packed sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", hide_secrets),
    ("packing", pack),
]

# Model, sketches and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
