"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns a DataFrame.

Defined results, stage by stage; all but the last return the columns of documents, extra ones unchanged, whatever their names.
  toxicity: a null or empty text has the labels' base rate and stays; without labels of both values nothing is
    rejected; repeated rows share their fate.
  near duplicates: null and empty texts, and texts without words, all stay; of rows equal in doc_id and text one stays;
    of a group the smallest doc_id, a null one only when all are null (then the row of the smallest key).
  decontamination: a null or empty text shares nothing and stays; an empty benchmark, or items without words, remove
    nothing; repeated rows share their fate.
  personal data: a null text stays null and keeps its n_chars; an empty one stays empty.
  packing: a null or empty text is the end id alone; repeated rows are packed separately.
Very long texts are read whole by every stage. An empty table gives an empty table.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import decontamination, jaccard_join, packing, pii, toxicity

# The stage's shingles and similarity; op9's query has its own.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that the classifier chain rejects."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of similar ones, by word shingles of NEAR_WORDS at NEAR_PERCENT or more."""
    return jaccard_join.keep_one_of_each(docs, n=NEAR_WORDS, percent=NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that share a window with the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    _, runs, _ = decontamination.winnow_hits(docs, benchmark)
    keys = C.keyed(docs).select("doc_id", "rk")
    return C.without_rows(docs, keys, runs.select("doc_id", "rk").distinct())


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars, where present, follows the new text."""
    masked = pii.mask_personal_data(docs)
    if "n_chars" not in masked.columns:
        return masked
    kind = dict(masked.dtypes)["n_chars"]
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]
