"""From raw documents to packed token sequences, in four stages.

Each stage takes the documents that the one before kept, and returns documents with the same
columns; the last returns pieces with their places in sequences. ``run`` writes every stage's
result to the shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.session import written
from llm import near, packing, quality, suffixes
from llm.common import keyed, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the policy."""
    return quality.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    rows = keyed(docs, whole=True)
    kept = near.link(rows.drop("row")).where("kept").select("key")
    return rows.join(kept, "key", "left_semi").select("row.*")


def repeats_removed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the bytes that repeat an earlier passage of 100 bytes or more.

    ``n_chars`` is that of the text left. A document of which nothing is left stays, empty.
    """
    rows = keyed(docs, whole=True)
    texts = suffixes.strip(rows.drop("row"), with_text=True).select("key", F.col("text").alias("left"))
    row = F.col("row").withField("text", F.col("left"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.length("left").cast(docs.schema["n_chars"].dataType))
    return rows.select("key", "row").join(texts, "key").select(row.alias("row")).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places."""
    return packing.pack_documents(docs).drop("key")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeats_removed", repeats_removed),
    ("packed", packed),
]

#: SQL can't express the suffix stage and the packing; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
