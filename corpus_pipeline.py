"""From raw documents to packed sequences: five stages, each on all its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next one's docs. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.llm import chunking, packing, partenum, quality, secrets
from tallyfold.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the newest policy rejects."""
    return quality.kept_rows(docs, max(quality.POLICIES))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document of smallest id; of equal rows, one.

    Rows are known by id and a hash of the text, so rows that share an id but not the text
    are told apart; of rows equal in both, the least by all columns stays. Documents without words belong to no group and all stay.
    """
    keys = [F.coalesce("doc_id", F.lit(-(2**63))).alias("owner"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")]
    gone = partenum.superseded(docs).select("owner", "text_key")
    left = docs.select(F.struct("*").alias("row"), *keys).join(gone, ["owner", "text_key"], "left_anti")
    again = F.row_number().over(Window.partitionBy("owner", "text_key").orderBy("row"))
    worded = F.coalesce(F.col("row.text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = left.withColumn("again", again).where((F.col("again") == 1) | ~worded)
    return kept.select([F.col(f"row.`{c}`") for c in docs.columns])


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds."""
    return _counted(chunking.dedup(docs))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every secret replaced by the name of its kind in angle brackets."""
    return _counted(secrets.redacted(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: its document, place, checksum and sequence."""
    return packing.pack(stage(packing.tokenized(docs), "pieces"))


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality rules", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", unrepeated),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: Tokenising and chunk digests have no SQL form; tests/llm holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"stage{k}")
    return docs
