"""Proportional stratified interleaving: shards of equal row counts that match the mixture.

Rows of each source are put in a seeded order and ranked. A row's fractional rank,
(rank - 1/2) / rows of its source, spreads every source evenly over the unit interval. Rows
sorted by it are cut into runs whose lengths differ by one at most, so each run holds every
source in proportion, up to a row or two.

Ranks never need a source, or the whole table, in one task: a first count per range of the
order gives what lies before each range, and rows are only sorted within ranges. The number
of ranges follows the row count.

Defined cases: null sources are a source of their own; a null text has no bytes; rows that
repeat the same id and text are interchangeable and each get a place; an empty table gives
an empty result; a very long text is a large size like any other. Only the named columns are
read, so extra names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.session import stage

SHARDS = 24
SEED = 20240229
#: Rows a range holds on average; one task sorts a range.
RANGE_ROWS = 20_000


def _before(counts: DataFrame, at: str, within: list[str]) -> DataFrame:
    """Adds the rows in earlier ranges and the total, per group of ``within``."""
    order = Window.partitionBy(*within).orderBy(at) if within else Window.orderBy(at)
    return counts.withColumn(
        "before", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    )


def interleave(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per input row: id, size, checksum, ``position``, ``shard`` and ``slot``.

    Runs a count and writes the ranked rows (no texts) to the shared folder.
    """
    n = docs.count()
    ranges = 1 << max(0, (n // RANGE_ROWS).bit_length())
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(whole) + 8).cast("long").alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), source)).alias("stratum"),
    )
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "size", "text_crc32"))
    rows = rows.withColumn("part", F.shiftright("key", 65 - ranges.bit_length()) if ranges > 1 else F.lit(0))
    counts = rows.groupBy("stratum", "part").agg(F.count("*").alias("n"))
    totals = counts.groupBy("stratum").agg(F.sum("n").alias("n_source"))
    placed = _before(counts, "part", ["stratum"]).drop("n").join(totals, "stratum")
    seeded = Window.partitionBy("stratum", "part").orderBy("key", "doc_id", "size", "text_crc32")
    ranked = (
        rows.join(placed, ["stratum", "part"])
        .withColumn("rank", F.col("before") + F.row_number().over(seeded))
        .withColumn("fraction", (F.col("rank") - 0.5) / F.col("n_source"))
        .withColumn("span", F.floor(F.col("fraction") * ranges))
        .select("doc_id", "size", "text_crc32", "stratum", "key", "rank", "fraction", "span")
    )
    ranked = stage(ranked, "ranked")
    spans = _before(ranked.groupBy("span").agg(F.count("*").alias("n")), "span", []).drop("n")
    mixed = Window.partitionBy("span").orderBy("fraction", "stratum", "rank")
    total = max(n, 1)
    return (
        ranked.join(spans, "span")
        .withColumn("position", F.col("before") + F.row_number().over(mixed) - 1)
        .withColumn("shard", F.expr(f"position * {shards} div {total}").cast("int"))
        .withColumn("slot", F.expr(f"position - (shard * {total}L + {shards - 1}) div {shards}"))
        .select("doc_id", "size", "text_crc32", "stratum", "position", "shard", "slot")
    )


def op2_stratified_shards(spark, sf: str) -> DataFrame:
    placed = interleave(spark.read.parquet(f"{sf}/documents.parquet"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
