"""Group totals and distinct rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.functions.clean import exact_sum, quoted
from tallyfold.functions.dates import month_index, month_of_index
from tallyfold.operators.joins import left_join_on
from tallyfold.session import stage

#: A key is hot from this share of the rows on, in a sample of so many.
HOT_SHARE, HOT_SAMPLE = 0.01, 20_000
#: Months that share one bigint.
BLOCK = 60


def group_sum(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(exact_sum(df, value).alias(out))


def group_totals(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """One row per key."""
    return df.groupBy(*keys).agg(*[a.alias(name) for name, a in aggs.items()])


def hot_keys(
    df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE, sampled: int = HOT_SAMPLE
) -> list[tuple]:
    """Keys that hold at least `share` of the rows, as a bounded sample shows them.

    One narrow pass; the driver gets one row per hot key, of which there are at most
    1 / `share`. A key well above the share is never missed, one near it may be. A table
    that fits the sample is small enough for one task and has no hot key.
    """
    some = df.select(*[quoted(k) for k in keys]).orderBy(F.rand(11)).limit(sampled)
    counts = some.groupBy(*some.columns).count().withColumn("all", F.sum("count").over(Window.partitionBy()))
    hot = counts.where((F.col("all") >= sampled) & (F.col("count") >= F.col("all") * share))
    return [tuple(r)[: len(keys)] for r in hot.collect()]


def with_group_totals(
    df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], *, hot: bool | None = None
) -> DataFrame:
    """Every row with its group's totals; `aggs` are plain aggregates.

    Where no key is hot, a window gives them, in one scan and one shuffle. A hot group
    would be sorted by a single task there: then the totals are aggregated, which combines
    before its shuffle, staged, and joined back, where AQE can split the hot key. Unless
    `hot` says which, the keys are measured first, see `hot_keys`.
    """
    if hot is None:
        hot = bool(hot_keys(df, keys))
    if not hot:
        own = Window.partitionBy(*[quoted(k) for k in keys])
        return df.withColumns({name: agg.over(own) for name, agg in aggs.items()})
    totals = stage(group_totals(df, keys, aggs), "group_totals")
    return left_join_on(df, totals, {k: k for k in keys}, list(aggs), null_safe=True)


def global_total(df: DataFrame, value: str, out: str) -> DataFrame:
    """One row with the sum over all rows."""
    return df.agg(exact_sum(df, value).alias(out))


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*[quoted(k) for k in keys]).distinct()


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def row_count(df: DataFrame) -> int:
    return df.count()


def month_block(month: Column) -> Column:
    """Number of the five years that a date lies in."""
    return F.floor(month_index(month) / BLOCK).cast("int")


def month_bit(month: Column) -> Column:
    """A bigint with the date's month as one of the bits of its block."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(month_index(month), F.lit(BLOCK)))


def months_of_blocks(blocks: Column) -> Column:
    """Sorted month starts of an array of (block, bits)."""

    def months(b: Column) -> Column:
        set_ = F.filter(
            F.sequence(F.lit(0), F.lit(BLOCK - 1)),
            lambda i: F.call_function("getbit", b["bits"], i) == 1,
        )
        return F.transform(set_, lambda i: month_of_index(b["block"] * BLOCK + i))

    return F.flatten(F.transform(F.sort_array(blocks), months))


def collect_months(df: DataFrame, keys: Sequence[str], month: str, out: str) -> DataFrame:
    """Sorted set of months per key.

    Months are bits of a bigint for each five years, combined before the shuffle, so a key
    sends a few numbers however many bills and months it has.
    """
    date = quoted(month)
    bits = df.groupBy(*[quoted(k) for k in keys], month_block(date).alias("__block")).agg(
        F.bit_or(month_bit(date)).alias("__bits")
    )
    block = F.when(F.col("__block").isNotNull(), F.struct(F.col("__block").alias("block"), F.col("__bits").alias("bits")))
    return bits.groupBy(*[quoted(k) for k in keys]).agg(months_of_blocks(F.collect_list(block)).alias(out))


def contribution(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Each group's total and its share of the grand total in percent."""
    totals = group_sum(df, by, value, "group_total")
    grand = global_total(totals, "group_total", "grand_total")
    share = F.try_divide(F.col("group_total").cast("double"), F.col("__grand").cast("double"))
    return (
        totals.withColumn("__grand", grand.scalar())
        .withColumn("contribution", share * 100)
        .drop("__grand")
    )
