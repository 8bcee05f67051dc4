"""Dimension look-ups and deterministic deduplication.

No look-up forces a broadcast on data that can grow: Catalyst broadcasts a side
whose size it knows to be small, AQE does so for one that turns out small, and
AQE splits hot keys of the left side otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyfold.functions.clean import quoted
from tallyfold.sources.inline import inline_dim


def left_lookup(df: DataFrame, dim: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Left join on equally named keys; `dim` has to be unique on them."""
    return df.join(dim, [keys] if isinstance(keys, str) else list(keys), "left")


def lookup_in_place(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`left_lookup` for two sides that lie alike by some of the keys, such as a customer's code.

    A join would shuffle both by all keys. Here each row of `dim` goes ahead of the rows of its
    key in one sort, where they are, and they take its values from there.
    """
    by = [quoted(k) for k in keys]

    def packed(side: DataFrame, name: str) -> DataFrame:
        # One value, so that it takes no room in the rows of the other side.
        rest = [quoted(c) for c in side.columns if c not in keys]
        return side.select(*by, F.struct(F.lit(True).alias("__one"), *rest).alias(name))

    known = packed(dim.dropna(subset=list(keys)), "__found")
    both = packed(df, "__row").unionByName(known, allowMissingColumns=True)
    ahead = Window.partitionBy(*by).orderBy(F.col("__row").isNotNull())
    value = F.first("__found", ignorenulls=True).over(ahead.rowsBetween(Window.unboundedPreceding, 0))
    full = both.withColumn("__found", value).where(F.col("__row").isNotNull())
    given = [quoted(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    taken = [F.col("__found").getField(c).alias(c) for c in dim.columns if c not in keys]
    return full.select(*given, *taken)


def inline_lookup(df: DataFrame, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Left join with a literal table on its first column, broadcast as it cannot grow."""
    return df.join(F.broadcast(inline_dim(df.sparkSession, rows, names)), [names[0]], "left")


def left_join_on(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Sequence[str],
    *,
    null_safe: bool = False,
) -> DataFrame:
    """Left join on differently named keys (left -> right), adding the columns `take`.

    With `null_safe` a null key matches a null key.
    """
    names = {key: f"__r{i}" for i, key in enumerate(dict.fromkeys(on.values()))}
    slim = right.select(
        *[quoted(old).alias(new) for old, new in names.items()], *[quoted(c) for c in take]
    )
    match = None
    for a, b in on.items():
        l, r = quoted(a), F.col(names[b])
        test = l.eqNullSafe(r) if null_safe else l == r
        match = test if match is None else match & test
    return left.join(slim, match, "left").drop(*names.values())


def unique_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first by `order`, ties settled by all other columns.

    Spark keeps only each task's first row per key before the shuffle, so a hot
    key costs one row per task.
    """
    rest = [quoted(c).asc_nulls_first() for c in df.columns if c not in keys]
    by_rank = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order, *rest)
    return (
        df.withColumn("__rank", F.row_number().over(by_rank))
        .filter("__rank = 1")
        .drop("__rank")
    )


def least_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the one `unique_by` gives without an order, as an aggregate.

    The other columns are one value to it: where nobody reads them they are neither shuffled
    nor sorted, and rows that lie by some of the keys already stay there.
    """
    rest = [quoted(c) for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    least = df.groupBy(*[quoted(k) for k in keys]).agg(F.min(F.struct(*rest)).alias("__rest"))
    return least.select(
        *[quoted(c) if c in keys else F.col("__rest").getField(c).alias(c) for c in df.columns]
    )


def lookup_one(
    df: DataFrame, many: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()
) -> DataFrame:
    """Left join with a side of many rows per key, reduced to one row per key first."""
    return left_lookup(df, unique_by(many, keys, order), keys)


def with_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Attach the single value of a one-row, one-column DataFrame to every row."""
    return df.withColumn(name, one_row.scalar())


def period_join(
    anchors: DataFrame, bills: DataFrame, keys: Sequence[str], date: str, first: str, last: str
) -> DataFrame:
    """Inner join of anchors with the bills of the same key dated in [first, last].

    Each anchor meets bills only in the months its window touches, as an equi-join on
    key and month; the exact dates are tested within them. Sums over windows need no
    pairs: `window_sums` gives them, and `period_measures` those of the fiscal calendar.
    """
    months = F.sequence(
        F.trunc(quoted(first), "month"), F.trunc(quoted(last), "month"), F.expr("interval 1 month")
    )
    windows = anchors.filter(quoted(first) <= quoted(last)).withColumn("__month", F.explode(months))
    dated = bills.withColumn("__month", F.trunc(quoted(date), "month"))
    joined = windows.alias("a").join(dated.alias("b"), [*keys, "__month"], "inner")
    return joined.filter(
        F.col(f"b.`{date}`").between(F.col(f"a.`{first}`"), F.col(f"a.`{last}`"))
    ).drop("__month")
