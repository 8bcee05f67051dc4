"""Relational reporting tables over JDBC. Connection settings come from the caller."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.clean import quoted


def without_arrays(df: DataFrame, sep: str = ",") -> DataFrame:
    """Array columns as joined text, since JDBC has no array type to write."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns(
        {c: F.array_join(F.transform(quoted(c), lambda x: x.cast("string")), sep) for c in arrays}
    )


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str],
    *,
    connections: int = 16,
    batch_rows: int = 10_000,
) -> None:
    """Overwrite a relational table. The old one is dropped first: `publish_jdbc` keeps it.

    `connections` bounds how many tasks write at once, so that a wide cluster does
    not flood the database. Pass a staged DataFrame where it comes from a long
    plan: a retried task then repeats a read, not the plan.
    """
    (
        without_arrays(df)
        .write.format("jdbc")
        .options(**options)
        .option("url", url)
        .option("dbtable", table)
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
        .mode("overwrite")
        .save()
    )


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    options: Mapping[str, str],
    swap: Callable[[str, str], None],
    **how: int,
) -> int:
    """Replace a relational table in two steps; the number of rows it then has.

    The rows go to ``<table>__next``. Once the database counts as many there as were
    given, `swap(next, table)` puts that table in the old one's place, in whatever way the
    database does it in one transaction. If anything fails before, the old table stays as
    it was. `how` goes to `write_jdbc`. Pass a staged DataFrame: it is read twice.
    """
    waiting = f"{table}__next"
    given = df.count()
    write_jdbc(df, url, waiting, options, **how)
    there = jdbc_count(df.sparkSession, url, waiting, options)
    if there != given:
        raise RuntimeError(f"{waiting} holds {there} rows of {given}; {table} is left as it was")
    swap(waiting, table)
    return given


def jdbc_count(spark: SparkSession, url: str, table: str, options: Mapping[str, str]) -> int:
    """Rows of a relational table, counted by the database."""
    query = f"(SELECT COUNT(*) AS n FROM {table}) counted"
    read = spark.read.format("jdbc").options(**options).option("url", url).option("dbtable", query)
    return int(read.load().first()[0])
