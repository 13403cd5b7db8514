"""Counts, null profiles, pivots and top lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row: the count of rows and of nulls in every column, in one pass."""
    columns = list(columns or df.columns)
    return df.agg(F.count(F.lit(1)).alias("rows_total"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def fill_rates(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """column_name, fill_percent (one decimal); no rows for an empty table."""
    columns = [c for c in df.columns if c not in set(skip)]
    wide = null_profile(df, columns).where("rows_total > 0")
    long = wide.unpivot(["rows_total"], columns, "column_name", "nulls")
    return long.select("column_name", F.round((F.col("rows_total") - F.col("nulls")) / F.col("rows_total") * 100, 1).alias("fill_percent"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def counts(df: DataFrame, *keys: str | Column, name: str = "postings") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows; end ``order`` with a name, so that ties fall the same way each time."""
    return df.orderBy(*order).limit(n)


def pivot_share(df: DataFrame, row: str, column: str, values: list[str], count: str) -> DataFrame:
    """Counts by row and fixed columns (0 where there is none) and each column's share of the row in percent."""
    wide = df.groupBy(row).pivot(column, values).agg(F.sum(count)).fillna(0, values)
    total = sum((F.col(v) for v in values), F.lit(0))
    return wide.select(row, *values, *[F.round(F.try_divide(F.col(v) * 100.0, total), 1).alias(f"{v}_share") for v in values])


def open_on_last_day(df: DataFrame, by: str, seen: str, name: str = "is_open") -> DataFrame:
    """Add whether a row was seen on the last day on which its group was seen at all.

    The last day of each group is a small table (one row for each group), so rows are not shuffled
    and a group that holds most rows is no one task's work.
    """
    last = df.groupBy(by).agg(F.max(F.to_date(seen)).alias("_last"))
    return df.join(last, by).withColumn(name, F.to_date(seen) == F.col("_last")).drop("_last")
