"""Joins with vocabularies and dimensions, and set differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A vocabulary beyond this many rows is joined without a broadcast hint; Spark then decides by size.
SMALL = 100_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """The table with a broadcast hint if its size is within bounds."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def translate(df: DataFrame, vocabulary: DataFrame, source: str, word: Column, raw: str, canonical: str, name: str) -> DataFrame:
    """Add ``name``: the common word for a source's word; null for an unknown word."""
    own = vocabulary.where(F.col("source") == source).select(F.col(raw).alias("_raw"), F.col(canonical).alias(name))
    return df.join(small(own), word == F.col("_raw"), "left").drop("_raw")


def country_of(df: DataFrame, country_codes: DataFrame, spelling: Column, *, also: Column | None = None) -> DataFrame:
    """Add ``_spelling`` and ``_code`` of a country spelling; ``also`` is a further condition of the join."""
    seed = small(country_codes.select(F.col("country_raw").alias("_spelling"), F.col("country_code").alias("_code")))
    on = spelling == F.col("_spelling")
    return df.join(seed, on & also if also is not None else on, "left")


def unseen(df: DataFrame, seed: DataFrame, column: str, key: str) -> DataFrame:
    """Distinct values of a column that a seed does not hold."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().join(seed.select(F.col(key).alias(column)), column, "left_anti")


def missing(expected: DataFrame, found: DataFrame, on: str | list[str]) -> DataFrame:
    return expected.join(found, on, "left_anti")


def explained(gaps: DataFrame, known: DataFrame, on: str | list[str]) -> DataFrame:
    return gaps.join(known, on, "left_semi")


def append_new(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The table with those rows whose keys it lacks."""
    return table.unionByName(rows.join(table.select(*keys), keys, "left_anti"))
