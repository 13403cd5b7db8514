"""Exact distinct counts that add up: dense ids, bitmaps of them, and unions of bitmaps.

A count of distinct values cannot be added over days or groups, but their sets can.  A dictionary gives
each value a dense id once; a day's values are then bitmaps of ``bitmap_construct_agg`` (32,768 ids in 4 KB), by
the groups that are asked for, and any span of days or coarser grouping is a union of those.  Days that are
kept as bitmaps need not be read again.  Only bitmaps are shuffled, combined before.

Nulls are no values.  Ids start at 0 and have no gaps, so bitmaps stay as full as they can be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets within which new values are ranked, so that no task ranks all of them.
BUCKETS = 256


def dictionary(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(value, id) of all values, those ``known`` with their ids and new ones with the next.

    New values are ranked within hash buckets; the buckets' counts give each its first id.  The same
    values get the same ids each time.
    """
    new = values.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    first = F.lit(0).cast("long")
    if known is not None:
        new = new.join(known, "value", "left_anti")
        first = F.lit(known.agg(F.coalesce(F.max("id") + 1, F.lit(0).cast("long")).alias("n")).first()["n"])
    new = new.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(BUCKETS)))
    counts = new.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # BUCKETS rows
    offsets = F.broadcast(counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("value")) - 1
    fresh = new.withColumn("rank", rank).join(offsets, "bucket").select("value", (first + F.col("offset") + F.col("rank")).cast("long").alias("id"))
    return fresh if known is None else known.select("value", "id").unionByName(fresh)


def bitmaps(rows: DataFrame, column: str, ids: DataFrame, *groups: str) -> DataFrame:
    """(groups, part, bitmap): the sets of a column's values by group, in parts of 32,768 ids."""
    coded = rows.where(F.col(column).isNotNull()).join(ids.select(F.col("value").alias(column), F.col("id").alias("_id")), column)
    number = F.bitmap_bucket_number(F.col("_id") + 1)  # its numbers start at 1
    return coded.groupBy(*groups, number.alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_id") + 1)).alias("bitmap"))


def united(sets: DataFrame, *groups: str) -> DataFrame:
    """The same sets by fewer groups."""
    return sets.groupBy(*groups, "part").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def sizes(sets: DataFrame, *groups: str, name: str = "distinct") -> DataFrame:
    """The number of values of each group; a group without a value has no row."""
    return united(sets, *groups).groupBy(*groups).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
