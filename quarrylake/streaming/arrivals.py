"""Landed files as streams: what has arrived since the last run is parsed and merged, then the stream stops.

``merge_arrivals`` merges each batch as a day's load is merged, so guarded columns depend on the order of
days, as they do there.  ``keep_current`` keeps a state for each key instead: the newest row, the newest row
with details and the first sight.  These are maxima and minima, so files may come in any order, twice or
after a restart; the table always is what loading the days in their order would have made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import path_piece
from ..operators.merge import merge_postings
from ..schemas import DETAIL_COLUMNS, POSTINGS, incoming, struct
from ..sources.lake import Lake
from ..sources.parsers import PARSERS

FILES = "path string, modificationTime timestamp, length bigint, content binary"
#: The state lies on disk and each batch commits its changes only.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def file_stream(spark: SparkSession, landing: str, source: str, files_per_batch: int) -> DataFrame:
    stream = (
        spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch).load(f"{landing.rstrip('/')}/{source}")
    )
    path = F.concat(F.lit(f"{source}/"), F.substring_index("path", f"/{source}/", -1))
    return stream.select(
        path.alias("path"), path_piece(path, 3).alias("company_slug"), F.col("modificationTime").alias("landed_at"),
        F.col("content").cast("string").alias("content"),
    )


def merge_arrivals(lake: Lake, landing: str, source: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Merge new files of a source in bounded batches; a batch that runs again after a lost executor changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        rows = PARSERS[source](batch).persist()  # for its keys' buckets and for the merge
        try:
            lake.upsert(f"{source}_postings", POSTINGS[source], rows, lambda target, new: merge_postings(source, target, new))
        finally:
            rows.unpersist()

    files = file_stream(lake.spark, landing, source, files_per_batch)
    return files.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _details(source: str) -> list[str]:
    return [c for c in DETAIL_COLUMNS if c != "detail_fetched_at"] if source == "workable" else []


def newest_states(rows: DataFrame, source: str) -> DataFrame:
    """From incoming rows, each key's state in the table's columns; works on streams.

    Of rows that landed at the same time the one with the larger hash of its payload is the newer.
    """
    order = F.struct("landed_at", F.xxhash64("raw"))
    details = _details(source)
    plain = [c for c in struct(POSTINGS[source]).names if c not in (*details, "id", "first_seen_at", "detail_fetched_at")]
    aggregates = [F.max_by(F.struct(*plain), order).alias("newest"), F.min("first_seen_at").alias("first_seen_at")]
    if details:
        fetched = F.col("last_seen_at").alias("detail_fetched_at")
        aggregates.append(F.max_by(F.struct(*details, fetched), F.when(F.col("has_detail"), order)).alias("detail"))
    states = rows.groupBy("id").agg(*aggregates)
    return states.select("id", "newest.*", "first_seen_at", *(["detail.*"] if details else [])).select(*struct(POSTINGS[source]).names)


def join_states(target: DataFrame, states: DataFrame, source: str) -> DataFrame:
    """The later of two states for each key, by the columns' own clocks; the order of joins does not matter."""
    t, s = target.alias("t"), states.alias("s")
    old, got = (lambda c: F.col(f"t.{c}")), (lambda c: F.col(f"s.{c}"))
    later = lambda clock: old(clock).isNull() | (got(clock) > old(clock))
    details = _details(source)
    out = []
    for c in target.columns:
        if c == "id":
            value = F.coalesce(old(c), got(c))
        elif c == "first_seen_at":
            value = F.least(old(c), got(c))
        elif c in (*details, "detail_fetched_at"):
            value = F.when(got("detail_fetched_at").isNotNull() & later("detail_fetched_at"), got(c)).otherwise(old(c))
        else:
            value = F.when(got("id").isNotNull() & later("last_seen_at"), got(c)).otherwise(old(c))
        out.append(value.alias(c))
    return t.join(s, F.col("t.id") == F.col("s.id"), "full_outer").select(*out)


def keep_current(lake: Lake, landing: str, source: str, checkpoint: str, files_per_batch: int = 1000) -> None:
    """Bring a source's table up to date with all files that have landed.

    A first stream parses new files into a folder of incoming rows; a second one updates the keyed state from
    these and hands the keys that changed, and no others, to the table.  Both go on where they stopped.
    """
    spark, home = lake.spark, f"{checkpoint.rstrip('/')}"

    def parse(batch: DataFrame, number: int) -> None:
        PARSERS[source](batch).write.mode("overwrite").parquet(f"{home}/rows/batch={number:09d}")  # again: the same rows

    def merge(batch: DataFrame, number: int) -> None:
        changed = f"{home}/changed/batch={number:09d}"
        batch.write.mode("overwrite").parquet(changed)  # the state is read once, the keys twice
        states = spark.read.schema(struct(POSTINGS[source])).parquet(changed)
        lake.upsert(f"{source}_postings", POSTINGS[source], states, lambda target, new: join_states(target, new, source))
        lake.delete(changed)

    files = file_stream(spark, landing, source, files_per_batch)
    files.writeStream.foreachBatch(parse).option("checkpointLocation", f"{home}/parsing").trigger(availableNow=True).start().awaitTermination()

    rows = spark.readStream.schema(struct(incoming(source))).option("maxFilesPerTrigger", files_per_batch).parquet(f"{home}/rows/*")
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        states = newest_states(rows, source)
        states.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
