"""Exact deduplication as a stateful stream of fingerprints.

The texts' fingerprints arrive as a stream.  A keyed state on disk (RocksDB, never expired)
retains for each digest the stable identifier of the row that stays, a locator of its content
and the count of rows.  The state's aggregate is combined before the shuffle, so a digest that
holds a third of all rows costs each task one row; the few digests that hold most rows are joined
back by a broadcast of at most 1000 rows.  Every hit is then checked on full bytes: content is
fetched by locator (a filter of bits keeps most other texts out of the shuffle) and texts of one
digest are grouped by all their bytes.  Digests under which different texts meet are grouped again
by text.

With a ``state`` folder of the caller's the state outlives the call: each call is a delivery, whose
rows are deduplicated against all earlier ones.  A delivery has a name, the caller's or one that follows
from its files; one that has been delivered before, whole or until its driver died, is not counted again, and its
results are those of the state as it is now.  Earlier deliveries' files are read again where a
hit points to them, so they must still lie where they were.

Rows: a null text counts as empty.  Of equal texts the smallest key stays, a null key only if
there is no other; of rows with the same key and text, the first by locator.  An empty table
gives an empty result.  Other columns are never read, so their names cannot clash.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hashed, may_hold, scratch, settings, store

#: The state is kept by RocksDB on disk; each batch commits its changes rather than whole files,
#: and logs are not allocated ahead, which would cost each state partition megabytes.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null becomes empty.

    A single space is left alone, so the pattern only matches where something changes.
    """
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def on_files(docs: DataFrame) -> DataFrame:
    """``docs`` if its rows come straight from files, else a copy in the shared folder."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
        return docs
    except AnalysisException:
        return store(docs, "content")


def _locator() -> list[Column]:
    return [F.xxhash64("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with columns ``_file`` and ``_row``, which find a row's content again."""
    docs = on_files(docs)
    return docs.select(*[docs[c] for c in docs.columns], *_locator())


def rows_at(docs: DataFrame) -> DataFrame:
    """Whole rows (a struct, so that no column's name clashes) with their locators."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *_locator())


def only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` (on files) at the locators in ``kept``.

    The locators are hashed where a task can hold its share, so whole rows are dealt once and not sorted.
    """
    return rows_at(docs).join(hashed(kept.select("_file", "_row")), ["_file", "_row"], "left_semi").select("row.*")


def fingerprints(content: DataFrame, key: str, text: str, digest_bytes: int) -> DataFrame:
    sha = F.unhex(F.sha2(normalised(F.col(text)), 256))
    return content.select(F.col(key).alias("id"), "_file", "_row", sha.alias("sha")).withColumn(
        "digest", F.expr(f"substring(sha, 1, {int(digest_bytes)})")
    )


def _run_stream(spark: SparkSession, home: str, schema, files: int | None) -> list[int]:
    """Feed what has arrived to the keyed state; write each batch's changed keys to ``home``/seen."""
    stream = spark.readStream.schema(schema)
    if files:
        stream = stream.option("maxFilesPerTrigger", files)
    rep = F.struct(F.col("id").isNull().alias("no_id"), "id", "_file", "_row")
    keyed = stream.parquet(f"{home}/arrivals/*").groupBy("digest").agg(F.min(rep).alias("rep"), F.count(F.lit(1)).alias("n"))
    seen = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{home}/seen/batch={number}")  # a batch that runs again replaces itself
        seen.append(number)

    with settings(spark, STATE):
        query = (
            keyed.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return sorted(set(seen))


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _named(content: DataFrame) -> str:
    """A delivery's name from its files' paths, sizes and times."""
    files = content.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    return f"{files.select(F.xxhash64('*').alias('h')).agg(F.coalesce(F.bit_xor('h'), F.lit(0)).alias('h')).first()['h'] & (1 << 64) - 1:016x}"


def _arrive(made: DataFrame, home: str, delivery: str) -> bool:
    """Put a delivery's fingerprints where the stream looks, whole or not at all; False if they are there already."""
    spark = made.sparkSession
    there, files = _place(spark, f"{home}/arrivals/{delivery}")
    if files.exists(there):
        return False
    made.write.mode("overwrite").parquet(f"{home}/arriving/{delivery}")
    files.mkdirs(there.getParent())
    files.rename(_place(spark, f"{home}/arriving/{delivery}")[0], there)
    return True


def _with_state(prints: DataFrame, seen: DataFrame) -> DataFrame:
    """``prints`` with their digest's ``rep`` and ``n``.

    A digest with more than a thousandth of all rows is one of at most 1000, which are broadcast.
    """
    total = seen.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") > max(1000, total // 1000)
    hot = seen.where(often)
    rest = prints.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(seen.where(~often), "digest")
    return prints.join(F.broadcast(hot), "digest").unionByName(rest)


def exact_dedup(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    digest_bytes: int = 32,
    files_per_batch: int | None = None,
    state: str | None = None,
    delivery: str | None = None,
) -> DataFrame:
    """Per row of ``docs``: id, _file, _row, sha, keep_id, group_size, kept.

    ``digest_bytes`` shortens the state's key; results stay the same because every hit is
    checked on full bytes.  ``files_per_batch`` bounds a micro-batch.  ``state`` is the folder in
    which the state is kept for later deliveries (same ``digest_bytes``); without it the state ends
    with this call.  Groups then hold the rows of all deliveries so far.  ``delivery`` names this one.
    """
    spark = docs.sparkSession
    content = located(docs.select(docs[key], docs[text]))
    home = state.rstrip("/") if state else scratch(spark, "dedup")
    delivery = (delivery or _named(content)) if state else uuid.uuid4().hex
    made = fingerprints(content, key, text, digest_bytes)
    new = _arrive(made, home, delivery)
    prints = spark.read.schema(made.schema).parquet(f"{home}/arrivals/{delivery}")
    if prints.isEmpty():
        return prints.select("id", "_file", "_row", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    if state:
        content.select("_metadata.file_path", "_file").distinct().write.mode("overwrite").parquet(f"{home}/files/{delivery}")
    batches = _run_stream(spark, home, prints.schema, files_per_batch)
    kind = prints.schema["id"].dataType.simpleString()
    keyed = f"digest binary, rep struct<no_id:boolean,id:{kind},_file:bigint,_row:bigint>, n bigint"
    if new:  # every key of the delivery has changed
        seen = spark.read.schema(keyed).parquet(*[f"{home}/seen/batch={n}" for n in batches])
    else:  # earlier runs may have made some or all of its batches
        seen = spark.read.schema(keyed).parquet(f"{home}/seen/*").join(prints.select("digest").distinct(), "digest", "left_semi")
    if len(batches) > 1 or not new:  # a later batch holds a key's newer state
        seen = seen.groupBy("digest").agg(F.min("rep").alias("rep"), F.max("n").alias("n"))
    groups = store(_with_state(prints, seen), "groups")

    # Hits: rows of digests that came more than once, with their content by locator.
    hits = groups.where("n > 1").select("_file", "_row", "digest")
    if state:  # rows of earlier deliveries too, whose files the hits name
        arrived = spark.read.schema(prints.schema).parquet(f"{home}/arrivals/*")
        hits = store(arrived.join(hits.select("digest").distinct(), "digest", "left_semi").select("_file", "_row", "digest"), "hits")
        files = spark.read.schema("file_path string, _file bigint").parquet(f"{home}/files/*")
        names = [r[0] for r in files.join(hits.select("_file").distinct(), "_file", "left_semi").select("file_path").distinct().collect()]
        content = located(spark.read.schema(docs.select(docs[key], docs[text]).schema).parquet(*names)) if names else content
    full = may_hold(content.select("_file", "_row", F.col(key).alias("id"), F.col(text).alias("bytes")), hits, "_file", "_row")
    full = full.withColumn("bytes", normalised(F.col("bytes"))).join(hashed(hits), ["_file", "_row"])
    classes = full.groupBy("digest", "bytes").agg(F.count(F.lit(1)).alias("copies"))
    clashes = classes.groupBy("digest").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1").select("digest")
    clashes = store(clashes, "clashes")

    if not clashes.isEmpty():
        apart = full.join(clashes, "digest")
        rep = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "_file", "_row"))
        by_text = apart.groupBy("digest", "bytes").agg(rep.alias("rep2"), F.count(F.lit(1)).alias("n2"))
        fixed = apart.join(by_text, ["digest", "bytes"]).select("_file", "_row", "rep2", "n2")
        groups = groups.join(fixed, ["_file", "_row"], "left").withColumns(
            {"rep": F.coalesce("rep2", "rep"), "n": F.coalesce("n2", "n")}
        )
    return groups.select(
        "id", "_file", "_row", "sha",
        F.col("rep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("rep._file") == F.col("_file")) & (F.col("rep._row") == F.col("_row"))).alias("kept"),
    )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_dedup(docs).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


#: DuckDB SQL for the rows of ``op1_exact_dedup``.
OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal texts one row stays, with all its columns (the smallest doc_id; a null
    id only if there is no other; null counts as empty).  An empty table stays empty."""
    docs = on_files(docs)
    return only(docs, exact_dedup(docs).where("kept"))
