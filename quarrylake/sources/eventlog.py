"""Spark's event logs as a table of jobs: what each read, how long it took and how it ended.

Logs are JSON lines, read by declared schemas; plain, rolling and finished ones alike, as long as
they are not compressed.  An application is named by its log's file or folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import struct

EVENTS = (
    "Event string, `Job ID` bigint, `Submission Time` bigint, `Completion Time` bigint, `Stage IDs` array<bigint>, `Job Result` struct<Result:string>, "
    "Properties map<string,string>, `Stage ID` bigint, `Task Metrics` struct<`Executor Run Time`:bigint,`Executor CPU Time`:bigint,"
    "`Disk Bytes Spilled`:bigint,`Input Metrics`:struct<`Bytes Read`:bigint,`Records Read`:bigint>,`Shuffle Write Metrics`:struct<`Shuffle Bytes Written`:bigint>>"
)


def events(spark: SparkSession, path: str) -> DataFrame:
    """All lines of the logs under ``path`` with their application."""
    raw = spark.read.schema(struct(EVENTS)).option("recursiveFileLookup", "true").json(path)
    file = F.col("_metadata.file_path")
    rolling = F.regexp_extract(file, r"/eventlog_v2_([^/]+)/", 1)
    plain = F.regexp_replace(F.substring_index(file, "/", -1), r"\.inprogress$", "")
    return raw.select(F.when(rolling != "", rolling).otherwise(plain).alias("application"), *raw.columns)


def jobs(log: DataFrame) -> DataFrame:
    """One row for each job: application, job_id, step, started_at, ended_at, seconds, status, tasks, bytes_read, shuffle_bytes, spilled_bytes, task_seconds.

    ``step`` is the job's group.  A stage counts for the first of the jobs that list it, which is the one that
    ran it.  Tasks that failed count with what they read; a job without an end has status ``running``.
    """
    kind = lambda name: log.where(F.col("Event") == f"SparkListener{name}")
    started = kind("JobStart").select(
        "application", F.col("Job ID").alias("job_id"), F.timestamp_millis("Submission Time").alias("started_at"),
        F.col("Properties")["spark.jobGroup.id"].alias("step"), F.col("Stage IDs").alias("stages"),
    )
    ended = kind("JobEnd").select(
        "application", F.col("Job ID").alias("job_id"), F.timestamp_millis("Completion Time").alias("ended_at"),
        F.when(F.col("Job Result.Result") == "JobSucceeded", "pass").otherwise("error").alias("ended"),
    )
    ran = started.select("application", "job_id", F.explode("stages").alias("stage")).groupBy("application", "stage").agg(F.min("job_id").alias("job_id"))
    m = F.col("Task Metrics")
    tasks = kind("TaskEnd").groupBy("application", F.col("Stage ID").alias("stage")).agg(
        F.count(F.lit(1)).alias("tasks"), F.sum(m["Input Metrics"]["Bytes Read"]).alias("bytes_read"),
        F.sum(m["Shuffle Write Metrics"]["Shuffle Bytes Written"]).alias("shuffle_bytes"),
        F.sum(m["Disk Bytes Spilled"]).alias("spilled_bytes"), F.sum(m["Executor Run Time"]).alias("run_ms"),
    )
    sums = tasks.join(ran, ["application", "stage"]).groupBy("application", "job_id").agg(
        *[F.sum(c).alias(c) for c in ("tasks", "bytes_read", "shuffle_bytes", "spilled_bytes", "run_ms")]
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    whole = started.join(ended, ["application", "job_id"], "left").join(sums, ["application", "job_id"], "left")
    return whole.select(
        "application", "job_id", "step", "started_at", "ended_at",
        ((F.unix_millis("ended_at") - F.unix_millis("started_at")) / 1000).alias("seconds"), F.coalesce("ended", F.lit("running")).alias("status"),
        *map(zero, ("tasks", "bytes_read", "shuffle_bytes", "spilled_bytes")), (F.coalesce("run_ms", F.lit(0)) / 1000).alias("task_seconds"),
    )


def step_reads(found: DataFrame) -> DataFrame:
    """Jobs added up by the steps that ran them; jobs of no step are left out."""
    return found.where("step IS NOT NULL").groupBy("application", "step").agg(
        F.min("started_at").alias("started_at"), F.count(F.lit(1)).alias("jobs"), F.sum("bytes_read").alias("bytes_read"), F.sum("task_seconds").alias("task_seconds"),
    )
