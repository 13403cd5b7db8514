"""Landed payloads: where they lie, how they get there and how Spark lists them."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import path_piece
from ..functions.values import checked_date

log = logging.getLogger(__name__)
FORMATS = {"teamtailor": "xml"}
RETRIED = (429, 500, 502, 503, 504)


def landed_path(source: str, date: str, slug: str, at: datetime) -> str:
    """``source/ingest_date=D/slug/HHMMSS.ext`` relative to the landing folder."""
    return f"{source}/ingest_date={checked_date(date)}/{slug}/{at:%H%M%S}.{FORMATS.get(source, 'json')}"


def write_bytes(spark: SparkSession, path: str, body: bytes) -> None:
    """Write a payload byte for byte to any store that Spark reaches."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(body))
    finally:
        out.close()


class Unavailable(Exception):
    """A board's answer that is worth another try; ``status`` is the HTTP status."""

    def __init__(self, status: int):
        super().__init__(f"status {status}")
        self.status = status


def with_retries(fetch: Callable[[str], bytes | None], slug: str, tries: int = 4, pause: float = 1.0) -> bytes | None:
    """Fetch with growing pauses after passing faults; None when the board stays out of reach."""
    for attempt in range(tries):
        try:
            return fetch(slug)
        except Unavailable as fault:
            if fault.status not in RETRIED or attempt == tries - 1:
                return None
            time.sleep(pause * 2**attempt)
    return None


def not_truncated(body: bytes | None, item: bytes = b"<item>", page: int = 200) -> bytes | None:
    """None if a feed holds exactly a page of items: the rest may have been cut off."""
    return None if body is None or body.count(item) == page else body


def summary(total: int, failed: Iterable[str]) -> dict:
    failed = sorted(failed)
    if total and len(failed) == total:
        raise ValueError(f"all {total} companies failed")
    return {"total": total, "landed": total - len(failed), "failed": failed}


def boards(registry: DataFrame, source: str) -> DataFrame:
    return registry.where(F.col("ats") == source).orderBy("external_id")


def landed_files(spark: SparkSession, root: str, source: str, date: str) -> DataFrame:
    """A day's files: path relative to the root, company_slug, landed_at, content.  Only that day's folder is listed."""
    folder = f"{root.rstrip('/')}/{source}/ingest_date={checked_date(date)}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.concat(F.lit(f"{source}/"), F.substring_index("path", f"/{source}/", -1))
    return files.select(
        path.alias("path"), path_piece(path, 3).alias("company_slug"),
        F.col("modificationTime").alias("landed_at"), F.col("content").cast("string").alias("content"),
    )


def files_per_company(files: DataFrame) -> DataFrame:
    return files.groupBy("company_slug").agg(F.count(F.lit(1)).alias("files"))


def fresh_details(details: DataFrame, date: str, days: int) -> DataFrame:
    """Ids whose details were fetched within ``days`` before a date and need no new call."""
    since = F.to_timestamp(F.lit(checked_date(date))) - F.make_dt_interval(F.lit(days))
    return details.where(F.col("detail_fetched_at") >= since).select("id")


def to_fetch(wanted: DataFrame, known: DataFrame, budget: int) -> DataFrame:
    """The first ``budget`` wanted ids (columns pos, id) that are not known, each once, in order."""
    new = wanted.groupBy("id").agg(F.min("pos").alias("pos")).join(known, "id", "left_anti")
    return new.orderBy("pos").limit(max(budget, 0)).select("id", "pos")
