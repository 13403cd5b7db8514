"""Helpers that several operators share: scratch tables and Arrow text batches."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text is handed to the array code in slices of about this many bytes.
SLICE_BYTES = 2 << 20


#: Scratch tables of this process; ``release`` deletes them, at exit at the latest.
_made: list[tuple[SparkSession, str]] = []


#: Folders of our own by application, where the session names none.
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a folder of our own only where none is set.

    The setting belongs to the context and cannot be changed in a session, so ours is only remembered here.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    application = spark.sparkContext.applicationId
    if application not in _own:
        if spark.sparkContext.master.split("[")[0] == "local":  # one machine
            own = tempfile.mkdtemp(prefix="quarrylake-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
            _own[application] = f"file://{own}"
        else:
            _own[application] = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return _own[application]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, kept until ``release``: plans that read it may still run."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append((spark, path))
    return path


def release() -> None:
    """Delete all scratch tables; call it when no result that reads them is needed any more."""
    while _made:
        spark, path = _made.pop()
        try:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # at exit the session may have ended
            return


atexit.register(release)


#: Rows and bytes that are handed to a Python worker at a time while a scratch table is made: less memory for each task.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the work inside; afterwards they are as they were."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def store(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch(spark, name)
    with settings(spark, BATCHES):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of the filter of ``may_hold``: its table has a row for each 64 of them at most, about 16 MB.
FILTER_BITS = 1 << 26


def may_hold(rows: DataFrame, wanted: DataFrame, *key: str) -> DataFrame:
    """``rows`` without most of those whose key is not among the ``wanted``, so that fewer are shuffled.

    A bit for each wanted key's hash, in a table whose size has a bound and is broadcast.  A fuller
    table only passes more rows; a join on the key follows.
    """
    place = F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS))
    one = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({', '.join(key)}), 64) AS int))")
    bits = wanted.select((place / 64).cast("int").alias("_word"), one.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    found = rows.withColumn("_word", (place / 64).cast("int")).join(F.broadcast(bits), "_word")
    return found.where(F.col("_bits").bitwiseAND(one) != 0).select(*rows.columns)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """The table with a broadcast hint if its size is within bounds; else Spark decides by size."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Rows of a hash table that a task may hold: some hundred bytes each.
TABLE_ROWS = 1_000_000


def hashed(keys: DataFrame) -> DataFrame:
    """``keys`` (cheap to count) with a hint to join by hash tables of it, if no task's share is too large to hold; else Spark sorts and may spill."""
    tasks = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.hint("shuffle_hash") if keys.count() <= TABLE_ROWS * tasks else keys


def strings(column: pa.Array) -> pa.Array:
    """The column as plain strings, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.string()), "")


@functools.cache
def _trim() -> Callable[[int], int]:
    """The C library's ``malloc_trim``, where there is one."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def give_back() -> None:
    """Hand memory that is free but held by Arrow or the C library back to the system.

    Spark keeps its Python workers from stage to stage; what they hold adds up on an executor.
    """
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes) // limit
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)
    give_back()


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All ``[^\\x20\\x09-\\x0D]+`` of the texts in order, and each text's offsets into them."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if full.all():
        return flat, offsets
    return flat.filter(pa.array(full)), np.r_[0, np.cumsum(full)][offsets]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices that read the runs ``starts[i] .. starts[i]+lengths[i]`` one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
