"""Current-state tables in Parquet files: numbered commits, and upserts that rewrite only the buckets they touch.

A table is a folder.  ``data/w-*`` holds what one write has made; ``_log/<number>.json`` holds one version: the
files it consists of.  Data files are never changed, and a version exists once its commit has been
published under its number, which succeeds for one writer only.  So a write that dies at any point, the
first one too, leaves the table as it was, and readers never see half a version.

Upserted tables are hash-buckets of their key, as Spark's own bucketed tables.  A merge reads the files of the
buckets that the incoming keys fall into, and writes these buckets anew; all others' files go
over to the next version as they are.  The table's side of the merge join is read by bucket, so only the
incoming rows are shuffled.

Writers do not lock.  One that finds its number taken looks at what has been committed since it began: if
others have touched other buckets, its own files join theirs; if they share a bucket, it merges again
from the newest version.  A number is published by a hard link on a local disk and by a rename that refuses to replace
elsewhere, so the store must have such a rename (HDFS has).
"""

from __future__ import annotations

import json
import logging
import os
import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import struct

log = logging.getLogger(__name__)
#: Spark's names of bucketed files end in the bucket's number.
_BUCKET = re.compile(r"_(\d+)(?:\..*)?$")


def bucket_of(file: str) -> int:
    return int(_BUCKET.search(file)[1])


class Conflict(RuntimeError):
    """Other writers have been faster too often."""


@dataclass(frozen=True)
class Commit:
    """A version: its files (paths below ``data``); key and number of buckets (0: none); the buckets it changed (None: all)."""

    number: int
    files: tuple[str, ...] = ()
    key: str | None = None
    buckets: int = 0
    changed: tuple[int, ...] | None = None

    def text(self) -> str:
        return json.dumps({"key": self.key, "buckets": self.buckets, "changed": self.changed, "files": self.files})

    @staticmethod
    def parsed(number: int, text: str) -> Commit:
        x = json.loads(text)
        return Commit(number, tuple(x["files"]), x["key"], x["buckets"], None if x["changed"] is None else tuple(x["changed"]))


@dataclass
class Upserted:
    """What an upsert has made: the table, the rows of the buckets that were written anew, and those buckets (of how many)."""

    table: DataFrame
    written: DataFrame
    touched: tuple[int, ...]
    buckets: int


@dataclass
class Lake:
    """Tables under a root.  The last ``keep`` versions stay readable; ``buckets`` is for tables that are upserted for the first time.

    Choose ``buckets`` so that one holds some hundred megabytes; ``rebucket`` deals a table anew.
    """

    spark: SparkSession
    root: str
    keep: int = 3
    buckets: int = 8
    attempts: int = 10

    # Files

    def _at(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        place, files = self._at(folder)
        return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []

    def delete(self, path: str) -> None:
        place, files = self._at(path)
        files.delete(place, True)

    def _data(self, table: str) -> str:
        return f"{self.root}/{table}/data"

    # Commits

    def _numbers(self, table: str) -> list[int]:
        return [int(n[:-5]) for n in self._names(f"{self.root}/{table}/_log") if re.fullmatch(r"\d+\.json", n)]

    def _commit(self, table: str, number: int) -> Commit:
        place, files = self._at(f"{self.root}/{table}/_log/{number:020d}.json")
        stream = files.open(place)
        try:
            return Commit.parsed(number, self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def head(self, table: str) -> Commit | None:
        """The newest commit; None if there is none."""
        numbers = self._numbers(table)
        return self._commit(table, numbers[-1]) if numbers else None

    def _publish(self, table: str, commit: Commit) -> bool:
        """Make the commit its number's, unless that is taken.  Its content is whole before its name appears."""
        folder = f"{self.root}/{table}/_log"
        draft, files = self._at(f"{folder}/.draft-{uuid.uuid4().hex}")
        final, _ = self._at(f"{folder}/{commit.number:020d}.json")
        stream = files.create(draft, False)
        stream.write(commit.text().encode())
        stream.close()
        try:
            if files.getUri().getScheme() != "file":
                return not files.exists(final) and bool(files.rename(draft, final))
            os.link(draft.toUri().getPath(), final.toUri().getPath())
            return True
        except FileExistsError:
            return False
        finally:
            files.delete(draft, False)

    def _tidy(self, table: str) -> None:
        """Delete versions before the last ``keep`` and the files that only they have; files of no version may be another writer's."""
        numbers = self._numbers(table)
        old, kept = numbers[: -self.keep], numbers[-self.keep :]
        if not old:
            return
        live = {f for n in kept for f in self._commit(table, n).files}
        dead = {f for n in old for f in self._commit(table, n).files} - live
        folders = {f.split("/")[0] for f in live}
        for gone in {f if f.split("/")[0] in folders else f.split("/")[0] for f in dead}:
            self.delete(f"{self._data(table)}/{gone}")
        for n in old:
            self.delete(f"{self.root}/{table}/_log/{n:020d}.json")

    # Reading

    def version(self, table: str) -> int | None:
        head = self.head(table)
        return head.number if head else None

    def _files(self, table: str, files: Iterable[str], schema: StructType) -> DataFrame:
        paths = [f"{self._data(table)}/{f}" for f in files]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, table: str, schema: str, version: int | None = None) -> DataFrame:
        """The newest version, or one of those kept; a table that has none is empty."""
        commit = self._commit(table, version) if version is not None else self.head(table)
        return self._files(table, commit.files if commit else (), struct(schema))

    def _by_bucket(self, table: str, commit: Commit, files: list[str], schema: StructType) -> DataFrame:
        """The rows of some bucket files, known to Spark as dealt by the key: a join on it need not deal them again."""
        name = f"quarrylake_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true') "
            f"CLUSTERED BY (`{commit.key}`) INTO {commit.buckets} BUCKETS LOCATION '{self._data(table)}'"
        )
        rows = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the definition only: the files are not the catalog's
        return rows.where(F.col("_metadata.file_name").isin([f.split("/")[-1] for f in files])).select(*schema.names)

    # Writing

    def _made(self, table: str, folder: str) -> tuple[str, ...]:
        return tuple(f"{folder}/{n}" for n in self._names(f"{self._data(table)}/{folder}") if n.endswith(".parquet"))

    def _write_buckets(self, table: str, rows: DataFrame, key: str, buckets: int) -> tuple[str, ...]:
        folder, name = f"w-{uuid.uuid4().hex}", f"quarrylake_{uuid.uuid4().hex}"
        rows.write.format("parquet").bucketBy(buckets, key).option("path", f"{self._data(table)}/{folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        return self._made(table, folder)

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Replace the whole table; of writers at the same time the last one stays."""
        folder = f"w-{uuid.uuid4().hex}"
        df.write.parquet(f"{self._data(table)}/{folder}")
        files = self._made(table, folder)
        for _ in range(self.attempts):
            if self._publish(table, Commit((self.version(table) or 0) + 1, files)):
                self._tidy(table)
                return self._files(table, files, df.schema)
        raise Conflict(table)

    def upsert(self, table: str, schema: str, source: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], key: str = "id") -> Upserted:
        """Merge ``source`` (rows that can be read more than once) into the table.

        ``merge`` takes the rows of the touched buckets and the source; what it returns replaces those rows.
        """
        fields = struct(schema)
        for _ in range(self.attempts):
            base = self.head(table)
            buckets = base.buckets if base and base.buckets else self.buckets
            touched = {r[0] for r in source.select(F.pmod(F.hash(key), F.lit(buckets))).distinct().collect()}
            if not touched:
                return Upserted(self.read(table, schema), self.spark.createDataFrame([], fields), (), buckets)
            try:
                if base and base.buckets:
                    if base.key != key:
                        raise ValueError(f"table {table} is bucketed by {base.key}")
                    mine = [f for f in base.files if bucket_of(f) in touched]
                    target = self._by_bucket(table, base, mine, fields) if mine else self.spark.createDataFrame([], fields)
                    rows = merge(target, source)
                    changed: tuple[int, ...] | None = tuple(sorted(touched))
                else:  # the first upsert: all buckets are new
                    rows, changed = merge(self._files(table, base.files if base else (), fields), source), None
                made = self._write_buckets(table, rows.repartition(buckets, key) if changed is None or not mine else rows, key, buckets)
            except PySparkException:
                if self.head(table) == base:
                    raise
                log.info("table %s: what the merge read was replaced meanwhile", table)
                continue
            done = self._join_history(table, base, made, key, buckets, changed)
            if done:
                self._tidy(table)
                return Upserted(self._files(table, done.files, fields), self._files(table, made, fields), tuple(sorted(touched)), buckets)
            for folder in {f.split("/")[0] for f in made}:
                self.delete(f"{self._data(table)}/{folder}")
        raise Conflict(table)

    def _join_history(self, table: str, base: Commit | None, made: tuple[str, ...], key: str, buckets: int, changed: tuple[int, ...] | None) -> Commit | None:
        """Publish new bucket files after ``base``, or after later commits that touch other buckets; None if one shares a bucket."""
        while True:
            since = [n for n in self._numbers(table) if n > (base.number if base else 0)]
            for n in since:
                other = self._commit(table, n)
                if changed is None or other.changed is None or other.buckets != buckets or set(other.changed) & set(changed):
                    log.info("table %s: version %d shares buckets, merging again", table, n)
                    return None
                base = other
            if base and changed is not None:
                files = tuple(f for f in base.files if bucket_of(f) not in changed) + made
            else:
                files = made
            done = Commit((base.number if base else 0) + 1, files, key, buckets, changed)
            if self._publish(table, done):
                return done

    def rebucket(self, table: str, schema: str, buckets: int, key: str = "id") -> None:
        """Deal a table into another number of buckets."""
        for _ in range(self.attempts):
            base = self.head(table)
            rows = self._files(table, base.files if base else (), struct(schema))
            made = self._write_buckets(table, rows.repartition(buckets, key), key, buckets)
            if self._join_history(table, base, made, key, buckets, None):
                self._tidy(table)
                return
        raise Conflict(table)

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows to a table that has no versions."""
        df.write.mode("append").parquet(f"{self.root}/{table}")
