"""Fetching registered boards and landing their payloads, by tasks.

A Python data source deals the boards over tasks, which fetch them with retries; what a board answers goes
straight to a landing sink in the same task.  The sink writes in two phases: a task puts its files into a
folder of its own below ``_landing``, and only when all tasks have ended are the files of those attempts
that count moved to where loads look for them.  So a task that is lost and runs again lands nothing twice, and
an extract that fails lands nothing.  The moves are planned in a file first; ``finish_landing`` makes those of
an extract that died while it moved.

``fetch`` is the caller's function from a board to its bytes (None: out of reach); it goes to the tasks, so it must be
picklable and not count on what it changes outside.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from .landing import boards, landed_path, summary, with_retries

Fetch = Callable[[str], bytes | None]
PAYLOADS = "slug string, fetched_at timestamp, body binary"


class Boards(InputPartition):
    def __init__(self, slugs: list[str]):
        self.slugs = slugs


def board_source(name: str, slugs: list[str], fetch: Fetch, tasks: int, tries: int, pause: float) -> type[DataSource]:
    """A data source of that name: a row for each board, with a null body if it stays out of reach."""

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            n = max(1, min(tasks, len(slugs)))
            return [Boards(slugs[i::n]) for i in range(n)]

        def read(self, partition: Boards) -> Iterator[tuple]:
            for slug in partition.slugs:
                body = with_retries(fetch, slug, tries, pause)
                yield slug, datetime.now(timezone.utc), body

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return PAYLOADS

        def reader(self, schema: StructType) -> DataSourceReader:
            return Reader()

    return Source


@dataclass
class Landed(WriterCommitMessage):
    """What a task's attempt has staged: (path in its folder, path when landed), and the boards without an answer."""

    folder: str
    files: list[str]
    failed: list[str]


class LandingWriter(DataSourceWriter):
    """Stages rows of ``PAYLOADS`` and lands them when all are there."""

    def __init__(self, root: str, source: str, date: str, run: str):
        self.root, self.source, self.date, self.run = root.rstrip("/"), source, date, run

    def _files(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root)

    def write(self, rows: Iterable) -> Landed:
        files, base = self._files()
        out = Landed(f"_landing/{self.run}/{uuid.uuid4().hex}", [], [])
        for row in rows:
            if row["body"] is None:
                out.failed.append(row["slug"])
                continue
            path = landed_path(self.source, self.date, row["slug"], row["fetched_at"])
            at = f"{base}/{out.folder}/{path}"
            files.create_dir(at.rpartition("/")[0], recursive=True)
            with files.open_output_stream(at) as f:
                f.write(bytes(row["body"]))
            out.files.append(path)
        return out

    def commit(self, messages: list[Landed | None]) -> None:
        files, base = self._files()
        done = [m for m in messages if m]
        plan = {"moves": [[f"{m.folder}/{p}", p] for m in done for p in m.files], "failed": sorted(s for m in done for s in m.failed)}
        files.create_dir(f"{base}/_landing/{self.run}", recursive=True)
        with files.open_output_stream(f"{base}/_landing/{self.run}/plan.tmp") as f:
            f.write(json.dumps(plan).encode())
        files.move(f"{base}/_landing/{self.run}/plan.tmp", f"{base}/_landing/{self.run}/plan.json")
        _move(files, base, self.run)

    def abort(self, messages: list[Landed | None]) -> None:
        files, base = self._files()
        _drop(files, f"{base}/_landing/{self.run}")


def _drop(files: fs.FileSystem, folder: str) -> None:
    if files.get_file_info(folder).type == fs.FileType.Directory:
        files.delete_dir(folder)


def _move(files: fs.FileSystem, base: str, run: str) -> None:
    """Make the moves of a run's plan that have not been made, note the outcome, and clear the run's folder."""
    with files.open_input_stream(f"{base}/_landing/{run}/plan.json") as f:
        plan = json.loads(f.read())
    for staged, final in plan["moves"]:
        if files.get_file_info(f"{base}/{staged}").type == fs.FileType.File:
            files.create_dir(f"{base}/{final}".rpartition("/")[0], recursive=True)
            files.move(f"{base}/{staged}", f"{base}/{final}")
    with files.open_output_stream(f"{base}/_landing/{run}.json") as f:
        f.write(json.dumps({"landed": len(plan["moves"]), "failed": plan["failed"]}).encode())
    _drop(files, f"{base}/_landing/{run}")


def finish_landing(root: str) -> list[str]:
    """Land what extracts that died while moving had planned; their runs."""
    files, base = fs.FileSystem.from_uri(root.rstrip("/"))
    found = files.get_file_info(fs.FileSelector(f"{base}/_landing", allow_not_found=True))
    runs = [x.base_name for x in found if x.type == fs.FileType.Directory and files.get_file_info(f"{x.path}/plan.json").type == fs.FileType.File]
    for run in sorted(runs):
        _move(files, base, run)
    return sorted(runs)


def landing_sink(name: str) -> type[DataSource]:
    """A sink of that name with options path, source, date and run."""

    class Sink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
            return LandingWriter(*(self.options[k] for k in ("path", "source", "date", "run")))

    return Sink


def extract(
    spark: SparkSession, root: str, source: str, date: str, registry: DataFrame, fetch: Fetch, tasks: int = 8, tries: int = 4, pause: float = 1.0,
) -> dict:
    """Land every registered board's payload; a summary of what failed."""
    slugs = [r["external_id"] for r in boards(registry, source).collect()]  # a registry of companies, not of postings
    if not slugs:
        raise ValueError(f"no company is registered for {source}")
    run = uuid.uuid4().hex
    spark.dataSource.register(board_source("quarrylake_boards", slugs, fetch, tasks, tries, pause))
    spark.dataSource.register(landing_sink("quarrylake_landing"))
    payloads = spark.read.format("quarrylake_boards").load()
    payloads.write.format("quarrylake_landing").mode("append").options(path=root, source=source, date=date, run=run).save()
    files, base = fs.FileSystem.from_uri(root.rstrip("/"))
    with files.open_input_stream(f"{base}/_landing/{run}.json") as f:
        return summary(len(slugs), json.loads(f.read())["failed"])


# One budget of detail requests for all boards

BUDGET = "date string, known bigint, chosen bigint, fetched bigint, deferred bigint, rate_limited boolean"
DETAILS = "board string, id string, pos bigint, status string, body string"


def details_to_fetch(wanted: DataFrame, known: DataFrame, budget: int) -> DataFrame:
    """Of wanted details (board, pos, id), those not known, each once a board, with their place in the order of boards and whether the budget reaches them.

    Places are a prefix sum in two steps: the number of each board's details gives the board's offset, and a
    detail's rank within its board the rest.  So only the boards' counts meet in one task.
    """
    new = wanted.groupBy("board", "id").agg(F.min("pos").alias("pos")).join(known.select("id"), "id", "left_anti")
    counts = new.groupBy("board").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("board").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("board", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("board").orderBy("pos", "id"))
    placed = new.withColumn("rank", rank).join(offsets, "board").withColumn("place", F.col("offset") + F.col("rank"))
    return placed.select("board", "id", "pos", "place", (F.col("place") <= max(budget, 0)).alias("chosen"))


def fetch_details(chosen: DataFrame, fetch: Callable[[str, str], tuple[int, bytes | None]], tasks: int = 4) -> DataFrame:
    """Rows (board, id, pos, status, body) of the chosen details; ``fetch`` gives a detail's HTTP status and body.

    A task that is told to slow down (429) asks no more, and its remaining details have status ``deferred``; a
    detail that fails otherwise is ``failed`` and stays unknown, so a later run tries it again.  Keep the result
    before reading it twice: each reading asks again.
    """

    def ask(batches: Iterator) -> Iterator:
        limited = False
        for pdf in batches:
            status, body = [], []
            for board, id_ in zip(pdf["board"], pdf["id"]):
                code, answer = (429, None) if limited else fetch(board, id_)
                limited = limited or code == 429
                status.append("deferred" if code == 429 else "fetched" if answer is not None and code == 200 else "failed")
                body.append(answer.decode() if status[-1] == "fetched" else None)
            yield pdf.assign(status=status, body=body)

    # Runs of places stay together and in order, so that a task's first details are those of the first boards.
    dealt = chosen.where("chosen").repartitionByRange(tasks, "place").sortWithinPartitions("place")
    return dealt.select("board", "id", "pos").mapInPandas(ask, DETAILS)


def budget_row(spark: SparkSession, date: str, placed: DataFrame, details: DataFrame, known: DataFrame) -> DataFrame:
    """A row for the table of runs: how many details were known, chosen, fetched and put off, and whether a limit was met."""
    a = placed.agg(F.count(F.lit(1)).alias("new"), F.count_if("chosen").alias("chosen")).first()
    b = details.agg(F.count_if(F.col("status") == "fetched").alias("fetched"), F.count_if(F.col("status") == "deferred").alias("put_off")).first()
    row = (date, known.count(), a["chosen"], b["fetched"], a["new"] - a["chosen"] + b["put_off"], b["put_off"] > 0)
    return spark.createDataFrame([row], BUDGET)


def envelopes(lists: DataFrame, details: DataFrame) -> DataFrame:
    """Rows (board, content): each board's list (board, content as JSON) with its fetched details, every answer kept whole."""
    told = details.where("status = 'fetched'").select("board", F.concat(F.to_json(F.struct(F.col("id").alias("k"))), F.lit("\0"), "body").alias("one"))
    pair = F.concat(F.regexp_extract("one", r'^\{"k":(".*")\}\x00', 1), F.lit(":"), F.substring_index("one", "\0", -1))
    joined = told.select("board", pair.alias("pair")).groupBy("board").agg(F.array_join(F.array_sort(F.collect_list("pair")), ",").alias("pairs"))  # one board's details
    whole = F.concat(F.lit('{"account":'), "content", F.lit(',"details":{'), F.coalesce("pairs", F.lit("")), F.lit("}}"))
    return lists.join(joined, "board", "left").select("board", whole.alias("content"))
