"""Sequence packing, shortest pack first over the histogram of lengths.

Documents are tokenised and cut into full sequences and a rest.  Only the rests' lengths matter
for the plan: their histogram has at most ``width`` bins whatever the corpus, so the plan is made
on the driver.  Lengths are placed longest first, each into the packs that are filled least;
packs of equal filling are one range of sequence ids, so a whole bin moves in a few steps.  The
plan says for each length and range of ranks which sequence and offset it gets, and pieces find
their place by their rank among pieces of equal length.  Ranks come from counts of (length,
bucket), so a length that a third of all documents share is ranked by many tasks.

Rows: a null text counts as empty and yields the end id alone.  Rows of one key are packed each
on its own.  An empty table gives an empty result.  Other columns are never read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, store, strings
from .tokens import word_ids

WIDTH = 4096
#: Pieces of one length that one task ranks, about.
RANKED = 1000

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def shortest_pack_first(histogram: dict[int, int], width: int = WIDTH) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, count, first sequence, offset), and the number of sequences.

    Piece ``r`` of a length goes to sequence ``first sequence + r - first rank`` of its row.
    """
    heap: list[tuple[int, int, int]] = []  # (filled, first sequence, count): the least filled on top
    sequences, plan = 0, []
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if not heap or heap[0][0] + length > width:
                opened = -(-left // (width // length))
                heapq.heappush(heap, (0, sequences, opened))
                sequences += opened
            filled, first, count = heapq.heappop(heap)
            n = min(count, left)
            plan.append((length, rank, n, first, filled))
            if n < count:
                heapq.heappush(heap, (filled, first + n, count - n))
            if filled + length < width:
                heapq.heappush(heap, (filled + length, first, n))
            left, rank = left - n, rank + n
    return np.array(plan, np.int64).reshape(-1, 5), sequences


def cut_pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = 2, width: int = WIDTH, with_ids: bool = False) -> DataFrame:
    """Per piece of at most ``width`` ids: doc_id, start, length, ids_crc32, doc_tokens (and ids)."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = encoder.encode(strings(part.column("text")), end)
                sizes = np.diff(offsets)
                parts = -(-sizes // width)
                row = np.repeat(np.arange(len(sizes)), parts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * width
                length = np.minimum(width, sizes[row] - start)
                a = offsets[row] + start
                crcs = [zlib.crc32(ids[x:y]) for x, y in zip(a.tolist(), (a + length).tolist())]
                columns = [part.column("id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64()), pa.array(sizes[row])]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.r_[a, offsets[-1]].astype(np.int32), pa.array(ids.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    return rows.mapInArrow(pieces, PIECES + (", ids array<bigint>" if with_ids else ""))


def place(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """``pieces`` (a stored table) with sequence_id and offset."""
    spark = pieces.sparkSession
    lengths = pieces.groupBy("length").count().collect()  # at most ``width`` rows
    histogram = {r["length"]: r["count"] for r in lengths}
    histogram.pop(width, None)  # full already
    plan, sequences = shortest_pack_first(histogram, width)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = spark.sparkContext.broadcast((plan[:, 0] << 44 | plan[:, 1], plan))  # at most width**2 rows, for any corpus

    buckets = spark.createDataFrame([(r["length"], max(1, r["count"] // RANKED)) for r in lengths], "length bigint, buckets bigint")
    salted = pieces.join(F.broadcast(buckets), "length")  # at most ``width`` rows
    salted = salted.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), "buckets")).drop("buckets")
    counts = salted.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("lower"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(inside) - 1).join(counts, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("lower")).drop("lower", "bucket")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, plan = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            sequence, offset = sequences + rank, np.zeros_like(rank)
            rest = length < width
            row = plan[np.searchsorted(keys, length[rest] << 44 | rank[rest], side="right") - 1]
            sequence[rest], offset[rest] = row[:, 3] + rank[rest] - row[:, 1], row[:, 4]
            kept = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*pieces.columns, "rank").mapInArrow(find, f"{schema}, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = 2, width: int = WIDTH) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return place(store(cut_pieces(docs, tokenizer, key, text, end, width), "pieces"), width)


def sequences(docs: DataFrame, tokenizer: str, end: int = 2, pad: int = 0, width: int = WIDTH) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (padded to ``width``), doc_ids."""
    placed = place(store(cut_pieces(docs, tokenizer, end=end, width=width, with_ids=True), "pieces"), width)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))  # one sequence: at most ``width`` ids
    filled = placed.groupBy("sequence_id").agg(parts.alias("parts"))
    ids = F.flatten(F.transform("parts", lambda p: p["ids"]))
    return filled.select(
        "sequence_id",
        F.concat(ids, F.array_repeat(F.lit(pad).cast("long"), F.greatest(F.lit(width) - F.size(ids), F.lit(0)))).alias("ids"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: the pieces of the documents and their places; a null text is its end id alone."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))
