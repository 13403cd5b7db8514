"""Line deduplication: repeated lines stay only in the document with the smallest key.

Two Bloom filters, of hashes seen once and seen twice, find the lines that may repeat.  A task fills a
pair of its own; pairs are merged bit by bit (what two have seen once has been seen twice), so the order of
tasks does not matter and no repeat is ever missed.  The filters have ``BITS_A_LINE`` bits for each line, and
``MOST_BITS`` at most, so what is broadcast is bounded; a fuller filter only suspects more lines.  Only lines
under suspicion are shuffled: they are grouped by all their characters, which gives the documents that
hold each and the smallest key.  Lines to drop then meet their documents by locator; a document without any
is finished where it was read.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z in lower case.

Rows: a null or empty text is one empty line.  A line that repeats within its first document stays there each
time.  Rows of one id are one document.  A null id comes after all others: its lines go if another holds
them, and lines that only rows without an id hold stay.  An empty table gives an empty result.  Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCHES, may_hold, settings, slices, store, strings
from .exact_dedup import located

#: Bits of each filter for a line, hashes of a line, and the most bits of a filter (64 MB).
BITS_A_LINE, HASHES, MOST_BITS = 16, 3, 1 << 29
#: A filter travels in pieces of so many bytes.
PIECE = 1 << 13
#: Shorter keys are never dropped (code points).
SHORTEST = 10
SPACE = " \t\n\x0b\x0c\r"


class Lines:
    """The lines of a batch of texts: which text each belongs to, its number there, and its key."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern(texts, "\n")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        self.offsets = offsets - offsets[0]
        self.flat = lists.flatten()
        self.keys = pc.ascii_lower(pc.ascii_trim(self.flat, characters=SPACE))
        self.n = np.diff(self.offsets)
        self.text = np.repeat(np.arange(len(texts)), self.n)
        self.number = np.arange(len(self.flat)) - self.offsets[self.text]
        #: Places of the lines that are long enough to count.
        self.long = np.flatnonzero(pc.greater_equal(pc.utf8_length(self.keys), SHORTEST).to_numpy(zero_copy_only=False))

    def hashes(self) -> np.ndarray:
        """64-bit hashes of the long lines' keys."""
        keys = self.keys.take(pa.array(self.long)).cast(pa.binary()).to_pylist()
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bits of each hash: halves of the hash, combined anew for each of ``HASHES``."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return [((low + np.uint64(i) * high) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)) % np.uint64(bits) for i in range(HASHES)]


class Pair:
    """A filter of bits seen once and one of bits seen twice."""

    def __init__(self, bits: int):
        self.bits, self.once, self.twice = bits, np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        """Each hash once; a bit that a second one sets is seen twice."""
        for place in places(hashes, self.bits):
            again, n = np.unique(place, return_counts=True)
            byte, mask = (again >> np.uint64(3)).astype(np.int64), np.left_shift(1, (again & np.uint64(7)).astype(np.uint8)).astype(np.uint8)
            seen = (n > 1) | (self.once[byte] & mask > 0)
            np.bitwise_or.at(self.twice, byte[seen], mask[seen])
            np.bitwise_or.at(self.once, byte, mask)


def _pieces(index: list[int], once: list[bytes], twice: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(index, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], names=["piece", "once", "twice"])


PIECES = "piece int, once binary, twice binary"


def filters(content: DataFrame, bits: int) -> DataFrame:
    """Rows (piece, once, twice): the merged pair over all lines; pieces without a bit are left out."""
    width = min(PIECE, bits // 8)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(bits)
        for batch in batches:
            for part in slices(batch, "text"):
                lines = Lines(strings(part.column("text")))
                # A line counts once for a document.
                both = np.unique(np.stack([lines.text[lines.long].astype(np.uint64), lines.hashes()]), axis=1)
                pair.add(both[1])
        once, twice = pair.once.reshape(-1, width), pair.twice.reshape(-1, width)
        some = np.flatnonzero(once.any(axis=1))
        for at in range(0, len(some), 64):
            index = some[at : at + 64]
            yield _pieces(index.tolist(), [once[i].tobytes() for i in index], [twice[i].tobytes() for i in index])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for piece, once, twice in zip(*(batch.column(c).to_pylist() for c in ("piece", "once", "twice"))):
                a, b = np.frombuffer(once, np.uint8), np.frombuffer(twice, np.uint8)
                if piece in held:
                    o, t = held[piece]
                    t |= b | (o & a)
                    o |= a
                else:
                    held[piece] = a.copy(), b.copy()
        for piece, (o, t) in held.items():
            yield _pieces([piece], [o.tobytes()], [t.tobytes()])

    spark = content.sparkSession
    # A pair for each task: few tasks for each core, whatever the number of files.
    texts = content.select("text").coalesce(2 * spark.sparkContext.defaultParallelism)
    spread = min(64, max(1, bits // 8 // width))
    with settings(spark, BATCHES):
        return store(texts.mapInArrow(fill, PIECES).repartition(spread, "piece").mapInArrow(merge, PIECES), "line-filters")


def filter_bits(content: DataFrame, most: int = MOST_BITS) -> int:
    """A power of two with ``BITS_A_LINE`` bits for each line, within bounds."""
    ends = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"))) + 1
    lines = content.select(F.coalesce(F.sum(F.coalesce(ends.cast("long"), F.lit(1))), F.lit(0))).first()[0]
    bits = 1 << 16
    while bits < lines * BITS_A_LINE and bits < most:
        bits *= 2
    return min(bits, most)


READ = (
    "id bigint, _file bigint, _row bigint, n_lines bigint, sha string, "
    "suspects array<struct<key:string,lines:array<int>>>"
)


def suspected(content: DataFrame, bits: int, twice: bytes) -> DataFrame:
    """Per document: lines, digest of the whole text, and its long lines whose bits have all been seen twice."""
    shared = content.sparkSession.sparkContext.broadcast(twice)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = strings(part.column("text"))
                lines = Lines(texts)
                maybe = np.ones(len(lines.long), bool)
                for place in places(lines.hashes(), bits):
                    maybe &= seen[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1 > 0
                at = lines.long[maybe]
                keys = lines.keys.take(pa.array(at)).to_pylist()
                found: list[dict[str, list[int]]] = [{} for _ in range(part.num_rows)]
                for text, number, key in zip(lines.text[at].tolist(), lines.number[at].tolist(), keys):
                    found[text].setdefault(key, []).append(number)
                columns = [
                    part.column("id"), part.column("_file"), part.column("_row"), pa.array(lines.n),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts.cast(pa.binary()).to_pylist()], pa.string()),
                    pa.array([[{"key": k, "lines": n} for k, n in own.items()] for own in found], pa.list_(pa.struct([("key", pa.string()), ("lines", pa.list_(pa.int32()))]))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "_file", "_row", "n_lines", "sha", "suspects"])

    return content.select("id", "_file", "_row", "text").mapInArrow(read, READ)


def repeated(suspects: DataFrame) -> DataFrame:
    """Rows (key, first, n) of the keys that documents besides the first hold; ``n`` is the number of rows that hold it."""
    held = suspects.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"), F.count("id").alias("with_id"))
    return held.where("first < last OR (first IS NOT NULL AND with_id < n)").select("key", "first", "n")


#: Keys of at most so many bytes, held by over a thousandth of all suspected rows, are broadcast: a thousand at most.
HOT_BYTES = 1 << 13


def to_drop(suspects: DataFrame) -> DataFrame:
    """Rows (_file, _row, lines): the numbers of the lines that each document loses."""
    keys = store(repeated(suspects), "repeated-lines")
    total = suspects.count()
    often = (F.col("n") > max(1000, total // 1000)) & (F.octet_length("key") <= HOT_BYTES)
    hot, cold = F.broadcast(keys.where(often)), keys.where(~often)
    rest = suspects.join(hot.select("key"), "key", "left_anti").join(cold, "key")
    met = suspects.join(hot, "key").unionByName(rest)
    lost = met.where("id IS NULL OR id > first").groupBy("_file", "_row").agg(F.flatten(F.collect_list("lines")).alias("lines"))
    return lost


DROPPED = "_file bigint, _row bigint, n_dropped bigint, sha string, text string"


def without(content: DataFrame, lost: DataFrame, keep_text: bool) -> DataFrame:
    """Documents of ``lost`` without their lines, joined by \\n."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts, lists = strings(part.column("text")), part.column("lines")
                dropped = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                split = pc.split_pattern(texts, "\n")
                starts = split.offsets.to_numpy().astype(np.int64)
                starts -= starts[0]
                stay = np.ones(starts[-1], bool)
                stay[lists.flatten().to_numpy().astype(np.int64) + np.repeat(starts[:-1], dropped)] = False
                ends = np.r_[0, np.cumsum(stay)][starts]
                kept = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), split.flatten().filter(pa.array(stay)))
                whole = pc.binary_join(kept, "\n")
                sha = [hashlib.sha256(t).hexdigest() for t in whole.cast(pa.binary()).to_pylist()]
                columns = [part.column("_file"), part.column("_row"), pa.array(dropped, pa.int64()), pa.array(sha, pa.string()), whole if keep_text else pa.nulls(len(sha), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["_file", "_row", "n_dropped", "sha", "text"])

    texts = may_hold(content.select("_file", "_row", "text"), lost, "_file", "_row")
    # Sorted and merged at every size, so that cost follows the input; rows spill.
    return texts.join(lost.hint("merge"), ["_file", "_row"]).mapInArrow(cut, DROPPED)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", most_bits: int = MOST_BITS, keep_text: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_lines, n_dropped, kept_sha256; with ``keep_text`` also the text that is left."""
    whole = located(docs.select(docs[key], docs[text]))
    content = whole.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"), "_file", "_row")
    bits = filter_bits(content, most_bits)
    twice = np.zeros((-(-bits // 8 // PIECE), min(PIECE, bits // 8)), np.uint8)
    for row in filters(content, bits).select("piece", "twice").collect():  # MOST_BITS at most
        twice[row["piece"]] = np.frombuffer(row["twice"], np.uint8)
    seen = store(suspected(content, bits, twice.tobytes()), "lines")
    suspects = seen.select("id", "_file", "_row", F.explode("suspects").alias("x")).select("id", "_file", "_row", "x.key", "x.lines")
    lost = store(to_drop(suspects), "lost-lines")
    changed = without(content, lost, keep_text)
    at = ["_file", "_row"]
    out = seen.select("id", *at, "n_lines", F.col("sha").alias("whole")).join(changed.drop("text"), at, "left").select(
        F.col("id").alias("doc_id"), *at, "n_lines", F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"), F.coalesce("sha", "whole").alias("kept_sha256")
    )
    if keep_text:
        same = content.join(lost, at, "left_anti").select(*at, F.coalesce("text", F.lit("")).alias("text"))
        out = out.join(changed.select(*at, "text").unionByName(same), at)
    return out.drop(*at)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: DuckDB SQL for the rows of ``op13_line_dedup``.
OP13_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
judged AS (SELECT doc_id, i, line, coalesce(k.doc_id > f.first, false) AS gone FROM keyed k LEFT JOIN firsts f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
