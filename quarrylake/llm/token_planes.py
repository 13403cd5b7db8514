"""Token ids as bit-plane shuffled binary files.

Documents are range-partitioned by key, tokenised in that order and cut into chunks at document
ends.  A chunk holds blocks of ``BLOCK`` ids; each block is transposed into byte planes (all
first bytes, all second bytes, ...) or bit planes, and each plane is compressed with zstandard.
Planes of zeros take no space, so the width of an id costs nothing.  Spark writes the chunks, so
any store that Spark reaches will do; the chunk index lies beside them and gives every chunk's
first position, so a reader finds an id range without touching other chunks.

    <path>/chunks   shard, chunk, doc_ids, lengths, n_ids, blob
    <path>/index    shard, chunk, first_doc, last_doc, n_docs, n_ids, n_bytes, start

Blob: "QBP1", u8 planes per id, u8 bits (1: bit planes), u32 block size, u64 ids; then for each block
and plane a u32 length (0: all zero) and that many bytes of zstandard frame.

Rows: a null text counts as empty and yields the end id alone.  A null key sorts first; rows of
one key are ordered by text, equal rows in any order.  An empty table gives an empty result.
Other columns are never read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, slices, strings
from .tokens import word_ids

MAGIC = b"QBP1"
HEAD = struct.Struct("<4sBBIQ")
BLOCK = 1 << 16
CHUNK_IDS = 1 << 20


def planes_of(block: np.ndarray, bits: bool) -> list[np.ndarray]:
    """The transposed planes of a block of uint32 ids, least significant first."""
    by_byte = np.ascontiguousarray(block.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T)
    if not bits:
        return list(by_byte)
    return [np.packbits((plane >> b) & 1) for plane in by_byte for b in range(8)]


def block_of(planes: list[np.ndarray | None], n: int, bits: bool) -> np.ndarray:
    """The inverse of ``planes_of``; None is a plane of zeros."""
    by_byte = np.zeros((n, 4), np.uint8)
    for i, plane in enumerate(planes):
        if plane is None:
            continue
        if bits:
            by_byte[:, i // 8] |= np.unpackbits(plane, count=n) << np.uint8(i % 8)
        else:
            by_byte[:, i] = plane
    return by_byte.view("<u4").reshape(-1)


def encode_chunk(ids: np.ndarray, bits: bool = False, block: int = BLOCK, level: int = 3) -> bytes:
    press = zstandard.ZstdCompressor(level=level)
    parts = [HEAD.pack(MAGIC, 32 if bits else 4, bits, block, len(ids))]
    for a in range(0, len(ids), block):
        for plane in planes_of(ids[a : a + block], bits):
            frame = press.compress(plane.tobytes()) if plane.any() else b""
            parts += [struct.pack("<I", len(frame)), frame]
    return b"".join(parts)


def decode_chunk(blob: bytes) -> np.ndarray:
    magic, planes, bits, block, n = HEAD.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a token chunk")
    expand, at, out = zstandard.ZstdDecompressor(), HEAD.size, []
    for a in range(0, n, block):
        got: list[np.ndarray | None] = []
        for _ in range(planes):
            (size,) = struct.unpack_from("<I", blob, at)
            frame = blob[at + 4 : at + 4 + size]
            got.append(np.frombuffer(expand.decompress(frame), np.uint8) if size else None)
            at += 4 + size
        out.append(block_of(got, min(block, n - a), bool(bits)))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text",
    end: int = 2, bits: bool = False, chunk_ids: int = CHUNK_IDS,
) -> None:
    """Tokenise ``docs`` in ascending key order and write chunks and index under ``path``."""
    spark = docs.sparkSession
    kind = pa.int64()
    schema = "shard int, chunk int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, blob binary"

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, number = word_ids(tokenizer), TaskContext.get().partitionId(), 0
        names, parts, lengths, held = [], [], [], 0

        def full():
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()), pa.array([number], pa.int32()),
                    pa.array([names], pa.list_(kind)), pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([len(ids)], pa.int64()), pa.array([encode_chunk(ids, bits)], pa.binary()),
                ],
                names=["shard", "chunk", "doc_ids", "lengths", "n_ids", "blob"],
            )

        for batch in batches:
            for part in slices(batch, "text"):
                ids, offsets = encoder.encode(strings(part.column("text")), end)
                names += part.column("id").to_pylist()
                lengths += np.diff(offsets).tolist()
                parts.append(ids)
                held += len(ids)
                if held >= chunk_ids:
                    yield full()
                    names, parts, lengths, held, number = [], [], [], 0, number + 1
        if names:
            yield full()

    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    rows.mapInArrow(chunks, schema).write.parquet(f"{path}/chunks")

    stored = spark.read.schema(schema).parquet(f"{path}/chunks")
    index = stored.select(
        "shard", "chunk", F.get("doc_ids", F.lit(0)).alias("first_doc"), F.try_element_at("doc_ids", F.lit(-1)).alias("last_doc"),
        F.size("doc_ids").alias("n_docs"), "n_ids", F.octet_length("blob").alias("n_bytes"),
    )
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("shard_ids"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    shards = shards.select("shard", F.coalesce(F.sum("shard_ids").over(upto), F.lit(0)).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    index.join(shards, "shard").withColumn(
        "start", F.col("shard_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))
    ).drop("shard_start").write.parquet(f"{path}/index")


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32 (and ids)."""
    schema = "shard int, chunk int, doc_id bigint, first bigint, n_tokens bigint, ids_crc32 bigint"
    schema += ", ids array<bigint>" if with_ids else ""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, sizes = decode_chunk(row["blob"]), np.array(row["lengths"], np.int64)
                ends = np.cumsum(sizes)
                crcs = [zlib.crc32(ids[b - n : b]) for b, n in zip(ends.tolist(), sizes.tolist())]
                columns = [
                    pa.array([row["shard"]] * len(ends), pa.int32()), pa.array([row["chunk"]] * len(ends), pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()), pa.array(ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.r_[0, ends].astype(np.int32), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in schema.split(", ")])

    stored = spark.read.parquet(f"{path}/chunks").select("shard", "chunk", "doc_ids", "lengths", "blob")
    index = spark.read.parquet(f"{path}/index").select("shard", "chunk", F.col("start").alias("chunk_start"))
    found = stored.mapInArrow(documents, schema).join(index, ["shard", "chunk"])
    return found.select(
        "doc_id", (F.col("chunk_start") + F.col("first")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )


def op5_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch(spark, "tokens")
    write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(spark, path)
