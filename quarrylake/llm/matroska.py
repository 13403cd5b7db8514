"""Matroska as a media column: write and parse EBML, and turn files into packet tables.

``encode`` stores bytes as the samples of an 8-bit PCM track: frames of ``FRAME`` samples, laced
into simple blocks, blocks gathered in clusters, and cues that point at the clusters.  ``parse``
reads any Matroska bytes: variable-length ids and sizes (unknown sizes too), clusters with simple
blocks and block groups, Xiph, EBML and fixed-size lacing, and cues; it yields one packet for each
frame with track, timestamp and byte range, so samples are fetched without copying the file.

Rows: a null text counts as empty.  A payload is padded with spaces to a positive multiple of
``FRAME``, so an empty text gives one frame.  Equal texts give equal bytes.  Rows of one key each
give a row; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

FRAME, RATE, LACED, BLOCKS = 192, 8000, 8, 24

# Element ids as the Matroska specification (RFC 9559) fixes them.
EBML, SEGMENT, INFO, TRACKS, CLUSTER, CUES = 0x1A45DFA3, 0x18538067, 0x1549A966, 0x1654AE6B, 0x1F43B675, 0x1C53BB6B
TRACK_ENTRY, AUDIO, BLOCK_GROUP, CUE_POINT, CUE_POSITIONS = 0xAE, 0xE1, 0xA0, 0xBB, 0xB7
DOC_TYPE, SCALE, DURATION = 0x4282, 0x2AD7B1, 0x4489
TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC, LACING = 0xD7, 0x73C5, 0x83, 0x86, 0x9C
FRAME_DURATION, RATE_ID, CHANNELS, DEPTH = 0x23E383, 0xB5, 0x9F, 0x6264
TIMESTAMP, SIMPLE_BLOCK, BLOCK = 0xE7, 0xA3, 0xA1
CUE_TIME, CUE_TRACK, CUE_CLUSTER = 0xB3, 0xF7, 0xF1
MASTERS = {SEGMENT, INFO, TRACKS, CLUSTER, CUES, TRACK_ENTRY, AUDIO, BLOCK_GROUP, CUE_POINT, CUE_POSITIONS}
TOP = {INFO, TRACKS, CLUSTER, CUES, 0x114D9B74, 0x1043A770, 0x1254C367, 0x1941A469}


def size_of(n: int, width: int = 0) -> bytes:
    """A data size in the fewest bytes (or ``width``); all ones are kept for 'unknown'."""
    width = width or next(w for w in range(1, 9) if n < (1 << 7 * w) - 1)
    return (n | 1 << 7 * width).to_bytes(width, "big")


def element(name: int, body: bytes) -> bytes:
    return name.to_bytes((name.bit_length() + 7) // 8, "big") + size_of(len(body)) + body


def number(name: int, n: int) -> bytes:
    return element(name, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def lace(frames: list[bytes], kind: int) -> bytes:
    """The frames of one block; kind 0 none, 1 Xiph, 2 fixed size, 3 EBML."""
    if kind == 0:
        (frame,) = frames
        return frame
    head = bytes([len(frames) - 1])
    sizes = [len(f) for f in frames]
    if kind == 1:
        head += b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1])
    elif kind == 3 and len(frames) > 1:
        head += size_of(sizes[0])
        for a, b in zip(sizes, sizes[1:-1]):
            width = next(w for w in range(1, 9) if abs(b - a) < (1 << 7 * w - 1) - 1)
            head += size_of(b - a + (1 << 7 * width - 1) - 1, width)
    return head + b"".join(frames)


def encode(payload: bytes, frame: int = FRAME, kind: int = 2) -> bytes:
    """A Matroska file whose only track holds ``payload`` as 8-bit samples."""
    info = element(INFO, number(SCALE, 1_000_000) + element(DURATION, struct.pack(">d", len(payload) * 1000 / RATE)))
    sound = element(RATE_ID, struct.pack(">d", RATE)) + number(CHANNELS, 1) + number(DEPTH, 8)
    track = number(TRACK_NUMBER, 1) + number(TRACK_UID, 1) + number(TRACK_TYPE, 2) + number(LACING, int(kind > 0))
    track += number(FRAME_DURATION, frame * 1_000_000_000 // RATE)
    track += element(CODEC, b"A_PCM/INT/LIT") + element(AUDIO, sound)
    parts = [info, element(TRACKS, element(TRACK_ENTRY, track))]
    at, cues, laced = sum(map(len, parts)), [], LACED if kind else 1
    per_block = frame * laced
    for a in range(0, len(payload), per_block * BLOCKS):
        base, body = a * 1000 // RATE, []
        body.append(number(TIMESTAMP, base))
        for b in range(a, min(len(payload), a + per_block * BLOCKS), per_block):
            cut = payload[b : b + per_block]
            frames = [cut[i : i + frame] for i in range(0, len(cut), frame)]
            way = 0 if len(frames) == 1 else 1 if kind == 2 and len(frames[-1]) < frame else kind
            head = b"\x81" + struct.pack(">hB", b * 1000 // RATE - base, 0x80 | way << 1)
            body.append(element(SIMPLE_BLOCK, head + lace(frames, way)))
        cluster = element(CLUSTER, b"".join(body))
        cues.append(element(CUE_POINT, number(CUE_TIME, base) + element(CUE_POSITIONS, number(CUE_TRACK, 1) + number(CUE_CLUSTER, at))))
        parts.append(cluster)
        at += len(cluster)
    parts.append(element(CUES, b"".join(cues)))
    header = number(0x4286, 1) + number(0x42F7, 1) + number(0x42F2, 4) + number(0x42F3, 8)
    header += element(DOC_TYPE, b"matroska") + number(0x4287, 4) + number(0x4285, 2)
    return element(EBML, header) + element(SEGMENT, b"".join(parts))


class Packet(NamedTuple):
    track: int
    timestamp: int  # in the segment's scale; of a lace's later frames by the track's frame duration
    start: int
    length: int
    cluster: int


class Media(NamedTuple):
    doc_type: str
    scale: int
    duration: float
    tracks: dict[int, dict]
    packets: list[Packet]
    cues: list[tuple[int, int, int]]  # time, track, position of the cluster in the file
    clusters: list[int]


def read_id(data: bytes, at: int) -> tuple[int, int]:
    width = 9 - data[at].bit_length()
    if width > 4:
        raise ValueError(f"no element id at byte {at}")
    return int.from_bytes(data[at : at + width], "big"), at + width


def read_size(data: bytes, at: int) -> tuple[int | None, int]:
    """A size (None: unknown) and where its data begin."""
    width = 9 - data[at].bit_length()
    if width > 8:
        raise ValueError(f"no element size at byte {at}")
    n = int.from_bytes(data[at : at + width], "big") & (1 << 7 * width) - 1
    return (None if n == (1 << 7 * width) - 1 else n), at + width


def frames_of(data: bytes, at: int, end: int) -> tuple[int, int, list[tuple[int, int]]]:
    """Track, relative timestamp and the byte ranges of a block's frames."""
    track, at = read_size(data, at)
    time, flags = struct.unpack_from(">hB", data, at)
    at += 3
    kind = flags >> 1 & 3
    if kind == 0:
        return track, time, [(at, end - at)]
    count, at, sizes = data[at] + 1, at + 1, []
    if kind == 2:
        sizes = [(end - at) // count] * count
    elif kind == 1:
        for _ in range(count - 1):
            n = 0
            while data[at] == 255:
                n, at = n + 255, at + 1
            sizes.append(n + data[at])
            at += 1
    else:
        for i in range(count - 1):
            width = 9 - data[at].bit_length()
            n, at = read_size(data, at)
            sizes.append(n if i == 0 else sizes[-1] + n - ((1 << 7 * width - 1) - 1))
    if kind != 2:
        sizes.append(end - at - sum(sizes))
    ranges = []
    for n in sizes:
        ranges.append((at, n))
        at += n
    if at != end or min(sizes) < 0:
        raise ValueError("a lace does not fill its block")
    return track, time, ranges


def parse(data: bytes) -> Media:
    doc_type, scale, duration, base, segment = "", 1_000_000, 0.0, 0, 0
    tracks: dict[int, dict] = {}
    packets, cues, clusters, track, cue = [], [], [], {}, [0, 0, 0]
    stack, at = [(0, len(data))], 0
    while at < len(data):
        while len(stack) > 1 and at >= stack[-1][1]:
            stack.pop()
        name, body = read_id(data, at)
        size, body = read_size(data, body)
        if name in TOP:  # ends a cluster of unknown size
            while len(stack) > 1 and stack[-1][0] == CLUSTER:
                stack.pop()
        end = stack[-1][1] if size is None else body + size
        if end > len(data):
            raise ValueError("an element is cut off")
        if name in MASTERS or name == EBML:
            stack.append((name, end))
            if name == SEGMENT:
                segment = body
            elif name == CLUSTER:
                clusters.append(at)
            elif name == TRACK_ENTRY:
                track = {}
            at = body
            continue
        if name in (SIMPLE_BLOCK, BLOCK):
            number_, time, ranges = frames_of(data, body, end)
            step = tracks.get(number_, {}).get("frame_ns", 0)
            packets += [Packet(number_, base + time + i * step // scale, a, n, len(clusters) - 1) for i, (a, n) in enumerate(ranges)]
        elif name in (DOC_TYPE, CODEC):
            value = data[body:end].decode("ascii")
            if name == DOC_TYPE:
                doc_type = value
            else:
                track["codec"] = value
        elif name in (DURATION, RATE_ID):
            (value,) = struct.unpack(">d" if size == 8 else ">f", data[body:end])
            if name == DURATION:
                duration = value
            else:
                track["rate"] = value
        elif name in (SCALE, TIMESTAMP, TRACK_NUMBER, TRACK_TYPE, FRAME_DURATION, CHANNELS, DEPTH, CUE_TIME, CUE_TRACK, CUE_CLUSTER):
            value = int.from_bytes(data[body:end], "big")
            if name == SCALE:
                scale = value
            elif name == TIMESTAMP:
                base = value
            elif name == TRACK_NUMBER:
                tracks[value] = track
            elif name == CUE_TIME:
                cue = [value, 0, 0]
            elif name == CUE_TRACK:
                cue[1] = value
            elif name == CUE_CLUSTER:
                cues.append((cue[0], cue[1], segment + value))
            else:
                track[{TRACK_TYPE: "type", FRAME_DURATION: "frame_ns", CHANNELS: "channels", DEPTH: "depth"}[name]] = value
        at = end
    return Media(doc_type, scale, duration, tracks, packets, cues, clusters)


def payload_of(text: bytes) -> bytes:
    return text.ljust(max(1, -(-len(text) // FRAME)) * FRAME, b" ")


def media_column(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, media (Matroska bytes)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(map(len, bodies), pa.int64()), pa.array([encode(payload_of(x)) for x in bodies], pa.binary())],
                names=["doc_id", "n_bytes", "media"],
            )

    rows_in = docs.select(docs[key].cast("long").alias("id"), docs[text].cast("string").alias("text"))
    return rows_in.mapInArrow(rows, "doc_id bigint, n_bytes bigint, media binary")


def packets(media: DataFrame) -> DataFrame:
    """The packet table of a media column: one row for each frame."""
    names = ["doc_id", "cluster", "track", "timestamp_ns", "start", "length", "cue"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, blob in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist()):
                if blob is None:
                    continue
                m = parse(blob)
                cued = {at for _, _, at in m.cues}
                if m.packets:
                    track, time, start, length, cluster = zip(*m.packets)
                    columns = [[doc] * len(track), cluster, track, [t * m.scale for t in time], start, length]
                    arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array([m.clusters[c] in cued for c in cluster])]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id bigint, cluster bigint, track bigint, timestamp_ns bigint, start bigint, length bigint, cue boolean"
    return media.select("doc_id", "media").mapInArrow(rows, schema)


def describe(blob: bytes) -> tuple[int, str, int, int, str, str]:
    """Read a stored file back: payload's size, digest and tail, the file's, and a feature."""
    m = parse(blob)
    payload = b"".join([blob[p.start : p.start + p.length] for p in m.packets])
    samples = np.frombuffer(payload, np.uint8).astype(np.float64) - 128
    cued = sum(m.clusters.count(at) for _, _, at in m.cues)
    feature = (
        f"{m.doc_type};{m.tracks[1]['codec']};{m.tracks[1]['rate']:.0f}Hz;{m.duration:.0f}ms;packets={len(m.packets)};"
        f"clusters={len(m.clusters)};cues={cued};last={m.packets[-1].timestamp}ms;rms={np.sqrt(np.mean(samples**2)):.3f};"
        f"peak={int(np.abs(samples).max())}"
    )
    return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(blob), hashlib.sha256(blob).hexdigest(), feature)


def features(media: DataFrame) -> DataFrame:
    schema = (
        "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, "
        "media_bytes bigint, media_sha256 string, feature string"
    )
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [describe(blob) for blob in batch.column("media").to_pylist()]
            columns = list(zip(*found)) if found else [[]] * 6
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *arrays], names=[x.split()[0] for x in schema.split(", ")])

    return media.mapInArrow(rows, schema)


def op8_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(media_column(spark.read.parquet(f"{sf_dir}/documents.parquet")))
