"""Language identification by a bidirectional gated recurrent network over bytes.

The network (two gated recurrent units, one for each direction, and a linear layer) is trained in
numpy by backpropagation through time on windows of a bounded sample of labelled documents.  It
labels every byte of every text; a document's language is the one with the largest mean
probability over its bytes.  Texts run through it in segments of ``SEGMENT`` bytes, many side by
side, so a very long text costs no more memory than a short one.  A segment also reads ``WARM`` bytes of its
text on either side, whose labels are left to its neighbours: as many as training windows have, so no
byte is labelled without what stands around it.

Rows: a null text or one without a letter is ``und`` with score 0.  Rows of one key each give a
row.  An empty table, or one without any label, gives ``und`` for all.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ragged, slices, small, strings

#: Bound of the training sample: labelled documents for each language; parts of each, drawn from the whole text, and their characters.
SAMPLE_DOCS, PARTS, PART_CHARS = 150, 24, 80
HIDDEN, WINDOW, BATCH, STEPS = 8, 64, 64, 300
#: Bytes that a segment labels, bytes before and after it over which its states warm up, and segments that run side by side.
SEGMENT, WARM, SIDE_BY_SIDE = 384, 64, 1024


def _logistic(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


@dataclass
class Gru:
    """One direction: reset, update and candidate for each byte value, and recurrent weights."""

    inputs: np.ndarray  # 256 x 3H
    recurrent: np.ndarray  # H x 3H

    @classmethod
    def new(cls, hidden: int, rng: np.random.Generator) -> Gru:
        return cls(rng.normal(0, 0.3, (256, 3 * hidden)).astype("f4"), rng.normal(0, 0.3, (hidden, 3 * hidden)).astype("f4"))

    def run(self, text: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States for bytes ``text`` (time x batch); ``trace`` keeps what training needs."""
        hidden = self.recurrent.shape[0]
        states = np.empty((*text.shape, hidden), np.float32)
        h = np.zeros((text.shape[1], hidden), np.float32)
        # Gates and candidate lie apart, each in one piece of memory.
        kind, count = self.inputs.dtype, text.shape[1]
        in_gates, in_candidate = (np.ascontiguousarray(x) for x in (self.inputs[:, : 2 * hidden], self.inputs[:, 2 * hidden :]))
        to_gates, to_candidate = (np.ascontiguousarray(x) for x in (self.recurrent[:, : 2 * hidden], self.recurrent[:, 2 * hidden :]))
        gates, candidate = np.empty((count, 2 * hidden), kind), np.empty((count, hidden), kind)
        back_gates, back = np.empty_like(gates), np.empty_like(candidate)
        for t, column in enumerate(text):
            np.take(in_gates, column, axis=0, out=gates, mode="clip")
            np.take(in_candidate, column, axis=0, out=candidate, mode="clip")
            gates += np.matmul(h, to_gates, out=back_gates)
            np.matmul(h, to_candidate, out=back)
            _logistic(gates)
            if trace is not None:
                kept = back.copy()
            back *= gates[:, :hidden]
            candidate += back
            np.tanh(candidate, out=candidate)
            if trace is not None:
                trace.append((h, gates.copy(), candidate.copy(), kept))
            new = states[t]
            np.subtract(h, candidate, out=new)
            new *= gates[:, hidden:]
            new += candidate
            h = new
        return states

    def back(self, text: np.ndarray, trace: list, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of both weights by backpropagation through time; ``wanted`` is by state."""
        hidden = self.recurrent.shape[0]
        d_in, d_rec = np.zeros_like(self.inputs), np.zeros_like(self.recurrent)
        carry = np.zeros_like(wanted[0])
        for t in range(len(text) - 1, -1, -1):
            h, gates, candidate, back = trace[t]
            r, z = gates[:, :hidden], gates[:, hidden:]
            d = carry + wanted[t]
            d_candidate = d * (1 - z) * (1 - candidate**2)
            d_z = d * (h - candidate) * z * (1 - z)
            d_r = d_candidate * back * r * (1 - r)
            d_given = np.concatenate([d_r, d_z, d_candidate], axis=1)
            d_back = np.concatenate([d_r, d_z, d_candidate * r], axis=1)
            np.add.at(d_in, text[t], d_given)
            d_rec += h.T @ d_back
            carry = d * z + d_back @ self.recurrent.T
        return d_in, d_rec


@dataclass
class Network:
    languages: list[str]
    ahead: Gru
    behind: Gru
    out: np.ndarray  # 2H x K
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.inputs, self.ahead.recurrent, self.behind.inputs, self.behind.recurrent, self.out, self.bias]

    def gradients(self, text: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy over all positions; ``text`` is time x batch."""
        hidden, traces = self.out.shape[0] // 2, ([], [])
        fwd = self.ahead.run(text, traces[0])
        bwd = self.behind.run(text[::-1], traces[1])[::-1]
        both = np.concatenate([fwd, bwd], axis=2)
        p = _softmax(both @ self.out + self.bias)
        p[:, np.arange(text.shape[1]), label] -= 1
        p /= text.size
        d_out = both.reshape(-1, 2 * hidden).T @ p.reshape(-1, p.shape[2])
        wanted = p @ self.out.T
        a = self.ahead.back(text, traces[0], wanted[:, :, :hidden])
        b = self.behind.back(text[::-1], traces[1], wanted[::-1, :, hidden:])
        return [*a, *b, d_out, p.sum((0, 1))]

    def label(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities (languages x bytes) of all bytes of some segments, one after another."""
        hidden, longest, count = self.out.shape[0] // 2, int(lengths.max()), len(starts)
        at = np.arange(longest)
        even = bool((lengths == longest).all())
        inside = at < lengths[:, None]
        ahead = data[starts[:, None] + at if even else np.where(inside, starts[:, None] + at, 0)]
        if even:
            behind = ahead[:, ::-1]
        else:
            behind = data[np.where(inside, (starts + lengths - 1)[:, None] - at, 0)]
        both = []
        for gru, text, out in ((self.ahead, ahead, self.out[:hidden]), (self.behind, behind, self.out[hidden:])):
            states = gru.run(np.ascontiguousarray(text.T)).reshape(-1, hidden)
            both.append((out.T @ states.T).reshape(-1, longest, count).transpose(0, 2, 1))
        if even:
            s = (both[0] + both[1][:, :, ::-1]).reshape(len(self.bias), -1)
        else:
            segment = np.repeat(np.arange(count), lengths)
            place = np.arange(len(segment)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            s = both[0][:, segment, place] + both[1][:, segment, lengths[segment] - 1 - place]
        s += self.bias[:, None]
        s -= s.max(axis=0)
        np.exp(s, out=s)
        s /= s.sum(axis=0)
        return s


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


def train(texts: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = STEPS, seed: int = 0) -> Network:
    """Train by backpropagation through time with Adam; windows are drawn evenly by language."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    net = Network(
        names, Gru.new(hidden, rng), Gru.new(hidden, rng),
        rng.normal(0, 0.3, (2 * hidden, len(names))).astype("f4"), np.zeros(len(names), "f4"),
    )
    by = [[np.frombuffer(t, np.uint8) for t, x in zip(texts, labels) if x == name and t] for name in names]
    weights = net.weights()
    mean, square = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    usable = [k for k, group in enumerate(by) if group]
    for step in range(1, steps + 1 if usable else 1):
        label = np.array([usable[i % len(usable)] for i in range(max(BATCH, len(usable)))])
        text = np.zeros((WINDOW, len(label)), np.uint8)
        for i, k in enumerate(label):
            doc = by[k][rng.integers(len(by[k]))]
            a = rng.integers(max(1, len(doc) - WINDOW + 1))
            cut = doc[a : a + WINDOW]
            text[:, i] = np.resize(cut, WINDOW)
        rate = 0.02 * (1 - step / (steps + 1))
        for w, m, s, g in zip(weights, mean, square, net.gradients(text, label)):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)).astype("f4")
    return net


def label_texts(net: Network, texts: pa.Array, spans: bool = False) -> tuple[np.ndarray, list]:
    """Mean probabilities (texts x languages), and on demand runs (start, end, language) of bytes."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    data = np.frombuffer(b"".join(texts.cast(pa.binary()).to_pylist()) or b"\0", np.uint8)
    parts = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(sizes)), parts)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * SEGMENT
    # Each segment labels its own bytes; ``before`` and ``after`` count those that it only reads.
    own = np.minimum(SEGMENT, sizes[owner] - offset)
    before, after = np.minimum(WARM, offset), np.minimum(WARM, sizes[owner] - offset - own)
    starts, lengths = (np.cumsum(sizes) - sizes)[owner] + offset - before, before + own + after
    order = np.argsort(-lengths, kind="stable")  # whole segments run without padding
    total, runs = np.zeros((len(sizes), len(net.languages))), [[] for _ in sizes]
    whole = int((lengths == SEGMENT + 2 * WARM).sum())
    cuts = [*range(0, whole, SIDE_BY_SIDE), *range(whole, len(order), SIDE_BY_SIDE)]
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        these = order[a:b]
        n = own[these]
        read = np.cumsum(lengths[these]) - lengths[these]
        p = net.label(data, starts[these], lengths[these])[:, ragged(read + before[these], n)]
        first = np.cumsum(n) - n
        np.add.at(total, owner[these], np.add.reduceat(p, first, axis=1).T)
        if spans:
            best = p.argmax(axis=0)
            for i, k in enumerate(these):
                here = best[first[i] : first[i] + n[i]]
                turns = np.r_[0, np.flatnonzero(np.diff(here)) + 1, len(here)]
                runs[owner[k]] += [(int(offset[k] + x), int(offset[k] + y), net.languages[here[x]]) for x, y in zip(turns[:-1], turns[1:])]
    return total / np.maximum(sizes, 1)[:, None], [_merged(sorted(r)) for r in runs]


def _merged(runs: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    for a, b, name in runs:
        if out and out[-1][2] == name:
            out[-1] = (out[-1][0], b, name)
        else:
            out.append((a, b, name))
    return out


def sample(docs: DataFrame, seed: int = 7, key: str = "doc_id", text: str = "text", lang: str = "lang") -> list:
    """Parts of at most about ``SAMPLE_DOCS`` documents of each language: (lang, part), in a fixed order.

    A document is drawn by its hash; its ``PARTS`` start at hashed places anywhere in its text.  Any
    number of languages will do.
    """
    rows = docs.where(docs[lang].isNotNull() & docs[text].isNotNull()).select(docs[lang].alias("lang"), docs[text].alias("text"), docs[key].alias("id"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30))
    drawn = small(counts.select("lang", (F.lit(float(SAMPLE_DOCS)) / F.col("n")).alias("share")))
    picked = rows.join(drawn, "lang").where(draw < F.least(F.col("share"), F.lit(1.0)) * (1 << 30))
    places = F.greatest(F.length("text") - PART_CHARS, F.lit(0)) + 1
    parts = F.transform(
        F.sequence(F.lit(1), F.least(F.lit(PARTS), places)),
        lambda i: F.substr("text", (F.pmod(F.xxhash64("id", F.lit(seed), i), places) + 1).cast("int"), F.lit(PART_CHARS)),
    )
    return sorted(tuple(r) for r in picked.select("lang", F.explode(parts).alias("part")).collect())


def identify(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text", spans: bool = False) -> DataFrame:
    """Per row: doc_id, lang_pred, score (and spans of bytes by language)."""
    schema = "doc_id bigint, lang_pred string, score double" + (", spans array<struct<start:bigint,end:bigint,lang:string>>" if spans else "")
    has_letter = F.coalesce(docs[text].rlike(r"\p{L}"), F.lit(False))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                letter = part.column("letter").to_numpy(zero_copy_only=False).astype(bool)
                if net is None:
                    p, runs, names = np.zeros((len(letter), 1)), [[]] * len(letter), np.array(["und"])
                else:
                    p, runs = label_texts(net, strings(part.column("text")), spans)
                    names = np.array(net.languages)
                columns = [part.column("id"), pa.array(np.where(letter, names[p.argmax(1)], "und").tolist(), pa.string())]
                columns.append(pa.array(np.clip(np.where(letter, p.max(1), 0.0), 0, 1)))
                if spans:
                    made = [[{"start": a, "end": b, "lang": x} for a, b, x in r] for r in runs]
                    columns.append(pa.array(made, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "spans"][: len(columns)])

    return docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"), has_letter.alias("letter")).mapInArrow(rows, schema)


def remainder(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo ``n``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % n


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    drawn = sample(docs.where(remainder(docs["doc_id"], 4) != 2))
    net = train([t.encode() for _, t in drawn], [x for x, _ in drawn]) if drawn else None
    found = identify(docs, net)
    return found.select("doc_id", (remainder(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")
