"""Toxicity scores of texts that a noisy channel may have disguised.

Disguised words (leetspeak, spelled-out or separated letters, repeated letters) are restored
first.  Each character stands for one or more letters, or for none, at a cost; these choices make
a lattice, and Viterbi decoding under a character language model picks the likeliest letters.  A
word without such characters has a lattice of one path and is its own restoration.  Three or more
pieces of at most two characters (besides marks) in a row are decoded as one run too.  The restored
text is scored by log odds of its distinct words (or their most specific known beginnings), which
are learnt from labels and calibrated by a logistic model.

The language model and its vocabulary are counted over the words of all documents (no labels are
read for that) and are kept as arrays by 64-bit hashes of words and n-grams, 12 bytes each.  Only
the weights and their calibration are learnt from a bounded, documented sample of labelled documents
(``SAMPLE_ROWS``), whole texts of it; features are counted by Spark, and the driver gets their counts
and one number a document.  Scoring reads every word of every text, each distinct word once for each
batch; only words that may be read as one with a known beginning go through the lattice.

Rows: a null or empty text gets the score of a text without any known word.  Rows of one key each
give a row; an empty table gives an empty result.  Without labels of both kinds all scores are 0.
Null labels are not learnt from; of several labels of one key each counts.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ragged, slices, store, strings, words
from .language_id import remainder

#: Bounds: labelled documents that weights are learnt from, features of the model, words a worker remembers.
SAMPLE_ROWS, FEATURES, CACHE_WORDS = 6_000, 1500, 300_000
#: Costs a worker remembers; words and runs up to this length are tested by a pattern before they are decoded.
CACHE_COSTS, TESTED = 1_000_000, 60
ORDER = 4
BEGIN = "^" * (ORDER - 1)
#: Evidence beyond this adds nothing, so a long text is judged as a short one.
MOST = 15.0
#: What a character may stand for besides itself, and the cost of each reading in nats.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "§": "s",
}
READ, DROP_MARK, DROP_REPEAT, HIDDEN = 0.5, 0.7, 0.3, 3.0
#: Marks that may separate letters, and marks that may also hide one.
MARKS, MASKS = set(".-_*~'`^,:;/\\=#%&|+ ​"), set("*#%")
VOWELS = "aeiou"
EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
#: Money signs hardly stand beside letters by themselves: what dropping one costs.
MONEY, DROP_MONEY = set("$€£§"), 6.0
#: Edges that words are counted without; others may stand for letters.
COUNTED_EDGE = "".join(c for c in EDGE if c not in "$@")
#: Signs at the edges that may stand for a letter or hide one.
SIGNS = {c for c in LEET if not c.isdigit()} | MASKS
#: Letters only, but one of them repeated; and three times in a row.
REPEATED, TRIPLE = re.compile(r"(.)\1"), re.compile(r"(.)\1\1")
#: Of two known words, a double letter's word is read with a single one if that is likelier by this (nats).
STRETCHED = 7.0
#: A run is of pieces with at most so many characters besides the marks at their edges.
PIECE = 2
PIECE_EDGE = "".join(c for c in EDGE if c not in LEET)
#: Paths that a run of pieces keeps in each state (they differ in where their last words begin), and
#: the cost of joining two pieces.
RUN_PATHS, JOIN = 8, 0.3


def hashed(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass"))


class Table:
    """Numbers by the hashes of their names: two arrays, sorted by hash, and where each first 16 bits begin."""

    def __init__(self, hashes: np.ndarray, values: np.ndarray):
        hashes = hashes.view(np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.values = hashes[order], values[order].astype(np.float32)
        self._index()

    def _index(self) -> None:
        bounds = np.searchsorted(self.hashes, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48))
        self.starts = [*bounds.tolist(), len(self.hashes)]
        self.sorted = memoryview(self.hashes)

    def __getstate__(self) -> tuple[np.ndarray, np.ndarray]:
        return self.hashes, self.values

    def __setstate__(self, state: tuple[np.ndarray, np.ndarray]) -> None:
        self.hashes, self.values = state
        self._index()

    def get(self, name: str, default: float | None = None) -> float | None:
        h = hashed(name)
        a, b = self.starts[h >> 48], self.starts[(h >> 48) + 1]
        i = bisect_left(self.sorted, h, a, b)
        return float(self.values[i]) if i < b and self.sorted[i] == h else default

    def __contains__(self, name: str) -> bool:
        return self.get(name) is not None


def grams_of(word: str) -> Iterator[str]:
    """A word's n-grams, and their contexts as followed by anything."""
    padded = BEGIN + word + "$"
    for i in range(ORDER - 1, len(padded)):
        for k in range(ORDER):
            yield padded[i - k : i + 1]
            yield padded[i - k : i] + "\0"


@dataclass
class CharModel:
    """Interpolated character n-grams with a known vocabulary's bonus."""

    counts: dict[str, int] | Table = field(default_factory=dict)
    lexicon: dict[str, float] | Table = field(default_factory=dict)
    costs: dict[str, float] = field(default_factory=dict)

    @classmethod
    def of(cls, frequencies: Counter) -> CharModel:
        model, grams = cls(), Counter()
        total = sum(frequencies.values()) or 1
        for word, n in frequencies.items():
            for gram in grams_of(word) if word.isalpha() else ():
                grams[gram] += n
        model.counts = dict(grams)
        model.lexicon = {w: math.log(n / total) for w, n in frequencies.items() if n >= 2}
        return model

    def cost(self, context: str, letter: str) -> float:
        got = self.costs.get(context + letter)
        if got is None:
            p = 1e-4
            for k in range(ORDER):
                seen = self.counts.get(context[len(context) - k :] + "\0", 0)
                if not seen:
                    break
                p = (self.counts.get(context[len(context) - k :] + letter, 0) + 2.0 * p) / (seen + 2.0)
            if len(self.costs) >= CACHE_COSTS:
                self.costs.clear()
            got = self.costs[context + letter] = -math.log(p)
        return got


def inner(word: str) -> tuple[int, int]:
    """Where a word begins and ends without its edges' punctuation."""
    return len(word) - len(word.lstrip(EDGE)), len(word.rstrip(EDGE))


def readings(word: str, i: int, inside: tuple[int, int]) -> list[tuple[str, float]]:
    """What the character at ``i`` may stand for: (letters, cost); empty letters drop it."""
    c = word[i]
    found = [(x, READ) for x in LEET.get(c, "")]
    if c.isalpha():
        found.append((c, 0.0))
        if i and word[i - 1] == c:
            found.append(("", DROP_REPEAT))
    elif c in MARKS or c in LEET:
        edge = not c.isdigit() and not inside[0] <= i < inside[1]
        found.append(("", DROP_MONEY if c in MONEY else DROP_MARK if c in MARKS or edge else HIDDEN))
        if c in MASKS:
            found += [(v, HIDDEN) for v in VOWELS]
    else:
        found.append((c, 0.0) if c.isdigit() else ("", DROP_MARK))
    return found


#: A path's letters, the last first: (letters before, letters); None at a word's beginning.
Letters = tuple | None


def spelling(letters: Letters) -> str:
    out = []
    while letters:
        letters, last = letters
        out.append(last)
    return "".join(reversed(out))


def ended(cost: float, paid: float, context: str, out: str, model: CharModel) -> float:
    """A word's cost at its end: what was paid for its readings, and its letters' or the vocabulary's cost."""
    known = model.lexicon.get(out)
    return min(cost + model.cost(context, "$"), paid + 2.0 - known if known is not None else math.inf)


def restore(word: str, model: CharModel) -> str:
    """The likeliest letters of a lower-case word by Viterbi over its lattice, in time linear in its length."""
    # Each state's two best paths: cost, paid for readings, letters.  The second serves the vocabulary's choice at the end.
    paths: dict[str, list[tuple[float, float, Letters]]] = {BEGIN: [(0.0, 0.0, None)]}
    inside, known, cost_of = inner(word), model.costs, model.cost
    number = not any(map(str.isalpha, word))  # then every digit stands for a letter
    for i in range(len(word)):
        new: dict[str, list[tuple[float, float, Letters]]] = {}
        crowded = False
        for letter, price in readings(word, i, inside):
            if not letter and number and word[i].isdigit():
                continue
            for context, kept in paths.items():
                if letter:
                    to = context + letter
                    step = known.get(to)
                    step = price + (cost_of(context, letter) if step is None else step)
                    to = to[1:]
                    made = [(cost + step, paid + price, (out, letter)) for cost, paid, out in kept]
                else:
                    to = context
                    made = [(cost + price, paid + price, out) for cost, paid, out in kept]
                if to in new:
                    new[to] += made
                    crowded = True
                else:
                    new[to] = made
        if crowded:
            for to, made in new.items():
                if len(made) > 2:
                    new[to] = sorted(made, key=itemgetter(0))[:2]
        paths = new
    ends = []
    for context, kept in paths.items():
        for cost, paid, letters in kept:
            out = spelling(letters)
            ends.append((ended(cost, paid, context, out, model), out))
    return min(ends)[1] if ends else word


def features_of(word: str) -> list[str]:
    """The word and its beginnings, the most specific first."""
    return ["w:" + word] + [f"p:{word[:k]}" for k in (7, 6, 5, 4) if len(word) > k]


def evidence(word: str, names: dict) -> tuple[str, ...]:
    """The most specific known feature of a word: each word speaks once."""
    return next(((f,) for f in features_of(word) if f in names), ())


def spelled_out(flat: pa.Array, offsets: np.ndarray, kinds: np.ndarray) -> list[tuple[int, str]]:
    """Runs with three or more pieces, by each word's kind (``pieces_of``): (text, pieces with spaces)."""
    turns = np.flatnonzero(np.diff(np.r_[False, kinds > 0, False].astype(np.int8)))
    pieces = np.r_[0, np.cumsum(kinds == 1)]
    out = []
    for a, b in zip(turns[::2], turns[1::2]):
        if pieces[b] - pieces[a] < 3:
            continue
        text = int(np.searchsorted(offsets, a, side="right")) - 1
        while a < b:  # a run does not go on in the next text
            end = min(b, offsets[text + 1])
            if pieces[end] - pieces[a] >= 3:
                out.append((text, " ".join(flat.slice(a, end - a).to_pylist()).lower()))
            a, text = end, text + 1
    return out


class Scorer:
    """What workers need: the character model and the weights of known features."""

    def __init__(self, model: CharModel, weights: dict[str, float], bias: float, scale: float = 1.0):
        self.model, self.weights, self.bias, self.scale = model, weights, bias, scale
        self.names = {name: i for i, name in enumerate(weights)}
        self.values = np.array(list(weights.values()) or [0.0])
        self.starts = {name[2:6] for name in weights}  # a word with a known feature starts so
        self.first = may_begin(self.starts)
        self.hope = re.compile("|".join(map(read_as, sorted(self.starts))) or r"(?!)")
        self.cache: dict[str, tuple[int, ...]] = {}
        self.runs: dict[str, tuple[int, ...]] = {}

    def known(self, word: str) -> tuple[int, ...]:
        got = self.cache.get(word)
        if got is None:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            plain = restored_core(word, self.model)
            got = self.cache[word] = self.numbers(plain) if plain[:4] in self.starts else ()
        return got

    def known_run(self, letters: str) -> tuple[int, ...]:
        got = self.runs.get(letters)
        if got is None:
            if len(self.runs) >= CACHE_WORDS // 10:
                self.runs.clear()
            found = restore_run(letters, self.model) if len(letters) > TESTED or self.hope.search(letters) else []
            got = self.runs[letters] = tuple(f for w in found for f in self.numbers(w))
        return got

    def numbers(self, word: str) -> tuple[int, ...]:
        return tuple(self.names[f] for f in evidence(word, self.names))

    def pairs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, feature) of a batch of texts."""
        flat, offsets = words(texts)
        if not len(flat):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        coded = flat.dictionary_encode()
        vocabulary, code = coded.dictionary, coded.indices.to_numpy()
        may = candidates(vocabulary, self.first)
        each = [self.known(w) for w in vocabulary.filter(pa.array(may)).to_pylist()]
        counts = np.zeros(len(vocabulary), np.int64)
        counts[may] = [len(x) for x in each]
        at = np.flatnonzero((counts > 0)[code])
        text, word = np.searchsorted(offsets, at, side="right") - 1, code[at]
        starts = np.cumsum(counts) - counts
        table = np.array([f for x in each for f in x], np.int64)
        rows = [np.repeat(text, counts[word])]
        found = [table[ragged(starts[word], counts[word])] if len(word) else np.empty(0, np.int64)]
        for row, letters in spelled_out(flat, offsets, pieces_of(vocabulary)[code]):
            if got := self.known_run(letters):
                rows.append(np.full(len(got), row))
                found.append(np.array(got, np.int64))
        joint = np.unique(np.concatenate(rows) * len(self.values) + np.concatenate(found))
        return joint // len(self.values), joint % len(self.values)

    def score(self, texts: pa.Array) -> np.ndarray:
        row, feature = self.pairs(texts)
        total = self.bias + self.scale * np.minimum(np.bincount(row, self.values[feature], minlength=len(texts)), MOST)
        return 1 / (1 + np.exp(-np.clip(total, -50, 50)))


#: The scorer that this worker process used last, by the name its broadcast carries: later tasks go on with its caches.
_last: dict[str, Scorer] = {}


def scorer_of(name: str, model: CharModel, *weights) -> Scorer:
    if name not in _last:
        _last.clear()
        _last[name] = Scorer(model, *weights)
    return _last[name]


def unstretched(plain: str, model: CharModel) -> str:
    """A word of letters only, without the letters that were only repeated."""
    if not REPEATED.search(plain):
        return plain
    out = restore(plain, model)
    if TRIPLE.search(plain) or out == plain:
        return out
    known, own = model.lexicon.get(out), model.lexicon.get(plain)
    return out if known is not None and (own is None or known - STRETCHED > own) else plain


def restored_core(word: str, model: CharModel) -> str:
    """A word without its edges' punctuation, restored if anything in it may be a disguise.

    Signs at the edges are read as letters where the lattice prefers that to dropping them and the
    vocabulary holds the result (or a money sign stands there); a number is read as a word only if
    the vocabulary holds that and does not prefer the number.
    """
    whole = word.lower()
    plain = whole.strip(EDGE)
    if plain.isalpha():
        if SIGNS.isdisjoint(whole):
            return unstretched(plain, model)
        out = restore(whole, model)
        if out != plain and out != restore(plain, model) and (out in model.lexicon or not MONEY.isdisjoint(whole)):
            return out
        return unstretched(plain, model)
    out = restore(whole, model)
    if any(map(str.isalpha, whole)):
        return out
    known, own = model.lexicon.get(out), model.lexicon.get(plain)
    return out if known is not None and (own is None or known - HIDDEN - READ * len(plain) > own) else plain


def read_as(start: str) -> str:
    """A pattern of what may be read as ``start``; what is not a letter may be dropped, and so may a letter's repeats."""

    def one(letter: str) -> str:
        signs = "".join(c for c, letters in LEET.items() if letter in letters) + ("".join(MASKS) if letter in VOWELS else "")
        return re.escape(letter) + "".join(map(re.escape, signs))

    return "".join(rf"[{one(x)}][\W\d_{one(x)}]*" for x in start)


def may_begin(starts: Iterable[str]) -> str:
    r"""What every word (in lower case) matches that may be read as one with such a beginning, for Arrow's linear-time matcher.

    There ``\W`` holds every letter beyond ASCII too, so more words match.
    """
    return "|".join(rf"^[\W\d_]*{read_as(x)}" for x in sorted(starts)) or "^$"


def candidates(vocabulary: pa.Array, first: str) -> np.ndarray:
    """Which of some words may have a known feature."""
    lower = pc.utf8_lower(vocabulary)
    return pc.match_substring_regex(lower, first).to_numpy(zero_copy_only=False).astype(bool)


def pieces_of(vocabulary: pa.Array) -> np.ndarray:
    """1 for a piece of a run, 2 for marks that may stand between pieces, else 0."""
    n = pc.utf8_length(pc.utf8_trim(vocabulary, characters=PIECE_EDGE)).to_numpy(zero_copy_only=False)
    return np.where(n > PIECE, 0, np.where(n > 0, 1, 2)).astype(np.int8)


def restore_run(letters: str, model: CharModel) -> list[str]:
    """Words that pieces with spaces between may spell.

    The lattice of the whole run: at each space a word ends, or the pieces are joined.
    """
    # A path: its cost, the cost at which its last word began, what that word's readings and letters are, the words before.
    paths: dict[str, list[tuple[float, float, float, Letters, tuple | None]]] = {BEGIN: [(0.0, 0.0, 0.0, None, None)]}

    def end(context: str, path: tuple) -> tuple[float, tuple | None]:
        cost, began, paid, last, before = path
        out = spelling(last)
        return (began + ended(cost - began, paid, context, out, model), (before, out)) if out else (cost, before)

    pieces = letters.split(" ")
    for n, piece in enumerate(pieces):
        if n:
            new = {context: [(cost + JOIN, began, paid + JOIN, *rest) for cost, began, paid, *rest in kept] for context, kept in paths.items()}
            closed = sorted((end(context, path) for context, kept in paths.items() for path in kept), key=itemgetter(0))
            new.setdefault(BEGIN, []).extend((cost, cost, 0.0, None, words) for cost, words in closed[:RUN_PATHS])
            paths = new
        # A letter repeats the one before it in the piece, or over a space that is dropped.
        spelled = (pieces[n - 1][-1:] if n else "") + piece
        inside = inner(spelled)
        for i in range(len(spelled) - len(piece), len(spelled)):
            new = {}
            for reading, price in readings(spelled, i, inside):
                for context, kept in paths.items():
                    if not reading and spelled[i].isalpha() and context == BEGIN:
                        continue  # nothing stands before it that it could repeat
                    step = price + (model.cost(context, reading) if reading else 0.0)
                    to = (context + reading)[-(ORDER - 1) :]
                    added = [(cost + step, began, paid + price, (last, reading) if reading else last, before) for cost, began, paid, last, before in kept]
                    new.setdefault(to, []).extend(added)
            paths = {context: sorted(kept, key=itemgetter(0))[:RUN_PATHS] for context, kept in new.items()}
    ends = [end(context, path) for context, kept in paths.items() for path in kept]
    out, found = min(ends, key=itemgetter(0))[1], []
    while out:
        out, word = out
        found.append(word)
    return found[::-1]


def frequencies_of(seen: Iterable[tuple[str, int]]) -> Counter:
    """Counts of words and numbers by their cores; words with signs that may be letters are not counted."""
    frequencies = Counter()
    for w, n in seen:
        plain = w.lower().strip(COUNTED_EDGE)
        if plain.isalpha() or plain.isdigit():
            frequencies[plain] += n
    return frequencies


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """(name, n): how often each word occurs in all texts."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                seen = words(strings(part.column("text")))[0].value_counts()
                names = pc.utf8_trim(pc.utf8_lower(seen.field("values")), characters=COUNTED_EDGE)
                plain = pc.or_(pc.utf8_is_alpha(names), pc.utf8_is_digit(names))
                yield pa.RecordBatch.from_arrays([names.filter(plain), seen.field("counts").filter(plain)], names=["name", "n"])

    one = docs.select(docs[text].alias("text")).where("text IS NOT NULL")
    return one.mapInArrow(counts, "name string, n bigint").groupBy("name").agg(F.sum("n").alias("n"))


def gram_counts(names: list[str], counts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Weighted counts of the words' n-grams, and of their contexts as followed by anything (``grams_of``)."""
    padded = "".join(f"{BEGIN}{w}$" for w in names)
    points = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(w) + ORDER for w in names])
    weight = np.repeat(counts, np.diff(np.r_[0, ends]))
    at = np.arange(len(points)) - np.repeat(np.r_[0, ends[:-1]], np.diff(np.r_[0, ends]))
    at, weight = np.flatnonzero(at >= ORDER - 1), weight[at >= ORDER - 1]
    distinct, letter = np.unique(points, return_inverse=True)
    grams, totals = [], []
    gram = context = None
    for k in range(ORDER):  # number the n-grams of k + 1 letters by those of k and one letter more
        if k == 0:
            context, gram = np.zeros(len(at), np.int64), letter[at]
        else:
            _, context = np.unique(letter[at - k] * np.int64(len(at) + 1) + context, return_inverse=True)
            _, gram = np.unique(letter[at - k] * np.int64(len(at) + 1) + gram, return_inverse=True)
        for number, tail in ((gram, 1), (context, 0)):
            _, first = np.unique(number, return_index=True)
            total = np.zeros(int(number.max()) + 1 if len(number) else 0, np.int64)
            np.add.at(total, number, weight)
            grams += [padded[i - k : i + tail] + ("" if tail else "\0") for i in at[first].tolist()]
            totals.append(total[np.unique(number)])
    return grams, np.concatenate(totals)


def corpus_model(docs: DataFrame, text: str = "text") -> CharModel:
    """The character model of all texts.  Only hashes and numbers come to the driver."""
    vocabulary = store(count_words(docs, text), "words")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column("name")
            letters = batch.filter(pc.utf8_is_alpha(names))
            if letters.num_rows:
                made, n = gram_counts(letters.column("name").to_pylist(), letters.column("n").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.string()), pa.array(n)], names=["name", "n"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.fromiter(map(hashed, batch.column("name").to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), batch.column("n")], names=["key", "n"])

    def table(named: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        got = named.mapInArrow(keys, "key bigint, n bigint").toArrow()
        return got.column("key").to_numpy(), got.column("n").to_numpy()

    counted = vocabulary.mapInArrow(grams, "name string, n bigint").groupBy("name").agg(F.sum("n").alias("n"))
    total = vocabulary.agg(F.sum("n")).first()[0] or 1
    known, n = table(vocabulary.where("n >= 2"))
    return CharModel(Table(*table(counted)), Table(known, np.log(n / total)))


def marks_of(distinct: list[str]) -> tuple[int, int]:
    """Two small sketches of a text's words; texts that share one are copies or near copies."""
    hashes = sorted(map(hashed, distinct))
    low, high = (hashes[:5], hashes[-5:]) if len(hashes) >= 25 else (hashes, hashes)
    return tuple(int.from_bytes(xxhash.xxh3_64_digest(repr((side, part)).encode()), "little", signed=True) for side, part in (("low", low), ("high", high)))


def gains(totals, toxic, rate: float):
    """How far a feature speaks for toxic, in standard deviations (arrays or columns)."""
    return (toxic - totals * rate) / (totals * (rate * (1 - rate)) + 1.0) ** 0.5


def log_odds(totals: np.ndarray, toxic: np.ndarray, n: float, toxic_texts: float) -> np.ndarray:
    return np.log((toxic + 0.5) / (toxic_texts + 1)) - np.log((totals - toxic + 0.5) / (n - toxic_texts + 1))


def calibrate(sums: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Scale and bias of the sums of log odds: regularised logistic regression by Newton steps."""
    rate = y.mean()
    x = np.stack([np.clip(sums, 0, MOST), np.ones(len(y))], axis=1)
    fit = pull = np.array([0.7, math.log(rate / (1 - rate))])

    def loss(fit: np.ndarray) -> float:
        z = x @ fit
        return float(np.logaddexp(0, z).sum() - y @ z + 0.1 * ((fit - pull) ** 2).sum())

    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ fit, -40, 40)))
        slope = x.T @ (p - y) + 0.2 * (fit - pull)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.2 * np.eye(2), slope)
        while loss(fit - step) > loss(fit) and np.abs(step).max() > 1e-9:
            step = step / 2
        fit = fit - step
    return float(fit[0]), float(fit[1])


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most about ``rows`` labelled texts, drawn by a hash of the key: (id, text, label).

    The drawn labels have a bound, so they are broadcast and texts are not shuffled.
    """
    usable = labels.where(labels[label].isNotNull() & labels[key].isNotNull()).select(labels[key].alias("id"), labels[label].cast("int").alias("label"))
    n = usable.count()
    drawn = usable.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, rows / max(n, 1)) * (1 << 30)))
    body = docs.select(docs[key].alias("id"), docs[text].alias("text")).where("text IS NOT NULL")
    return body.join(F.broadcast(drawn), "id").select(F.col("id").cast("long"), "text", "label")


def learn(drawn: DataFrame, model: CharModel) -> Scorer:
    """Choose features by their information over labelled texts (id, text, label) and calibrate log odds.

    Copies and near copies, whose common words would pass for evidence, count once.
    """
    spark = drawn.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, str] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                flat, offsets = words(strings(part.column("text")))
                low, high, plain = [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    distinct = flat.slice(a, b - a).unique().to_pylist()
                    for w in distinct:
                        if w not in cache:
                            if len(cache) >= CACHE_WORDS:
                                cache.clear()
                            cache[w] = restored_core(w, shared.value)
                    one, two = marks_of(distinct)
                    low.append(one)
                    high.append(two)
                    plain.append(sorted({p for w in distinct if (p := cache.get(w) or restored_core(w, shared.value))}))
                columns = [part.column("id"), part.column("label"), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(plain, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "low", "high", "plain"])

    # A few thousand rows: spread them, as each has many words to restore.
    bags = drawn.repartition(64, "id").mapInArrow(restored, "id bigint, label int, low bigint, high bigint, plain array<string>")
    bags = store(bags.withColumn("row", F.monotonically_increasing_id()), "bags")
    order = F.struct("id", "label", "row")
    seen = bags.select(F.explode(F.array("low", "high")).alias("mark"), order.alias("at")).groupBy("mark").agg(F.min("at").alias("first"))
    kept = bags.select("row", order.alias("at"), F.explode(F.array("low", "high")).alias("mark")).join(seen, "mark")
    late = kept.where("at != first").select("row").distinct()
    bags = store(bags.join(late, "row", "left_anti").select("row", "label", "plain"), "bags")
    n, toxic_texts = bags.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < toxic_texts < n:
        return Scorer(model, {}, -50.0)

    begins = [F.when(F.length("w") > k, F.concat(F.lit("p:"), F.substring("w", 1, k))) for k in (7, 6, 5, 4)]
    own = bags.select("row", "label", F.explode("plain").alias("w"))
    own = own.select("row", "label", F.explode(F.array_compact(F.array(F.concat(F.lit("w:"), "w"), *begins))).alias("feature")).distinct()
    counted = own.groupBy("feature").agg(F.count(F.lit(1)).alias("totals"), F.sum("label").alias("toxic"))
    gain = gains(F.col("totals"), F.col("toxic"), toxic_texts / n)
    best = counted.withColumn("gain", gain).where("totals >= 5 AND gain > 4").orderBy(F.desc("gain"), "feature").limit(FEATURES).collect()
    odds = log_odds(np.array([r["totals"] for r in best], float), np.array([r["toxic"] for r in best], float), n, toxic_texts)
    weights = dict(zip([r["feature"] for r in best], odds.tolist()))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = {name[2:6] for name in weights}
        for batch in batches:
            total = []
            for bag in batch.column("plain").to_pylist():
                features = {f for w in bag if w[:4] in starts for f in evidence(w, weights)}
                total.append(sum(weights[f] for f in sorted(features)))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(total, pa.float64())], names=["label", "total"])

    got = bags.mapInArrow(sums, "label int, total double").toArrow()  # two numbers for each drawn text
    scale, bias = calibrate(got.column("total").to_numpy(), got.column("label").to_numpy().astype(float))
    return Scorer(model, weights, bias, scale)


def score_texts(docs: DataFrame, scorer: Scorer, key: str = "doc_id", text: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((scorer.model.counts, scorer.model.lexicon, scorer.weights, scorer.bias, scorer.scale))
    name = uuid.uuid4().hex

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, lexicon, *weights = shared.value
        own = scorer_of(name, CharModel(counts, lexicon), *weights)
        for batch in batches:
            for part in slices(batch, "text"):
                score = own.score(strings(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(score)], names=["doc_id", "score"])

    return docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text")).mapInArrow(rows, "doc_id bigint, score double")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scorer = learn(sample(docs, labels.where(remainder(F.col("doc_id"), 5) != 0)), corpus_model(docs))
    return score_texts(docs, scorer).select(
        "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
