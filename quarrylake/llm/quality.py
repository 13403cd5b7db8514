"""Quality classifier without labels: a weak-label model and a hashed linear scorer.

Overlapping heuristic labellers vote good, bad or abstain on every text.  Expectation maximisation
over the counts of vote patterns (of all texts; there are at most 3**L patterns) estimates how each
labeller votes on good and on bad texts, and with them each pattern's posterior.  Bad texts have
different faults, on which different labellers speak, so the class "bad" is a mixture with one part
for each labeller that knows one fault: in its own part that labeller has rates of its own, while all other
labellers' rates are shared by the parts, which tells a labeller's true hits from its false ones.  Rates have Dirichlet
priors, and each round raises the posterior density of the rates (``weak_labels`` gives its course).  Labellers
that know both sides say nothing about a text by their silence, so a text on which all are silent keeps the prior.
Posterior labels then train a linear scorer over hashed word shapes and the votes, which generalises to texts on
which labellers abstain.  The scorer is fitted on a bounded sample (``SAMPLE_DOCS``) and scores every whole text.

Labellers and shapes know all scripts: letters are letters of any script with their marks, sentences end as
they do in each, and runs of scripts that are written without spaces are cut into short words first.

Rows: a null text or one without words scores 0 and is rejected.  Rows of one key each give a row.
An empty table gives an empty result.  Columns other than key and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCHES, settings, slices, strings, words

#: Bound of the scorer's training sample, its hashed dimensions, and the words within which a word counts as repeated.
SAMPLE_DOCS, DIMENSIONS, NEAR = 4000, 4096, 100
GOOD, ABSTAIN, BAD = 2, 1, 0


#: Letters of scripts that put no spaces between words; the first list's do not end sentences by a mark either.
UNENDED = r"\p{Thai}\p{Lao}"
UNSPACED = UNENDED + r"\p{Han}\p{Hiragana}\p{Katakana}\p{Khmer}\p{Myanmar}ー"
#: Marks that end a sentence, other marks that follow a word, marks that open one, and those that close after an end.
ENDS = ".?!。！？｡։؟۔।॥።፧…။។"
FOLLOW = ",;:、，．：；､،؛፣፤၊·"
OPEN, CLOSE = "\"'(\\[«“‘¿¡「『（《〈【", "\"')\\]»”’」』）》〉】"


#: A word of letters and numbers between at most one opening mark and the marks that may follow one.
PLAIN = rf"^[{OPEN}]?[\p{{L}}\p{{M}}\p{{N}}\x{{200C}}\x{{200D}}'’ー-]+(?:[{ENDS}{FOLLOW}{CLOSE}]|[{ENDS}][{CLOSE}]|[{CLOSE}][{ENDS}{FOLLOW}])?$"


def spaced(texts: pa.Array) -> pa.Array:
    """The texts with a space after every third letter, at most, of scripts that are written without any."""
    if not pc.any(pc.match_substring_regex(texts, f"[{UNSPACED}]")).as_py():
        return texts
    return pc.replace_substring_regex(texts, f"([{UNSPACED}]{{1,3}}[{ENDS}{FOLLOW}{CLOSE}]*)", r"\1 ")


class Facts:
    """Counts of each text of a batch, from which labellers vote."""

    def __init__(self, texts: pa.Array):
        texts = spaced(texts)
        self.flat, self.offsets = words(texts)
        self.texts = len(texts)
        self.n = np.diff(self.offsets)
        self.text = np.repeat(np.arange(self.texts), self.n)
        coded = self.flat.dictionary_encode()
        self.code = coded.indices.to_numpy() if len(coded) else np.empty(0, np.int32)
        self.vocabulary = coded.dictionary
        same = np.r_[False, (self.code[1:] == self.code[:-1]) & (self.text[1:] == self.text[:-1])]
        self.repeats = self.share(same)
        # A word that stands among the hundred before it too; unlike a share of distinct words this does not grow with a text.
        order = np.argsort(self.text * max(1, len(self.vocabulary)) + self.code, kind="stable")
        again = (np.diff(self.text[order]) == 0) & (np.diff(self.code[order]) == 0) & (np.diff(order) <= NEAR)
        near = np.zeros(len(order), bool)
        near[order[1:][again]] = True
        self.near = self.share(near)
        self.bars = self.share(self.of_words(lambda v: pc.equal(v, "|")))
        self.shouts = self.share(self.of_words(lambda v: pc.match_substring_regex(v, r"!!$")))
        self.marked = self.share(self.of_words(lambda v: pc.match_substring_regex(v, r"[#$%&*+<=>@^_~{}\\]{2}")))
        self.ends = self.share(self.of_words(lambda v: pc.match_substring_regex(v, f"[{ENDS}][{CLOSE}]*$"))) * self.n
        self.unended = self.share(self.of_words(lambda v: pc.match_substring_regex(v, f"[{UNENDED}]")))
        upper = self.of_words(lambda v: pc.and_(pc.utf8_is_upper(v), pc.greater(pc.utf8_length(v), 1)))
        self.upper = self.share(upper)
        self.plain = self.share(self.of_words(lambda v: pc.match_substring_regex(v, PLAIN)) & ~same)

    def of_words(self, test: Callable[[pa.Array], pa.Array]) -> np.ndarray:
        found = test(self.vocabulary).to_numpy(zero_copy_only=False)
        return found[self.code] if len(self.code) else found[:0]

    def share(self, flags: np.ndarray) -> np.ndarray:
        return np.bincount(self.text, flags, self.texts) / np.maximum(self.n, 1)


def _bad_above(value: np.ndarray, limit: float, n: np.ndarray, least: int = 1) -> np.ndarray:
    return np.where((value > limit) & (n >= least), BAD, ABSTAIN)


def _sentences(f: Facts) -> np.ndarray:
    """Sentences of some words each are good; many words without an end are bad, unless their script knows no end."""
    length = f.n / np.maximum(f.ends, 0.5)
    return np.where((f.ends >= 1) & (length <= 40), GOOD, np.where((length > 150) & (f.n >= 60) & (f.unended < 0.2), BAD, ABSTAIN))


#: Name and vote of each labeller.  One kind of fault each votes bad or abstains; the last two know both sides.
LABELLERS: tuple[tuple[str, Callable[[Facts], np.ndarray]], ...] = (
    ("marks on words", lambda f: _bad_above(f.marked, 0.15, f.n, 5)),
    ("shouting", lambda f: _bad_above(f.shouts, 0.15, f.n, 5)),
    ("capitals", lambda f: _bad_above(f.upper, 0.4, f.n, 5)),
    ("table rules", lambda f: _bad_above(f.bars, 0.15, f.n, 5)),
    ("same word again", lambda f: _bad_above(f.repeats, 0.3, f.n, 5)),
    ("few distinct words", lambda f: _bad_above(f.near, 0.8, f.n, 20)),
    ("sentence lengths", _sentences),
    ("plain words", lambda f: np.where(f.plain > 0.9, GOOD, np.where((f.plain < 0.75) & (f.n >= 5), BAD, ABSTAIN))),
)
#: Labellers of one fault; the others know both sides.
FAULTS = 6


def votes_of(facts: Facts) -> np.ndarray:
    """Each text's votes as one number in base 3; a text without words has only abstentions."""
    code = np.zeros(facts.texts, np.int64)
    for _, vote in LABELLERS:
        code = code * 3 + np.where(facts.n == 0, ABSTAIN, vote(facts))
    return code


def digits(code: np.ndarray) -> np.ndarray:
    """Votes (patterns x labellers) of pattern numbers."""
    return code[:, None] // 3 ** np.arange(len(LABELLERS) - 1, -1, -1) % 3


#: Pseudo-counts (bad, abstain, good) of the rates' priors: of good texts, of a fault's own labeller, of the others on bad texts;
#: and those of the parts' shares, good first.
ON_GOOD, ON_OWN, ON_BAD, SHARES = (0.5, 4.0, 0.0), (4.0, 0.4, 0.0), (0.5, 2.0, 0.0), (4.0, 0.5)
TWO_GOOD, TWO_BAD = (0.5, 0.0, 4.0), (2.0, 0.0, 1.0)


def _priors(labellers: int) -> np.ndarray:
    """Pseudo-counts of each (part, labeller, vote); rates that parts share have their prior once, in part 1 or 2."""
    prior = np.zeros((FAULTS + 1, labellers, 3))
    prior[0, :FAULTS], prior[0, FAULTS:] = ON_GOOD, TWO_GOOD
    for k in range(labellers):
        prior[2 if k == 0 else 1, k] = ON_BAD if k < FAULTS else TWO_BAD
    for j in range(1, FAULTS + 1):
        prior[j, j - 1] = ON_OWN
    return prior


def weak_labels(code: np.ndarray, counts: np.ndarray, rounds: int = 500, course: list[float] | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior of good for each pattern; P(vote | class) (2 x labellers x 3); the share of good.

    Part 0 is good; part j > 0 is bad by fault j.  Silence of a labeller that knows both sides has rate one.
    ``course`` gets the log of likelihood times priors before each round; it never falls, and when it no longer
    rises the rounds end.
    """
    vote, parts = digits(code), FAULTS + 1
    lab, two = np.arange(vote.shape[1]), np.arange(vote.shape[1]) >= FAULTS
    own = np.zeros((parts, len(lab)), bool)
    own[np.arange(1, parts), np.arange(FAULTS)] = True
    prior, share_prior = _priors(len(lab)), np.r_[SHARES[0], np.full(FAULTS, SHARES[1])]

    def rates(weight: np.ndarray) -> np.ndarray:
        """The rates that fit weighted votes (parts x labellers x votes) and the priors best."""
        seen = weight + prior
        shared = np.where(own[1:, :, None], 0, seen[1:]).sum(axis=0)
        seen[1:] = np.where(own[1:, :, None], seen[1:], shared)
        seen[:, two, ABSTAIN] = 0
        out = seen / np.maximum(seen.sum(axis=2, keepdims=True), 1e-300)
        out[:, two, ABSTAIN] = 1
        return np.maximum(out, 1e-12)

    table, shares, last = rates(np.zeros_like(prior)), share_prior / share_prior.sum(), -np.inf
    belongs = np.zeros((parts, len(code)))
    for _ in range(rounds):
        log = np.log(shares)[:, None] + np.log(table[:, lab, vote]).sum(axis=2)
        top = log.max(axis=0)
        belongs = np.exp(log - top)
        whole = belongs.sum(axis=0)
        reached = float((counts * (np.log(whole) + top)).sum() + (prior * np.log(table)).sum() + (share_prior * np.log(shares)).sum())
        if course is not None:
            course.append(reached)
        if reached - last < 1e-9 * max(1.0, abs(reached)):
            belongs *= counts / whole
            break
        last = reached
        belongs *= counts / whole
        weight = np.stack([np.stack([np.bincount(vote[:, k], row, 3) for k in lab]) for row in belongs])
        shares = belongs.sum(axis=1) + share_prior
        shares /= shares.sum()
        table = rates(weight)
    posterior = belongs[0] / np.maximum(counts, 1e-12)
    of_bad = shares[1:, None, None] / shares[1:].sum()
    return posterior, np.stack([(table[1:] * of_bad).sum(axis=0), table[0]]), float(shares[0])


def precisions(code: np.ndarray, counts: np.ndarray, posterior: np.ndarray) -> dict[str, float]:
    """The estimated share of each labeller's bad votes that falls on bad texts."""
    vote = digits(code)
    hits = [(counts * (vote[:, k] == BAD)) for k in range(vote.shape[1])]
    return {name: float((n * (1 - posterior)).sum() / n.sum()) if n.sum() else 1.0 for (name, _), n in zip(LABELLERS, hits)}


_RUNS = re.compile(r"(.)\1+")


#: What becomes one letter of a shape, in this order.
_CLASSES = ((r"[\p{Ll}\p{Lm}\p{Lo}\p{M}]+", "a"), (r"[\p{Lu}\p{Lt}]+", "A"), (r"\p{N}+", "0"))


def shapes_of(vocabulary: pa.Array) -> pa.DictionaryArray:
    """``Hello,`` becomes ``Aa,``; ``THIS!!`` becomes ``A!``."""
    for pattern, letter in _CLASSES:
        vocabulary = pc.replace_substring_regex(vocabulary, pattern, letter)
    coded = vocabulary.dictionary_encode()
    short = [_RUNS.sub(r"\1", w) for w in coded.dictionary.to_pylist()]
    return pa.DictionaryArray.from_arrays(coded.indices, pa.array(short, pa.string()))


def trust(n: np.ndarray) -> np.ndarray:
    """Shares in a text of a few words say less than in a long one."""
    return n / (n + 3.0)


#: The first dimensions: repeated words, and each labeller's votes.
VOTES = 1 + 3 * len(LABELLERS)


def dimensions(facts: Facts) -> np.ndarray:
    """Two hashed dimensions of each word of the vocabulary: its shape's and its end's."""
    shapes = shapes_of(facts.vocabulary)
    place = lambda name: VOTES + zlib.crc32(name) % (DIMENSIONS - VOTES)
    each = [(place(short.encode()), place(b"end" + short[-2:].encode())) for short in shapes.dictionary.to_pylist()]
    table = np.array(each, np.int64).reshape(-1, 2)
    return table[shapes.indices.to_numpy()] if len(shapes) else table


def vote_dimensions(facts: Facts) -> np.ndarray:
    """A dimension for each vote (texts x labellers); abstentions have weight 0 below."""
    vote = digits(votes_of(facts))
    return np.where(vote == ABSTAIN, -1, 1 + 3 * np.arange(vote.shape[1]) + vote)


def sums(facts: Facts, weights: np.ndarray) -> np.ndarray:
    by_word, spoken = weights[dimensions(facts)].sum(axis=1), vote_dimensions(facts)
    shapes = (facts.share(by_word[facts.code] if len(facts.code) else np.empty(0)) + weights[0] * facts.repeats) * trust(facts.n)
    return shapes + np.where(spoken < 0, 0, weights[spoken]).sum(axis=1)


def sparse(facts: Facts) -> list[tuple[list[int], list[float]]]:
    """Features of texts: shares of hashed word shapes, of ends of words, and of repeated words; votes."""
    table, spoken, out = dimensions(facts), vote_dimensions(facts), []
    for i in range(facts.texts):
        own = table[facts.code[facts.offsets[i] : facts.offsets[i + 1]]].ravel()
        where, n = np.unique(own, return_counts=True)
        share = n / max(1, facts.n[i]) * trust(facts.n[i])
        said = spoken[i][spoken[i] >= 0].tolist()
        out.append(([0, *said, *where.tolist()], [float(facts.repeats[i] * trust(facts.n[i])), *[1.0] * len(said), *share.tolist()]))
    return out


def fit(features: list[tuple[list[int], list[float]]], target: np.ndarray, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights towards soft labels."""
    row = np.repeat(np.arange(len(features)), [len(i) for i, _ in features])
    column = np.array([c for i, _ in features for c in i], np.int64)
    value = np.array([v for _, x in features for v in x])
    w, bias = np.zeros(DIMENSIONS), 0.0
    mean, square, m0, s0 = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        z = bias + np.bincount(row, w[column] * value, len(features))
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - target) / len(target)
        g, g0 = np.bincount(column, error[row] * value, DIMENSIONS) + 1e-5 * w, error.sum()
        mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
        m0, s0 = 0.9 * m0 + 0.1 * g0, 0.99 * s0 + 0.01 * g0 * g0
        a, b = 1 - 0.9**step, 1 - 0.99**step
        w -= 0.1 * (mean / a) / (np.sqrt(square / b) + 1e-9)
        bias -= 0.1 * (m0 / a) / (np.sqrt(s0 / b) + 1e-9)
    return w, float(bias)


@dataclass
class Model:
    """What the scorer needs: weights over hashed dimensions, and each vote pattern's posterior of good."""

    weights: np.ndarray
    bias: float
    posterior: dict[int, float]
    good: float

    def scores(self, facts: Facts) -> np.ndarray:
        z = self.bias + sums(facts, self.weights)
        return np.where(facts.n > 0, 1 / (1 + np.exp(-np.clip(z, -40, 40))), 0.0)


def fitted(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 11) -> Model:
    """Count all texts' vote patterns, estimate their posteriors and fit the scorer to them."""
    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = [votes_of(Facts(strings(part.column("text")))) for part in slices(batch, "text")]
            if code:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(code))], names=["votes"])

    with settings(docs.sparkSession, BATCHES):
        patterns = rows.select("text").mapInArrow(vote, "votes bigint").groupBy("votes").count().collect()
    code = np.array([r["votes"] for r in patterns], np.int64)
    counts = np.array([r["count"] for r in patterns], float)
    posterior, _, good = weak_labels(code, counts)
    of = dict(zip(code.tolist(), posterior.tolist()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                facts = Facts(strings(part.column("text")))
                where, value = zip(*sparse(facts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(votes_of(facts)), pa.array(where, pa.list_(pa.int64())), pa.array(value, pa.list_(pa.float64()))],
                    names=["id", "votes", "feature", "value"],
                )

    total = counts.sum()
    draw = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_DOCS / max(total, 1)) * (1 << 30))
    drawn = rows.where("text IS NOT NULL").where(draw).mapInArrow(gather, "id bigint, votes bigint, feature array<bigint>, value array<double>")
    sample = sorted((r["id"] or 0, r["votes"], r["feature"], r["value"]) for r in drawn.collect() if len(r["feature"]) > 1)
    target = np.array([of[s[1]] for s in sample])
    if sample and 0 < (target >= 0.5).sum() < len(sample):
        weights, bias = fit([(s[2], s[3]) for s in sample], target)
    else:  # labellers see one class only
        weights, bias = np.zeros(DIMENSIONS), 4.0 if good >= 0.5 else -4.0
    return Model(weights, bias, of, good)


def classify(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, score, kept, posterior (of its votes alone), votes."""
    rows = docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, key, text))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                facts = Facts(strings(part.column("text")))
                p, code = model.scores(facts), votes_of(facts)
                said = ["".join("-?+"[d] for d in row) for row in digits(code)]
                columns = [part.column("id"), pa.array(p), pa.array(p >= 0.5), pa.array([model.posterior.get(c, model.good) for c in code.tolist()]), pa.array(said)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "kept", "posterior", "votes"])

    return rows.mapInArrow(score, "doc_id bigint, score double, kept boolean, posterior double, votes string")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go.

    Only texts go to Python and only a flag for each comes back; rows stay where they are, so this
    stage shuffles nothing.  A null text or one without words is rejected; equal texts share their
    fate; an empty table stays empty; other columns are carried, whatever their names.
    """
    shared = spark.sparkContext.broadcast(fitted(docs))

    @F.arrow_udf("boolean")
    def good(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch], names=["text"])
            flags = [model.scores(Facts(strings(part.column("text")))) >= 0.5 for part in slices(texts, "text")]
            yield pa.array(np.concatenate(flags) if flags else np.empty(0, bool))

    return docs.where(good(docs["text"]))
