"""Secret scan: fixed patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a run of at least ``WINDOW`` = 20 characters that keys are made of; shorter strings
cannot be told from words and numbers by their entropy and are left to the fixed patterns.  A window slides over it; counts of
its characters, and with them its entropy, are updated by the one character that leaves and the one that
comes.  A window is held against the threshold of its character class (the narrowest class that
holds all its characters), because sixteen hexadecimal digits can never reach what sixteen
base-64 characters reach.  Windows over their thresholds are merged to spans of kind ``entropy``.
A window needs two letters.  One with fewer than two digits looks like written words: it must also
mix lower and upper case as words do not (``MIXED`` of each, and as many changes between neighbours), or be
of letters of one case and reach ``LETTERS`` bits, which a random one of 20 letters seldom does.
Allow-listed forms (UUIDs, dates, addresses, paths, placeholders, ...) and spans of the fixed patterns are cut
out of a run before the windows slide over what is left, so they hide nothing beside them; spans of the fixed
patterns are never suppressed, and no entropy span overlaps one.

Positions count code points, ends are exclusive; a fixed pattern's span is its whole match.
Rows: a null text counts as empty; texts without a span give zero counts and an empty ``spans``.
Rows of one key each give a row.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import strings

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
#: Without one of these a text holds no assignment.
ASSIGN_WORDS = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")

WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Character classes from narrow to wide: name, members, bits that a window must reach.
CLASSES = (
    ("digits", frozenset("0123456789"), math.inf),
    ("hex", frozenset("0123456789abcdef"), 3.0),
    ("HEX", frozenset("0123456789ABCDEF"), 3.0),
    ("lower", frozenset("0123456789abcdefghijklmnopqrstuvwxyz"), 3.5),
    ("upper", frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), 3.5),
    ("base64", frozenset("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"), 3.7),
)
#: What words with fewer than two digits must reach: letters of each case and changes of case; bits of one case.
MIXED, LETTERS = 6, 4.1
#: Forms that are no secrets; they are cut out of a candidate.
ALLOWED = (
    r"(?<![0-9a-f])[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}(?![0-9a-f])",  # UUID
    r"(?<![0-9A-Za-z])\d{4}-\d\d-\d\d(?:[-_T]\d\d)*Z?(?![0-9A-Za-z])",  # dates and times
    r"(?i)example|placeholder|changeme|x{4,}|dummy|sample|0123456789|abcdefgh",
)


def _narrowest(counts: dict[str, int]) -> int:
    """Index of the narrowest class that holds every character of the window."""
    for i, (_, members, _) in enumerate(CLASSES):
        if all(c in members for c in counts):
            return i
    return len(CLASSES) - 1


def entropy_spans(run: str, window: int = WINDOW) -> list[tuple[int, int]]:
    """Spans of ``run`` under windows whose entropy reaches their class's threshold."""
    term = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    whole, counts, total, spans = math.log2(window), {}, 0.0, []
    digits = lower = upper = changes = 0

    def change(i: int) -> bool:
        """Letters of different case at ``i`` and before it."""
        return run[i - 1 : i + 1].isalpha() and run[i - 1].islower() != run[i].islower()

    for i, c in enumerate(run):
        if i >= window:
            gone = run[i - window]
            n = counts[gone]
            total += term[n - 1] - term[n]
            digits -= gone.isdigit()
            lower -= gone.islower()
            upper -= gone.isupper()
            changes -= change(i - window + 1)
            if n == 1:
                del counts[gone]
            else:
                counts[gone] = n - 1
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += term[n + 1] - term[n]
        digits += c.isdigit()
        lower += c.islower()
        upper += c.isupper()
        changes += i > 0 and change(i)
        if i >= window - 1 and lower + upper >= 2:
            bits = CLASSES[_narrowest(counts)][2]
            if digits < 2 and min(lower, upper, changes) < MIXED:
                bits = LETTERS if window in (lower, upper) else math.inf
            if whole - total / window >= bits:
                a = i - window + 1
                if spans and a <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((a, i + 1))
    return spans


def outside(run: str, allowed: re.Pattern) -> Iterator[tuple[int, int]]:
    """Stretches of a candidate between its allowed forms."""
    at = 0
    for m in allowed.finditer(run):
        yield at, m.start()
        at = m.end()
    yield at, len(run)


def between(start: int, end: int, starts: list[int], ends: list[int]) -> Iterator[tuple[int, int]]:
    """The parts of a stretch that no base span (sorted, apart from each other) covers."""
    k = bisect_right(ends, start)
    while k < len(starts) and starts[k] < end:
        if start < starts[k]:
            yield start, starts[k]
        start = ends[k]
        k += 1
    if start < end:
        yield start, end


def scan(text: str, allowed: re.Pattern) -> list[tuple[int, int, int]]:
    """All spans of a text as (start, kind's place in ``KINDS``, end), sorted."""
    found = []
    lowered = text.encode("utf-8", "surrogatepass").lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    starts, ends = [], []  # the base spans joined where they overlap
    for a, _, b in sorted(found):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for m in CANDIDATE.finditer(text):
        for start, end in outside(m[0], allowed):
            for a, b in between(m.start() + start, m.start() + end, starts, ends):
                if b - a >= WINDOW:
                    found += [(a + x, 3, a + y) for x, y in entropy_spans(text[a:b])]
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


RESULT = (
    "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, n_entropy bigint, base_sha256 string, spans string"
)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", allow: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Per row: counts by kind, a digest of the fixed patterns' spans, and all spans."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = re.compile("|".join(f"(?i:{p[4:]})" if p.startswith("(?i)") else f"(?:{p})" for p in allow) or r"(?!)")
        for batch in batches:
            out = []
            for body in strings(batch.column("text")).to_pylist():
                spans = scan(body, allowed)
                kinds = [k for _, k, _ in spans]
                base = joined([x for x in spans if x[1] < 3])
                out.append([*map(kinds.count, range(4)), hashlib.sha256(base.encode()).hexdigest(), joined(spans)])
            columns = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                names=[x.split()[0] for x in RESULT.split(", ")],
            )

    return docs.select(docs[key].cast("long").alias("id"), docs[text].alias("text")).mapInArrow(rows, RESULT)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
