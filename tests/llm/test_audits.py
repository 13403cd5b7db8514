"""Filter interaction, source divergence and line dedup against plain versions."""

import hashlib
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrylake.llm import line_dedup
from quarrylake.llm.divergence import OP12_SQL, divergence, op12_source_divergence
from quarrylake.llm.filter_audit import OP11_SQL, interaction, op11_filter_audit
from quarrylake.llm.line_dedup import OP13_SQL, Pair, dedup_lines, op13_line_dedup

from .brute import words

QUERIES = {"op11": (op11_filter_audit, OP11_SQL), "op12": (op12_source_divergence, OP12_SQL), "op13": (op13_line_dedup, OP13_SQL)}


def same_as_sql(got, sql, folder):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found = con.execute(sql)
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(got.columns)
    order = sorted(columns)
    want = sorted(repr([r[columns.index(c)] for c in order]) for r in found.fetchall())
    assert sorted(repr([r[c] for c in order]) for r in got.collect()) == want


@pytest.mark.parametrize("name", QUERIES)
def test_sql(spark, small, name):
    query, sql = QUERIES[name]
    same_as_sql(query(spark, small), sql, small)


@pytest.mark.parametrize("name", QUERIES)
def test_empty(spark, empty, name):
    assert QUERIES[name][0](spark, empty).count() == 0


def rows_of(spark, folder):
    return [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def plain_audit(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    smallest = {}
    for i, t, *_ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    parts = defaultdict(list)
    for i, t, _, s in rows:
        t, w = t or "", words(t)
        fails = {
            "A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and smallest[t] < i,
        }
        parts[s or ""].append((fails, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone, left = [d for d in left if d[0][f]], [d for d in left if not d[0][f]]
                own = sum(d[0][f] for d in docs)
                unique = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                out[part, "".join(order), step] = (len(left), len(gone), own - len(gone), unique, sum(d[1] for d in gone), sum(d[2] for d in gone))
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


ODD_LABELS = [(1, 1, 0), (3, None, None), (8, 0, 1), (None, 1, 1)]


def test_audit_on_odd_rows(spark, odd):
    got = {tuple(r[:3]): tuple(r[3:]) for r in op11_filter_audit(spark, odd).collect()}
    want = plain_audit(rows_of(spark, odd), ODD_LABELS)
    assert got == want
    assert {k[0] for k in got} == {"s", ""} and len(got) == 2 * 600


def test_repeated_ids_and_labels(spark, table):
    rows = [(5, "t", "en", "a"), (5, "t", "en", "b"), (2, "t", "en", "b"), (2, "t", "en", "a"), (None, "t", "en", "a"), (9, "t", "en", ""), (7, "T", "en", None)]
    folder = table(rows, [(5, 1, None), (5, 0, 1), (9, 0, 0)])
    got = {tuple(r[:3]): tuple(r[3:]) for r in op11_filter_audit(spark, folder).collect()}
    assert got == plain_audit(rows, [(5, 1, None), (5, 0, 1), (9, 0, 0)])
    assert got["a", "EABCD", 1][1] == 1 and got["a", "EABCD", 1][4:6] == (1, 1)


@given(st.dictionaries(st.tuples(st.integers(0, 7), st.booleans(), st.booleans()), st.integers(1, 9), max_size=12))
@settings(max_examples=8, deadline=None)
def test_any_failures_of_three_filters(spark, kinds):
    df = spark.createDataFrame([("p", k[0], k[1], k[2], n) for k, n in kinds.items()], "part string, fails int, good boolean, toxic boolean, n bigint")
    got = {(r.filter_order, r.step): r for r in interaction(df, "ABC").collect()}
    assert len(got) == (18 if kinds else 0)
    for (order, step), r in got.items():
        before = sum(1 << "ABC".index(f) for f in order[: step - 1])
        own = 1 << "ABC".index(order[step - 1])
        gone = {k: n for k, n in kinds.items() if k[0] & own and not k[0] & before}
        assert r.removed == sum(gone.values()) and r.good_lost == sum(n for k, n in gone.items() if k[1])
        assert r.redundant == sum(n for k, n in kinds.items() if k[0] & own and k[0] & before)
        assert r.unique_fails == sum(n for k, n in kinds.items() if k[0] == own)
        assert r.shapley == sum(x.removed for x in got.values() if x.filter_order[x.step - 1] == order[step - 1])


def plain_divergence(rows, least=3, top=200):
    langs = defaultdict(lambda: defaultdict(Counter))
    docs = defaultdict(Counter)
    for _, t, lang, s in rows:
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t or "")
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in found]
        langs[lang or ""][s or ""].update(found)
        docs[lang or ""].update(set(found))
    out = set()
    for lang, groups in langs.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = sum(groups.values(), Counter())

        def p(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (n + len(kept)) for t in kept}

        q, own = p(whole), {g: p(c) for g, c in groups.items()}
        for g, counts in groups.items():
            pair = [(-sum((own[g][t] - own[h][t]) ** 2 // own[h][t] for t in kept), h.encode()) for h in groups if h != g]
            term = [(-((own[g][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[t] and own[g][t] > q[t]]
            out |= {(lang, g, "pair", i.decode(), -v, k) for k, (v, i) in enumerate(sorted(pair), 1)}
            out |= {(lang, g, "term", i.decode(), -v, k) for k, (v, i) in enumerate(sorted(term), 1) if k <= top}
    return out


def test_divergence_on_odd_rows(spark, odd):
    got = op12_source_divergence(spark, odd).collect()
    assert {tuple(r) for r in got} == plain_divergence(rows_of(spark, odd)) and len(got) == len({tuple(r) for r in got})


def test_divergence_of_scripts_ties_and_lone_sources(spark, table):
    rows = [(k, f"Über straße {w} {w} 漢字 Ωmega x2y _a_b {'rare' * (k == 3)}", lang, source) for k, (w, lang, source) in enumerate(
        [("ab", "de", "a"), ("AB", "de", "b"), ("ab", "de", None), ("cd", "de", "c"), ("cd", "de", "a"), ("cd", "de", "b"), ("ef", "xx", "a"), ("ef", None, "a")] * 2
    )]
    rows += [(99, "1 2 3", "de", "none"), (98, None, "zz", "p"), (97, "once", "zz", "q")]
    got = {tuple(r) for r in divergence(spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")).collect()}
    assert got == plain_divergence(rows)
    assert ("zz", "p", "pair", "q", 0, 1) in got and not [r for r in got if r[0] == "xx" and r[2] == "pair"]


def test_ranks_of_terms_end_at_top(spark, table):
    rows = [(k, " ".join(f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(260)) if k < 6 else "other words here", "en", "ab"[k % 2 if k < 9 else 1]) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")
    assert {tuple(r) for r in divergence(df).collect()} == plain_divergence(rows)
    assert {tuple(r) for r in divergence(df, least=1, top=7).collect()} == plain_divergence(rows, 1, 7)


def plain_lines(rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    first, out = {}, []
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            first[k] = min((j for j in (i, first.get(k)) if j is not None), default=None)
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(key(x)) < 10 or first[key(x)] is None or (i is not None and i == first[key(x)])]
        out.append((i, len(lines), len(lines) - len(keep), hashlib.sha256("\n".join(keep).encode()).hexdigest(), "\n".join(keep)))
    return sorted(out, key=repr)


LINED = [
    (1, "A line that repeats\nanother line of text\nA line that repeats\n"), (2, "  a LINE that repeats\x0b\nown line number two"), (3, "short\nshort\n" * 3),
    (4, "a line that repeats\nÉcole line of text\n\n"), (5, "école line of text\nÉcole line of text"), (6, None), (7, ""), (8, "\n\n"), (9, "ten chars!\nnine char"),
    (10, "TEN CHARS!\nNINE CHAR"), (None, "a line that repeats\nonly without an id"), (None, "only without an id\n"), (12, "same id line here"), (12, "same id line here\n"),
    (13, "long " * 50_000 + "\n" + "long " * 50_000), (14, "x\n" + "long " * 50_000), (15, "\r\n\r\n"), (16, "漢字漢字漢字漢字漢字"), (17, "漢字漢字漢字漢字漢字 \n漢字漢字漢字漢字漢"),
]


def test_lines_on_odd_rows(spark, odd, table):
    folder = table(LINED)
    for path in (odd, folder):
        rows = [(r[0], r[1]) for r in rows_of(spark, path)]
        got = dedup_lines(spark.read.parquet(f"{path}/documents.parquet"), keep_text=True).collect()
        assert sorted(map(tuple, got), key=repr) == plain_lines(rows)
        assert sorted(map(tuple, op13_line_dedup(spark, path).collect()), key=repr) == sorted([r[:4] for r in plain_lines(rows)], key=repr)


def test_full_filters_only_suspect_more(spark):
    docs = spark.createDataFrame(LINED, "doc_id bigint, text string")
    got = dedup_lines(docs, most_bits=64, keep_text=True).collect()
    assert sorted(map(tuple, got), key=repr) == plain_lines(LINED)


def test_a_line_of_most_documents(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT_BYTES", 40)
    rows = [(i, f"all rights reserved here\nline of {i // 2} for two\n" + "x" * 60) for i in range(3000)]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id bigint, text string"), keep_text=True).collect()
    assert sorted(map(tuple, got), key=repr) == plain_lines(rows)


@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=30), min_size=1, max_size=6), st.sampled_from([64, 1024, 1 << 16]))
@settings(max_examples=50, deadline=None)
def test_merged_filters_miss_no_repeat(parts, bits):
    pairs = []
    for part in parts:
        pairs.append(Pair(bits))
        for h in (part[: len(part) // 2], part[len(part) // 2 :]):
            pairs[-1].add(np.array(h, np.uint64))
    once, twice = pairs[0].once, pairs[0].twice
    for p in pairs[1:]:
        twice, once = twice | p.twice | once & p.once, once | p.once
    n = Counter(h for part in parts for h in part)
    for h in (h for h, c in n.items() if c > 1):
        for place in line_dedup.places(np.array([h], np.uint64), bits):
            assert twice[int(place[0]) >> 3] >> (int(place[0]) & 7) & 1
