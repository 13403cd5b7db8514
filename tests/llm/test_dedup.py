import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarrylake.llm import exact_dedup, near_dedup
from quarrylake.llm.components import components
from quarrylake.llm.queries import QUERIES

from .brute import SPACE, near_components
from .conftest import ODD


def plain_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(SPACE, " ", r[1] or "")].append(r[0])
    first = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(
        ((r[0], first[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for r in rows for t in [re.sub(SPACE, " ", r[1] or "")]), key=repr
    )


@pytest.mark.parametrize("digest_bytes, files", [(32, None), (1, None), (32, 1), (1, 2)])
def test_exact_dedup(spark, odd, digest_bytes, files):
    """A digest of one byte collides, so texts must be told apart by all their bytes; small batches meet kept state."""
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{odd}/documents.parquet")
    got = exact_dedup.exact_dedup(docs, digest_bytes=digest_bytes, files_per_batch=files).withColumn("sha", F.lower(F.hex("sha"))).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.sha) for r in got), key=repr) == plain_exact(ODD)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.sha for r in got}) and all(r.id == r.keep_id for r in kept)


def test_exact_dedup_of_rows_without_files(spark):
    df = spark.createDataFrame([(2, "a"), (1, "a"), (3, "b")], "doc_id bigint, text string")
    got = {r.id: (r.keep_id, r.kept) for r in exact_dedup.exact_dedup(df).collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True)}


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_a_second_delivery_is_held_against_the_first(spark, table, tmp_path, digest_bytes):
    first = [(5, "a b"), (7, "c"), (8, "c"), (9, "only here"), (None, None)]
    second = [(3, "a  b"), (6, "c"), (7, "c"), (20, "new"), (21, "new"), (22, ""), (30, "else")]
    state = f"file://{tmp_path}/state"
    deliver = lambda rows: exact_dedup.exact_dedup(spark.read.parquet(f"{table(rows)}/documents.parquet"), digest_bytes=digest_bytes, state=state).collect()
    one, two, none = deliver(first), deliver(second), deliver([])
    want = {(r[0], r[1], r[2]) for r in plain_exact(first + second)}
    assert {(r.id, r.keep_id, r.group_size) for r in one} == {(r[0], r[1], r[2]) for r in plain_exact(first)}
    assert len(two) == len(second) and {(r.id, r.keep_id, r.group_size) for r in two} <= want and none == []
    assert {r.id for r in two if r.kept} == {3, 6, 20, 22, 30}  # a smaller key than before takes over
    again = deliver([(2, "else"), (40, "c")])
    assert {(r.id, r.keep_id, r.group_size, r.kept) for r in again} == {(2, 2, 2, True), (40, 6, 5, False)}


@pytest.mark.parametrize("dies, named", [("nowhere", True), ("before the stream", False), ("after the stream", True), ("at the result", False)])
def test_a_delivery_that_comes_again_counts_once(spark, table, tmp_path, monkeypatch, dies, named):
    rows, state = [(1, "a"), (2, "b"), (3, "a"), (4, "a")], f"file://{tmp_path}/state"
    folder = table(rows)

    def deliver(path, name):
        # A named one may be a table that is made anew, and so is copied to other files.
        docs = spark.createDataFrame(rows, "doc_id bigint, text string") if named and path == folder else spark.read.parquet(f"{path}/documents.parquet")
        return {(r.id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs, files_per_batch=1, state=state, delivery=name if named else None).collect()}

    want = {(1, 1, 3, True), (2, 2, 1, True), (3, 1, 3, False), (4, 1, 3, False)}
    with monkeypatch.context() as m:
        real = exact_dedup._run_stream
        if dies == "before the stream":
            m.setattr(exact_dedup, "_run_stream", lambda *a: 1 / 0)
        elif dies == "after the stream":
            m.setattr(exact_dedup, "_run_stream", lambda *a: real(*a)[:0] or 1 / 0)
        elif dies == "at the result":
            m.setattr(exact_dedup, "_with_state", lambda *a: 1 / 0)
        if dies == "nowhere":
            assert deliver(folder, "day 1") == want
        else:
            with pytest.raises(ZeroDivisionError):
                deliver(folder, "day 1")
    assert deliver(folder, "day 1") == want
    assert deliver(folder, "day 1") == want
    assert deliver(table([(0, "b"), (9, "z")]), "day 2") == {(0, 0, 2, True), (9, 9, 1, True)}
    assert deliver(folder, "day 1") == {(1, 1, 3, True), (2, 0, 2, False), (3, 1, 3, False), (4, 1, 3, False)}  # as it is now


def test_rows_of_csv_files_have_no_locators_and_are_copied(spark, tmp_path):
    (tmp_path / "x.csv").write_text("2,a\n1,a\n3,b\n")
    docs = spark.read.schema("doc_id bigint, text string").csv(f"file://{tmp_path}/x.csv")
    assert {r.doc_id for r in exact_dedup.keep_first(spark, docs, "").collect()} == {1, 3}


def test_exact_query(spark, odd, empty):
    assert QUERIES["op1_exact_dedup"](spark, odd).count() == len(ODD) and QUERIES["op1_exact_dedup"](spark, empty).count() == 0


def varied(rng, base, edits):
    out = list(base)
    for _ in range(edits):
        out[rng.integers(len(out))] = f"new{rng.integers(1000)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def family():
    """Copies, near copies around the limit, a passage that all share, and strangers."""
    rng = np.random.default_rng(5)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for g in range(3):
        base = [f"g{g}w{i}" for i in range(80 + 150 * g)]
        rows += [varied(rng, base, int(e)) for e in rng.integers(0, 8 + 6 * g, 70)]
    rows += [" ".join([f"u{k}_{i}" for i in range(40)] + passage) for k in range(80)]
    rows += rows[:20]
    return [(i + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("short", [near_dedup.SHORT_LIST, 4])
def test_near_dedup_against_all_pairs(spark, table, family, monkeypatch, short):
    monkeypatch.setattr(near_dedup, "SHORT_LIST", short)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op7_near_dedup"](spark, table(family)).collect()}
    assert got == near_components(family)


def test_texts_of_one_id_are_all_compared(spark, table):
    base = [" ".join(f"{x}{i}" for i in range(40)) for x in "abc"]
    rows = [(5, base[0]), (5, base[1]), (1, base[0] + " end"), (2, base[1] + " end"), (7, base[2]), (9, base[2]), (9, base[1] + " or not"), (11, "x y")]
    got = QUERIES["op7_near_dedup"](spark, table(rows)).collect()
    assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (5, 1), (7, 1), (9, 1), (11, 11)}


def test_near_dedup_of_odd_rows(spark, odd, empty):
    got = QUERIES["op7_near_dedup"](spark, odd).collect()
    assert len(got) == len(ODD) and QUERIES["op7_near_dedup"](spark, empty).count() == 0
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == by[12].component_id == 1 and by[7].component_id == 6 and not by[7].kept
    assert all((r.n_shingles, r.component_id, r.kept) == (0, r.doc_id, True) for r in got if r.doc_id in (3, 4, 5))
    assert by[None].component_id is None and by[None].kept and by[8].n_shingles == 1


def test_near_dedup_on_the_small_table(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op7_near_dedup"](spark, small).collect()}
    assert got == near_components(rows)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="abAB \té\n", max_size=30), max_size=8))
def test_sets_are_those_of_the_words(texts):
    from .brute import shingles

    sets = list(near_dedup.shingle_sets(pa.array(texts, pa.string())))
    plain = [shingles(t) for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for a, p in zip(sets, plain):
        for b, q in zip(sets, plain):
            assert len(np.intersect1d(a, b)) == len(p & q)


def test_least_overlap_is_exact_for_small_sets():
    k = 16
    for n in range(1, k + 1):
        for m in range(n, n * 4 // 3 + 1):
            common = -(-75 * (n + m) // 175)
            assert near_dedup.least_overlap(n, k) <= common - max(0, m - k)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), min_size=1, max_size=30))
def test_components(spark, links):
    links = [(min(p), max(p)) for p in links if p[0] != p[1]]
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        u, v = sorted((find(a), find(b)))
        parent[v] = u
    table = spark.createDataFrame(links, "a bigint, b bigint")
    assert {tuple(r) for r in components(table).collect()} == {(x, find(x)) for x in parent}


def test_components_of_one_centre_with_very_many_links(spark):
    from pyspark.sql import functions as F

    from quarrylake.llm import components as module

    links = spark.range(1, 100_001).select(F.lit(0).cast("long").alias("a"), F.col("id").alias("b"))
    chain = spark.range(200_000, 200_050).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(links.union(chain))
    assert got.groupBy("component").count().orderBy("component").collect() == [(0, 100_001), (200_000, 51)]
    # The centre's links are dealt by node and part: no part holds much more than its share.
    dealt = links.groupBy(F.pmod(F.xxhash64("b"), F.lit(module.SALTS))).count().agg(F.max("count"), F.count("count")).first()
    assert dealt[1] == module.SALTS and dealt[0] < 2 * 100_000 / module.SALTS
