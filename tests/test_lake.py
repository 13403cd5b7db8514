"""Versions by commits, and upserts that rewrite buckets."""

import threading
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrylake.operators.merge import merge_current_state
from quarrylake.sources.lake import Conflict, Lake, bucket_of

DDL = "id string, v bigint, first_seen_at timestamp, last_seen_at timestamp"


def at(day):
    return datetime(2026, 1, day)


def day(spark, n, ids):
    return spark.createDataFrame([(str(i), n * 1000 + int(i), at(n), at(n)) for i in ids], DDL)


def merged(target, source):
    return merge_current_state(target, source)


def state(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"file://{tmp_path}/t", keep=2)


def test_a_small_day_rewrites_few_buckets(spark, lake):
    lake.buckets = 64
    lake.upsert("x", DDL, day(spark, 1, range(6400)), merged)
    before = lake.head("x")
    assert len(before.files) == 64 and len({bucket_of(f) for f in before.files}) == 64
    ids = [3, 4, 7000]  # two known keys and a new one
    done = lake.upsert("x", DDL, day(spark, 2, ids), merged)
    after = lake.head("x")
    new = set(after.files) - set(before.files)
    assert len(new) == len(done.touched) <= 3 and {bucket_of(f) for f in new} == set(done.touched) == set(after.changed)
    assert len(after.files) == 64 and done.written.count() < 400
    rows = {r.id: r for r in lake.read("x", DDL).collect()}
    assert len(rows) == 6401 and rows["3"].v == 2003 and rows["3"].first_seen_at == at(1) and rows["5"].v == 1005
    assert lake.read("x", DDL, before.number).count() == 6400  # the version before is still there


def test_the_table_is_not_shuffled_by_a_merge(spark, lake):
    lake.upsert("x", DDL, day(spark, 1, range(500)), merged)
    plans = []

    def spied(target, source):
        out = merged(target, source)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    lake.upsert("x", DDL, day(spark, 2, range(5)), spied)
    assert plans[0].count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plans[0]


def test_only_touched_files_are_read(spark, lake):
    lake.buckets = 16
    lake.upsert("x", DDL, day(spark, 1, range(400)), merged)
    touched = spark.createDataFrame([("7",)], "id string").select(F.pmod(F.hash("id"), F.lit(16))).first()[0]
    for f in lake.head("x").files:  # whatever else is read would fail
        if bucket_of(f) != touched:
            place, files = lake._at(f"{lake.root}/x/data/{f}")
            files.create(place, True).close()
    assert lake.upsert("x", DDL, day(spark, 3, [7]), merged).touched == (touched,)


def test_versions_are_tidied(spark, lake):
    for n in range(1, 6):
        lake.upsert("x", DDL, day(spark, n, [n, 9]), merged)
    assert lake._numbers("x") == [4, 5] and lake.version("x") == 5
    live = set(lake.head("x").files) | set(lake._commit("x", 4).files)
    found = {f"{w}/{n}" for w in lake._names(f"{lake.root}/x/data") for n in lake._names(f"{lake.root}/x/data/{w}") if n.endswith(".parquet")}
    assert found == live and lake.read("x", DDL).count() == 6


def test_rebucket_and_replace(spark, lake):
    lake.upsert("x", DDL, day(spark, 1, range(100)), merged)
    lake.rebucket("x", DDL, 3)
    assert lake.head("x").buckets == 3 and lake.read("x", DDL).count() == 100
    lake.upsert("x", DDL, day(spark, 2, [1, 200]), merged)
    assert lake.head("x").buckets == 3 and lake.read("x", DDL).count() == 101
    lake.write("x", day(spark, 3, [5]))
    assert state(lake.read("x", DDL)) == state(day(spark, 3, [5]))
    lake.upsert("x", DDL, day(spark, 4, [5, 6]), merged)
    assert [r[:2] for r in state(lake.read("x", DDL))] == [("5", 4005), ("6", 4006)]
    with pytest.raises(ValueError, match="bucketed by id"):
        lake.upsert("x", DDL, day(spark, 4, [5]), merged, key="v")


def test_nothing_to_merge_is_no_version(spark, lake):
    done = lake.upsert("x", DDL, day(spark, 1, []).limit(0), merged)
    assert lake.version("x") is None and done.touched == () and done.table.count() == 0 and done.written.count() == 0


STEPS = ["data", "draft", "publish", "tidy"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("first", [True, False])
def test_a_write_that_dies_leaves_the_table(spark, lake, monkeypatch, step, first):
    if not first:
        lake.upsert("x", DDL, day(spark, 1, [1, 2]), merged)
        lake.upsert("x", DDL, day(spark, 2, [2]), merged)
    before = state(lake.read("x", DDL))
    with monkeypatch.context() as m:
        if step == "data":  # part files lie there, no commit does
            m.setattr(Lake, "_made", lambda *a: 1 / 0)
        elif step == "draft":
            m.setattr("quarrylake.sources.lake.os.link", lambda *a: 1 / 0)
        elif step == "publish":
            m.setattr(Lake, "_publish", lambda *a: 1 / 0)
        else:  # published, not tidied
            m.setattr(Lake, "_tidy", lambda *a: 1 / 0)
        for make in (lambda: lake.upsert("x", DDL, day(spark, 3, [1, 7]), merged), lambda: lake.write("y", day(spark, 3, [1]))):
            with pytest.raises(ZeroDivisionError):
                make()
    if step != "tidy":
        assert state(lake.read("x", DDL)) == before and lake.version("y") is None
    lake.upsert("x", DDL, day(spark, 3, [1, 7]), merged)
    want = {"1": 3001, "7": 3007} | ({} if first else {"2": 2002})
    assert {r.id: r.v for r in lake.read("x", DDL).collect()} == want
    assert lake.write("y", day(spark, 3, [1])).count() == 1


def test_two_writers_from_one_base(spark, lake, monkeypatch):
    """The second has merged when the first commits: with a shared bucket it merges again, else its files join."""
    for ids, again in (((2, 3), True), (None, False)):
        table = f"t{again}"
        lake.buckets = 1 if again else 64
        lake.upsert(table, DDL, day(spark, 1, [1]), merged)
        if ids is None:  # keys of different buckets
            by = {}
            for r in spark.range(50).select(F.col("id").cast("string").alias("id"), F.pmod(F.hash(F.col("id").cast("string")), F.lit(64)).alias("b")).collect():
                by.setdefault(r.b, r.id)
            ids = sorted(by.values(), key=int)[1:3]
        merges = []

        def slow(target, source):
            merges.append(1)
            if len(merges) == 1:  # another writer is faster
                lake.upsert(table, DDL, day(spark, 2, [ids[0]]), merged)
            return merged(target, source)

        lake.upsert(table, DDL, day(spark, 3, [ids[1]]), slow)
        assert len(merges) == (2 if again else 1)
        assert {r.id: r.v for r in lake.read(table, DDL).collect()} == {"1": 1001, str(ids[0]): 2000 + int(ids[0]), str(ids[1]): 3000 + int(ids[1])}
        assert lake.version(table) == 3


def test_writers_in_threads(spark, lake):
    faults = []

    def work(n):
        try:
            lake.upsert("x", DDL, day(spark, n, [0, n]), merged)
        except Exception as e:
            faults.append(e)

    threads = [threading.Thread(target=work, args=(n,)) for n in range(1, 6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not faults
    rows = {r.id: r for r in lake.read("x", DDL).collect()}
    assert set(rows) == {str(n) for n in range(6)} and rows["0"].v == 5000 and rows["0"].first_seen_at == at(1)


def test_a_writer_that_always_loses_says_so(spark, lake, monkeypatch):
    lake.attempts = 2
    lake.upsert("x", DDL, day(spark, 1, [1]), merged)
    monkeypatch.setattr(Lake, "_join_history", lambda *a: None)
    with pytest.raises(Conflict):
        lake.upsert("x", DDL, day(spark, 2, [1]), merged)
    monkeypatch.setattr(Lake, "_publish", lambda *a: False)
    with pytest.raises(Conflict):
        lake.write("y", day(spark, 2, [1]))


@given(st.lists(st.tuples(st.integers(1, 9), st.lists(st.integers(0, 12), min_size=1, max_size=5, unique=True)), min_size=1, max_size=4))
@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_buckets_equal_one_merge_of_the_whole(spark, tmp_path_factory, days):
    lake = Lake(spark, f"file://{tmp_path_factory.mktemp('p')}/t", buckets=4)
    whole = day(spark, 1, []).limit(0)
    for n, ids in days:
        rows = day(spark, n, ids)
        lake.upsert("x", DDL, rows, merged)
        whole = spark.createDataFrame(merged(whole, rows).collect(), DDL)
    assert state(lake.read("x", DDL)) == state(whole)
