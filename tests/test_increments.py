"""Counts that add up, and a fact that follows loads without being built anew."""

from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarrylake.operators.distinct import bitmaps, dictionary, sizes, united
from quarrylake.plans import marts
from quarrylake.schemas import OPTIONAL, UNIONED
from quarrylake.sources.lake import Lake

ROWS = "day int, source string, company string"


@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["a", "b"]), st.one_of(st.none(), st.integers(0, 40).map(str))), max_size=60))
@settings(max_examples=3, deadline=None)
def test_distinct_counts_of_any_span_of_days(spark, rows):
    ids, sets = None, None
    for day in range(1, 5):  # the dictionary grows by the day; a day's sets are made once
        own = spark.createDataFrame([r for r in rows if r[0] == day], ROWS)
        ids = spark.createDataFrame(dictionary(own, "company", ids).collect(), "value string, id bigint")
        made = spark.createDataFrame(bitmaps(own, "company", ids, "day", "source").collect(), "day int, source string, part bigint, bitmap binary")
        sets = made if sets is None else sets.unionByName(made)
    assert sorted(r.id for r in ids.collect()) == list(range(len({c for _, _, c in rows if c is not None})))
    for low, high in ((1, 4), (2, 3), (4, 4)):
        span = sets.where(F.col("day").between(low, high))
        got = {r.source: r["distinct"] for r in sizes(span, "source").collect()}
        want = {s: len({c for d, t, c in rows if t == s and low <= d <= high and c is not None}) for s in "ab"}
        assert got == {s: n for s, n in want.items() if n}
        assert (sizes(united(span, "source")).first() or [None])[0] == (len({c for d, _, c in rows if low <= d <= high and c is not None}) or None)


def test_ids_beyond_one_bitmap(spark):
    rows = spark.range(100_000).select((F.col("id") % 70_001).cast("string").alias("company"), (F.col("id") % 3).alias("g"))
    ids = dictionary(rows, "company")
    got = {r.g: r.n for r in sizes(bitmaps(rows, "company", ids, "g"), "g", name="n").collect()}
    assert got == {r.g: r.n for r in rows.groupBy("g").agg(F.countDistinct("company").alias("n")).collect()}
    assert ids.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first()[:] == (0, 70_000, 70_001)


KINDS = {c: "string" for c in UNIONED} | OPTIONAL | {c: "timestamp" for c in ("published_at", "first_seen_at", "last_seen_at")}
UNION_DDL = ", ".join(["posting_key string", *(f"{c} {KINDS[c]}" for c in UNIONED), "company_name string"])


def postings(spark, rows):
    """Union rows from (source, id, last day)."""
    made = []
    for source, i, day in rows:
        row = dict.fromkeys(UNIONED) | {"source": source, "source_job_id": str(i), "title": f"{i} on {day}", "last_seen_at": datetime(2026, 1, day, 7), "first_seen_at": datetime(2026, 1, day, 7)}
        made.append((f"{source}/{i}", *row.values(), None))
    return spark.createDataFrame(made, UNION_DDL)


load = st.tuples(st.sampled_from(["a", "b"]), st.integers(1, 9), st.lists(st.integers(0, 5), min_size=1, max_size=4, unique=True))


@given(st.lists(load, min_size=1, max_size=4))
@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_patches_equal_a_full_build(spark, tmp_path_factory, loads):
    """After any loads, late days and repeated ones too."""
    lake = Lake(spark, f"file://{tmp_path_factory.mktemp('f')}/t", buckets=4)
    current: dict = {}
    fact_ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in marts.fct_job_postings(postings(spark, [])).schema)
    days_ddl = "source string, last_day date"
    for source, day, ids in loads:
        written = {(source, i): max(day, current.get((source, i), 0)) for i in ids}
        current |= written
        changed = postings(spark, [(*k, d) for k, d in written.items()])
        fact, days = lake.read("fact", fact_ddl), lake.read("days", days_ddl)
        patch = spark.createDataFrame(marts.fact_patch(fact, days, changed).collect(), fact.schema)
        lake.upsert("fact", fact_ddl, patch, marts.replaced, key="posting_key")
        lake.write("days", spark.createDataFrame(marts.later_days(days, marts.last_days(changed)).collect(), days_ddl))
        whole = marts.fct_job_postings(postings(spark, [(*k, d) for k, d in current.items()]))
        assert sorted(map(tuple, lake.read("fact", fact_ddl).collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
