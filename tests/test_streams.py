"""Keyed state of arrivals: files in any order, with restarts, give what the days in their order give."""

import json
import os
import random
from datetime import datetime, timezone

import pytest

from quarrylake.operators.merge import merge_postings
from quarrylake.schemas import POSTINGS, struct
from quarrylake.sources.lake import Lake
from quarrylake.sources.parsers import PARSERS
from quarrylake.streaming.arrivals import join_states, keep_current, newest_states


def payload(source, day, ids, detailed):
    if source == "lever":
        return [{"id": f"l{i}", "text": f"t{day}-{i}", "hostedUrl": "u"} for i in ids]
    details = {f"w{i}": {"workplace": f"p{day}", "salary_from": day} for i in ids if i in detailed}
    return {"account": {"name": "W", "jobs": [{"shortcode": f"w{i}", "title": f"t{day}-{i}"} for i in ids]}, "details": details}


def at(day):
    return datetime(2026, 1, day, 6, tzinfo=timezone.utc)


def days_of(seed):
    """(day, ids, ids with details) of some days."""
    r = random.Random(seed)
    return [(d, sorted(r.sample(range(6), r.randrange(1, 5))), set(r.sample(range(6), 3))) for d in range(1, 7)]


def in_order(spark, source, days):
    rows = [(f"{source}/d/acme/x.json", "acme", at(d).replace(tzinfo=None), json.dumps(payload(source, d, ids, det))) for d, ids, det in days]
    table = spark.createDataFrame([], struct(POSTINGS[source]))
    for row in sorted(rows, key=lambda r: r[2]):
        files = spark.createDataFrame([row], "path string, company_slug string, landed_at timestamp, content string")
        table = spark.createDataFrame(merge_postings(source, table, PARSERS[source](files)).collect(), struct(POSTINGS[source]))
    return sorted(map(tuple, table.collect()), key=repr)


def land(root, source, day, body):
    folder = f"{root}/{source}/ingest_date=2026-01-{day:02d}/acme"
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/{day:06d}.json"
    with open(path, "w") as f:
        json.dump(body, f)
    os.utime(path, (at(day).timestamp(),) * 2)


@pytest.mark.parametrize("source, seed", [("workable", 1), ("lever", 3)])
def test_any_order_of_days_with_a_restart(spark, tmp_path, source, seed):
    days = days_of(seed)
    mixed = list(days)
    random.Random(seed + 10).shuffle(mixed)
    lake = Lake(spark, f"file://{tmp_path}/t", buckets=4)
    for part in (mixed[:2], mixed[2:3], [], mixed[3:]):
        for day, ids, detailed in part:
            land(f"{tmp_path}/landing", source, day, payload(source, day, ids, detailed))
        keep_current(lake, f"file://{tmp_path}/landing", source, f"file://{tmp_path}/cp", files_per_batch=2)
    assert sorted(map(tuple, lake.read(f"{source}_postings", POSTINGS[source]).collect()), key=repr) == in_order(spark, source, days)


def test_a_merge_that_dies_is_made_good(spark, tmp_path, monkeypatch):
    """The state has been written when the table's merge dies; the batch comes again."""
    source, days = "workable", days_of(5)
    for day, ids, detailed in days:
        land(f"{tmp_path}/landing", source, day, payload(source, day, ids, detailed))
    lake = Lake(spark, f"file://{tmp_path}/t", buckets=4)
    run = lambda: keep_current(lake, f"file://{tmp_path}/landing", source, f"file://{tmp_path}/cp", files_per_batch=1)
    with monkeypatch.context() as m:
        calls, real = [], Lake.upsert

        def dies(*a, **k):
            calls.append(1)
            if len(calls) == 2:
                raise ZeroDivisionError
            return real(*a, **k)

        m.setattr(Lake, "upsert", dies)
        with pytest.raises(Exception):
            run()
    run()
    assert sorted(map(tuple, lake.read("workable_postings", POSTINGS[source]).collect()), key=repr) == in_order(spark, source, days)


def test_a_batch_emits_changed_keys_only(spark, tmp_path, monkeypatch):
    lake = Lake(spark, f"file://{tmp_path}/t")
    seen = []
    real = Lake.upsert
    monkeypatch.setattr(Lake, "upsert", lambda self, table, schema, rows, merge: seen.append(sorted(r.id for r in rows.select("id").collect())) or real(self, table, schema, rows, merge))
    for day, ids in ((1, range(5)), (2, [3]), (3, [3, 9])):
        land(f"{tmp_path}/landing", "lever", day, payload("lever", day, ids, set()))
        keep_current(lake, f"file://{tmp_path}/landing", "lever", f"file://{tmp_path}/cp")
    assert [x for x in seen if x] == [[f"l{i}" for i in range(5)], ["l3"], ["l3", "l9"]]


def test_states_join_in_any_order(spark):
    source, days = "workable", days_of(7)
    states = []
    for d, ids, det in days:
        row = ("workable/d/acme/x.json", "acme", at(d).replace(tzinfo=None), json.dumps(payload(source, d, ids, det)))
        files = spark.createDataFrame([row], "path string, company_slug string, landed_at timestamp, content string")
        states.append(spark.createDataFrame(newest_states(PARSERS[source](files), source).collect(), struct(POSTINGS[source])))
    results = []
    for order in ([0, 1, 2, 3, 4, 5], [5, 0, 4, 1, 3, 2], [2, 2, 5, 1, 0, 3, 4, 0]):
        table = spark.createDataFrame([], struct(POSTINGS[source]))
        for k in order:
            table = spark.createDataFrame(join_states(table, states[k], source).collect(), struct(POSTINGS[source]))
        results.append(sorted(map(tuple, table.collect()), key=repr))
    assert results[0] == results[1] == results[2] == in_order(spark, source, days)
