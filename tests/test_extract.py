"""Boards fetched by tasks, landed in two phases; one budget of details for all boards."""

import json
import os
from datetime import datetime, timezone

import pytest

from quarrylake.sources import extract, landing
from quarrylake.sources.extract import LandingWriter, budget_row, details_to_fetch, envelopes, fetch_details, finish_landing
from quarrylake.sources.parsers import PARSERS

REGISTRY = "name string, external_id string, ats string"
DAY = "2026-10-06"


def registry(spark, *slugs):
    return spark.createDataFrame([(s.upper(), s, "lever") for s in slugs] + [("Z", "z", "ashby")], REGISTRY)


def landed(root):
    return sorted(os.path.relpath(os.path.join(top, n), root) for top, _, names in os.walk(root) for n in names if "_landing" not in top)


def test_boards_are_landed_by_tasks(spark, tmp_path):
    answers = {f"b{i}": b"[%d]" % i for i in range(20)}
    got = extract.extract(spark, f"file://{tmp_path}", "lever", DAY, registry(spark, *answers, "gone"), answers.get, tasks=5)
    assert got == {"total": 21, "landed": 20, "failed": ["gone"]}
    files = landing.landed_files(spark, f"file://{tmp_path}", "lever", DAY)
    assert {(r.company_slug, r.content) for r in files.collect()} == {(k, v.decode()) for k, v in answers.items()}
    assert landing.files_per_company(files).where("files = 1").count() == 20
    with pytest.raises(ValueError, match="all 1 companies"):
        extract.extract(spark, f"file://{tmp_path}", "lever", DAY, registry(spark, "gone"), {}.get)
    with pytest.raises(ValueError, match="no company"):
        extract.extract(spark, f"file://{tmp_path}", "workable", DAY, registry(spark, "a"), {}.get)


def test_a_failed_extract_lands_nothing(spark, tmp_path):
    def fetch(slug):
        if slug == "bad":
            raise RuntimeError("no answer I know")
        return b"x"

    with pytest.raises(Exception, match="no answer"):
        extract.extract(spark, f"file://{tmp_path}", "lever", DAY, registry(spark, "a", "b", "bad", "c"), fetch, tasks=1)
    assert landed(tmp_path) == []
    got = extract.extract(spark, f"file://{tmp_path}", "lever", DAY, registry(spark, "a", "b", "c"), lambda s: b"x", tasks=2)
    assert got["landed"] == 3 and len(landed(tmp_path)) == 3


def rows(*slugs):
    return [{"slug": s, "fetched_at": datetime(2026, 10, 6, 1, 2, 3, tzinfo=timezone.utc), "body": None if s == "none" else bytearray(s.encode())} for s in slugs]


def test_a_lost_task_lands_nothing_twice(tmp_path):
    writer = LandingWriter(f"file://{tmp_path}", "lever", DAY, "run1")
    lost, again, other = writer.write(rows("a", "b")), writer.write(rows("a", "b")), writer.write(rows("c", "none"))
    assert lost.folder != again.folder and landed(tmp_path) == []
    writer.commit([again, None, other])
    assert landed(tmp_path) == [f"lever/ingest_date={DAY}/{s}/010203.json" for s in "abc"]
    assert json.loads((tmp_path / "_landing/run1.json").read_text()) == {"landed": 3, "failed": ["none"]} and os.listdir(tmp_path / "_landing") == ["run1.json"]


def test_a_commit_that_dies_is_finished(tmp_path, monkeypatch):
    writer = LandingWriter(f"file://{tmp_path}", "lever", DAY, "run1")
    message, moved, real = writer.write(rows(*"abcd")), [], os.makedirs
    with monkeypatch.context() as m:
        def dies(files, base, run):
            for staged, final in json.loads((tmp_path / f"_landing/{run}/plan.json").read_text())["moves"][:2]:
                real(os.path.dirname(tmp_path / final), exist_ok=True)
                os.rename(tmp_path / staged, tmp_path / final)
                moved.append(final)
            raise ZeroDivisionError

        m.setattr(extract, "_move", dies)
        with pytest.raises(ZeroDivisionError):
            writer.commit([message])
    assert len(landed(tmp_path)) == 2
    assert finish_landing(f"file://{tmp_path}") == ["run1"] and len(landed(tmp_path)) == 4
    assert finish_landing(f"file://{tmp_path}") == [] and finish_landing(f"file://{tmp_path}/nowhere") == []
    LandingWriter(f"file://{tmp_path}", "lever", DAY, "run2").abort([])


WANTED = [("a", 0, "A"), ("a", 1, "B"), ("a", 2, "A"), ("a", 3, "C"), ("b", 0, "D"), ("b", 1, "A"), ("c", 0, "E"), ("c", 1, "B"), ("c", 2, "F")]


def by_hand(known, budget):
    """Board after board, the unknown ids in order up to what is left."""
    out, left = [], max(budget, 0)
    for board in "abc":
        ids = list(dict.fromkeys(i for b, _, i in WANTED if b == board and i not in known))
        out += [(board, i) for i in ids[:left]]
        left -= len(ids[:left])
    return out


@pytest.mark.parametrize("known", [set(), {"B"}, set("ABCDEF")])
@pytest.mark.parametrize("budget", [-1, 0, 2, 4, 100])
def test_one_budget_for_all_boards(spark, known, budget):
    wanted = spark.createDataFrame(WANTED, "board string, pos bigint, id string").repartition(5)
    placed = details_to_fetch(wanted, spark.createDataFrame([(k,) for k in known], "id string"), budget)
    assert [(r.board, r.id) for r in placed.where("chosen").orderBy("place").collect()] == by_hand(known, budget)
    assert [r.place for r in placed.orderBy("place").collect()] == list(range(1, placed.count() + 1))


def test_details_stop_at_a_limit_and_go_into_envelopes(spark):
    wanted = spark.createDataFrame(WANTED, "board string, pos bigint, id string")
    none = spark.createDataFrame([], "id string")
    placed = details_to_fetch(wanted, none, 7)
    answers = {"A": (200, b'{"workplace": "hybrid", "salary_from": 5}'), "B": (500, None), "C": (429, None)}
    details = spark.createDataFrame(fetch_details(placed, lambda board, i: answers.get(i, (200, b"{}")), tasks=1).collect(), extract.DETAILS)
    assert [(r.board, r.id, r.status) for r in details.collect()] == [
        ("a", "A", "fetched"), ("a", "B", "failed"), ("a", "C", "deferred"), ("b", "D", "deferred"), ("b", "A", "deferred"), ("c", "E", "deferred"), ("c", "B", "deferred")
    ]
    row = budget_row(spark, DAY, placed, details, none).first()
    assert (row.chosen, row.fetched, row.deferred, row.rate_limited) == (7, 1, 6, True)
    lists = spark.createDataFrame([("a", json.dumps({"jobs": [{"shortcode": "A", "title": "x"}, {"shortcode": "B", "title": "y"}]})), ("b", '{"jobs": []}')], "board string, content string")
    made = envelopes(lists, details)
    files = made.selectExpr("concat('workable/d/', board, '/1.json') AS path", "board AS company_slug", "timestamp '2026-10-06' AS landed_at", "content")
    assert {(r.id, r.has_detail, r.workplace) for r in PARSERS["workable"](files).collect()} == {("A", True, "hybrid"), ("B", False, None)}


def test_a_detail_that_was_put_off_comes_first_next_time(spark):
    """What a run has fetched is known to the next; the rest keeps its order."""
    wanted = spark.createDataFrame(WANTED, "board string, pos bigint, id string")
    first = details_to_fetch(wanted, spark.createDataFrame([], "id string"), 3).where("chosen").select("id")
    known = spark.createDataFrame(first.distinct().collect(), "id string")
    assert [(r.board, r.id) for r in details_to_fetch(wanted, known, 9).where("chosen").orderBy("place").collect()] == by_hand({r.id for r in known.collect()}, 9)
