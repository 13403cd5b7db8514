"""The graph of models: order, tests, and what a failure stops."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarrylake.plans import quality
from quarrylake.plans.graph import Model, descendants, ordered, run_models
from quarrylake.plans.runner import FACT, build, follow, load_day, model_graph
from quarrylake.schemas import SEEDS
from quarrylake.sources import landing
from quarrylake.sources.lake import Lake
from quarrylake.functions.vocabulary import SOURCES
from quarrylake.sources import seeds as seed_tables

from .test_postings import words  # noqa: F401  (a fixture)


def model(name, *reads, **more):
    return Model(name, lambda f: None, reads, **more)


def test_order_and_faults_of_a_graph():
    models = [model("d", "b", "c"), model("b", "a"), model("c", "a"), model("a", "given")]
    order = [m.name for m in ordered(models, ["given"])]
    assert order.index("a") < min(order.index("b"), order.index("c")) and order[-1] == "d"
    assert descendants(models, "b") == {"d"} and descendants(models, "a") == {"b", "c", "d"} and descendants(models, "d") == set()
    with pytest.raises(ValueError, match="nothing makes"):
        ordered(models)
    with pytest.raises(ValueError, match="two models"):
        ordered([model("a"), model("a")])
    with pytest.raises(ValueError):
        ordered([model("a", "b"), model("b", "a")])


def test_a_failure_stops_its_descendants_only(spark, tmp_path):
    lake = Lake(spark, f"file://{tmp_path}/t")
    made = []

    def make(name, rows, *reads, bad=False, warn=False, dies=False, stored=False):
        def build_it(frames):
            made.append(name)
            assert set(frames) == set(reads)
            return 1 / 0 if dies else spark.range(rows)

        check = lambda f: [quality.Check(f"{name} empty", lambda: f[name], quality.WARN if warn else quality.ERROR)] if bad or warn else []
        return Model(name, build_it, reads, check, stored)

    out = run_models(lake, [
        make("wide", 2, "left", "right"), make("left", 1, "base", bad=True), make("right", 3, "base", stored=True), make("base", 1, "raw", warn=True),
        make("leaf", 2, "right"), make("dead", 2, "base", dies=True), make("under", 1, "dead"), make("deep", 1, "wide"),
    ], {"raw": spark.range(1)})
    assert out.models == {"base": "warn", "left": "error", "right": "pass", "wide": "skipped", "deep": "skipped", "leaf": "pass", "dead": "error", "under": "skipped"}
    assert out.failed == ["dead", "left"] and set(made) == {"base", "left", "right", "leaf", "dead"}
    assert lake.read("right", "id bigint").count() == 3 and lake.version("left") is None
    assert out.checks == {"base empty": "warn", "left empty": "error"}


def test_one_publishers_failure_leaves_the_other_models(spark, words, tmp_path):  # noqa: F811
    """A posting with a word that no table knows fails its publisher's test; other staging models and the countries are built."""
    root = f"file://{tmp_path}"
    at = datetime(2026, 10, 6, 6, 0, 0)
    lever = [{"id": "l1", "text": "Dev", "hostedUrl": "u", "workplaceType": "remote"}]
    ashby = {"jobs": [{"id": "a1", "title": "Dev", "jobUrl": "u", "workplaceType": "from the moon"}]}
    for source, body in (("lever", lever), ("ashby", ashby)):
        landing.write_bytes(spark, f"{root}/landing/{landing.landed_path(source, '2026-10-06', 'acme', at)}", json.dumps(body).encode())
    lake = Lake(spark, f"{root}/t")
    for source in ("lever", "ashby"):
        load_day(lake, f"{root}/landing", source, "2026-10-06")
    companies = spark.createDataFrame([("Acme", "acme", "lever")], "name string, external_id string, ats string")
    out = run_models(lake, model_graph(lake, words), {"companies": companies})
    assert out.models["stg_ashby"] == "error" and all(out.models[f"stg_{s}"] == "pass" for s in SOURCES if s != "ashby")
    assert out.models["dim_country"] == "pass" and lake.version("dim_country") == 1
    assert {m for m, end in out.models.items() if end == "skipped"} == {"postings_unioned", "fct_job_postings", "remote_jobs"}
    assert out.frames["stg_lever"].select("workplace_type").first()[0] == "remote"
    with pytest.raises(ValueError, match="failed checks: ashby workplace_type not null"):
        build(lake, words, companies)


def test_a_whole_build(spark, words, tmp_path):  # noqa: F811
    root = f"file://{tmp_path}"
    lever = [{"id": f"l{k}", "text": "Dev", "hostedUrl": "u", "workplaceType": "remote", "country": "BR"} for k in range(3)]
    landing.write_bytes(spark, f"{root}/landing/{landing.landed_path('lever', '2026-10-06', 'acme', datetime(2026, 10, 6))}", json.dumps(lever).encode())
    lake = Lake(spark, f"{root}/t")
    load_day(lake, f"{root}/landing", "lever", "2026-10-06")
    out = build(lake, words)
    assert not out.failed and set(out.models.values()) <= {"pass", "warn"}
    assert out.frames["fct_job_postings"].where(F.col("is_open")).count() == 3 and out.frames["remote_jobs"].count() == 3
    assert set(SEEDS) <= set(out.models) and seed_tables


def test_a_fact_that_follows_loads_is_the_one_that_is_built(spark, words, tmp_path):  # noqa: F811
    """Two days of two publishers: postings go, come and change; one publisher has no second day."""
    root = f"file://{tmp_path}"

    def land(source, day, body):
        path = landing.landed_path(source, f"2026-10-{day:02d}", "acme", datetime(2026, 10, day))
        landing.write_bytes(spark, f"{root}/landing/{path}", json.dumps(body).encode())
        os.utime(f"{tmp_path}/landing/{path}", (datetime(2026, 10, day, 12).timestamp(),) * 2)

    posting = lambda k, title: {"id": f"l{k}", "text": title, "hostedUrl": "u", "workplaceType": "remote", "country": "BR"}
    land("lever", 6, [posting(k, "old") for k in range(6)])
    land("ashby", 6, {"jobs": [{"id": "a1", "title": "Dev", "jobUrl": "u", "workplaceType": "Remote"}]})
    land("lever", 7, [posting(k, "new") for k in (1, 2, 9)])
    lake = Lake(spark, f"{root}/t", buckets=4)
    for source in ("lever", "ashby"):
        load_day(lake, f"{root}/landing", source, "2026-10-06")
    build(lake, words)
    written = {}
    load_day(lake, f"{root}/landing", "lever", "2026-10-07", written=written)
    assert set(follow(lake, words, written).values()) <= {"pass", "warn"} and follow(lake, words, {}) == {}
    followed = sorted(map(tuple, lake.read("fct_job_postings", FACT).collect()))
    assert {r[0]: r[-1] for r in followed} == {f"lever/l{k}": k in (1, 2, 9) for k in (0, 1, 2, 3, 4, 5, 9)} | {"ashby/a1": True}
    remote = lake.read("remote_jobs", "posting_key string").count()
    out = build(lake, words)
    assert sorted(map(tuple, out.frames["fct_job_postings"].collect())) == followed and out.frames["remote_jobs"].count() == remote
