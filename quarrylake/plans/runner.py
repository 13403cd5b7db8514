"""Running the plans: a day's load of each source, then the graph of models with their tests.

Staging and union stay lazy (views); only marts are written, each as a new version of its table, so a table
is never read while it is overwritten.  A source that fails does not hold up the others or the models.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame

from ..functions.vocabulary import SOURCES
from ..operators.merge import merge_postings
from ..schemas import COMPANIES, FACT_TYPES, POSTINGS
from ..sources.lake import Lake
from ..sources.landing import boards, files_per_company, landed_files
from ..sources.parsers import PARSERS
from . import marts, quality
from .graph import Model, Outcome, run_models
from .staging import READS as STAGING_READS
from .staging import STAGING

log = logging.getLogger(__name__)
RUNS = "run_id string, model string, started_at timestamp, seconds double, status string"


def load_day(lake: Lake, landing: str, source: str, date: str, exact_files: int | None = None, failed: set[str] | None = None, written: dict[str, DataFrame] | None = None) -> dict[str, str]:
    """Check that the registered boards have landed, parse a day's files, replace the incoming table, merge it, and check both.

    ``failed``: the boards that the extract reports as failed; ``written`` gets the rows of the buckets that the merge wrote, for ``follow``.  Without a registered board of the
    source there is nothing to hold the files against.
    """
    files = landed_files(lake.spark, landing, source, date)
    expected = {r[0] for r in boards(lake.read("companies", COMPANIES), source).select("external_id").collect()}  # a registry has thousands of boards
    landed = {}
    if expected:
        seen = {r["company_slug"]: r["files"] for r in files_per_company(files.select("company_slug")).collect()}
        verdict, about = quality.files_verdict(expected, seen, failed)
        landed = {"files": verdict}
        if verdict != "pass":
            log.warning("%s: no files of %s", source, ", ".join(sorted(about)[:20]))
        if verdict == quality.ERROR:
            return landed
    incoming_ = lake.write(f"{source}_postings_incoming", PARSERS[source](files))
    done = lake.upsert(f"{source}_postings", POSTINGS[source], incoming_, lambda target, rows: merge_postings(source, target, rows))
    if written is not None:
        written[source] = done.written
    # Keys of other buckets cannot be the day's, so the rewritten buckets tell whether the merge was applied.
    verdicts = quality.load_verdicts(incoming_, done.written, exact_files if exact_files is not None else files.count(), exact_files is not None)
    for r in quality.posting_fill_rates(done.table).collect():  # one row a column
        log.info("%s.%s is filled to %s %%", source, r["column_name"], r["fill_percent"])
    return landed | verdicts | {"freshness": quality.freshness(done.table, datetime.now(timezone.utc)).first()["status"]}


def model_graph(lake: Lake, seeds: dict[str, DataFrame]) -> list[Model]:
    """All models: seeds, a staging model for each publisher, the union, the star and the serving table."""
    tested = {c.name.removesuffix(" key"): c for c in quality.seed_checks(seeds)}
    models = [Model(n, lambda f, df=df: df, checks=lambda f, n=n: [tested[n]] if n in tested else []) for n, df in seeds.items()]
    for s in SOURCES:
        models.append(Model(
            f"stg_{s}", lambda f, s=s: STAGING[s](lake.read(f"{s}_postings", POSTINGS[s]), f), STAGING_READS[s],
            lambda f, s=s: quality.staging_checks(s, f[f"stg_{s}"], f),
        ))
    return [
        *models,
        Model(
            "postings_unioned", lambda f: marts.postings_unioned({s: f[f"stg_{s}"] for s in SOURCES}, f["companies"]),
            (*(f"stg_{s}" for s in SOURCES), "companies"), lambda f: quality.union_checks(f["postings_unioned"]),
        ),
        Model("dim_country", lambda f: marts.dim_country(f["countries"]), ("countries",), lambda f: quality.country_checks(f["dim_country"]), stored=True),
        Model(
            "fct_job_postings", lambda f: marts.fct_job_postings(f["postings_unioned"]), ("postings_unioned", "dim_country"),
            lambda f: quality.fact_checks(f["fct_job_postings"], f["dim_country"]), stored=True,
        ),
        Model(
            "remote_jobs", lambda f: marts.remote_jobs(f["fct_job_postings"], f["dim_country"]), ("fct_job_postings", "dim_country"),
            lambda f: quality.remote_checks(f["remote_jobs"]), stored=True,
        ),
    ]


def build(lake: Lake, seeds: dict[str, DataFrame], companies: DataFrame | None = None) -> Outcome:
    """All models over the current state that can be built; a failed test stops what reads the model, and is raised at the end."""
    companies = companies if companies is not None else lake.read("companies", COMPANIES)
    out = run_models(lake, model_graph(lake, seeds), {"companies": companies})
    if out.failed:
        _stop_on_error(out.checks)
        raise ValueError(f"failed models: {', '.join(out.failed)}")
    lake.write("source_days", marts.last_days(out.frames["fct_job_postings"]))  # where ``follow`` goes on
    return out


FACT = ", ".join(f"{c} {kind}" for c, kind in FACT_TYPES.items())
DAYS = "source string, last_day date"


def follow(lake: Lake, seeds: dict[str, DataFrame], written: dict[str, DataFrame], companies: DataFrame | None = None) -> dict[str, str]:
    """Let the fact follow loads (rows by source, as ``load_day`` gives them) without building it anew; results of tests.

    Only the fact's buckets that hold changed or closing postings are written.  ``build`` makes the same fact from
    everything; it is also what starts one, and what a change of seeds or of the registry needs.
    """
    companies = companies if companies is not None else lake.read("companies", COMPANIES)
    staged = {s: STAGING[s](rows, seeds) for s, rows in written.items()}
    checks: dict[str, str] = {}
    for s, df in staged.items():
        checks |= quality.run_checks(quality.staging_checks(s, df, seeds))
    _stop_on_error(checks)
    if not staged:
        return checks
    changed, days = marts.postings_unioned(staged, companies), lake.read("source_days", DAYS)
    patch = lake.write("fct_job_postings_patch", marts.fact_patch(lake.read("fct_job_postings", FACT), days, changed))
    done = lake.upsert("fct_job_postings", FACT, patch, marts.replaced, key="posting_key")
    lake.write("source_days", marts.later_days(days, marts.last_days(patch)))
    countries = lake.write("dim_country", marts.dim_country(seeds["countries"]))
    remote = lake.write("remote_jobs", marts.remote_jobs(done.table, countries))
    checks |= quality.run_checks([*quality.country_checks(countries), *quality.fact_checks(done.written, countries), *quality.remote_checks(remote)])
    _stop_on_error(checks)
    return checks


def _stop_on_error(checks: dict[str, str]) -> None:
    failed = sorted(name for name, result in checks.items() if result == quality.ERROR)
    if failed:
        raise ValueError(f"failed checks: {', '.join(failed)}")


def run_all(lake: Lake, steps: dict[str, Callable[[], object]]) -> dict[str, str]:
    """Run steps one by one; note how each went and go on.  They are appended to ``runs``.

    A step's Spark jobs carry ``run/step`` as their group, by which event logs tell what it has read.
    """
    run, rows, results = uuid.uuid4().hex, [], {}
    context = lake.spark.sparkContext
    for name, step in steps.items():
        began, at = time.monotonic(), datetime.now(timezone.utc)
        context.setJobGroup(f"{run}/{name}", name)
        try:
            step()
            results[name] = "pass"
        except Exception as fault:  # one source's fault must not hold up the rest
            log.exception("step %s failed", name)
            results[name] = f"error: {fault}"[:500]
        finally:
            context.setLocalProperty("spark.jobGroup.id", None)
            context.setLocalProperty("spark.job.description", None)
        rows.append((run, name, at, time.monotonic() - began, results[name][:5]))
    lake.append("runs", lake.spark.createDataFrame(rows, RUNS))
    return results


def nightly(lake: Lake, landing: str, date: str, seeds: dict[str, DataFrame]) -> dict[str, str]:
    """Load every source's day, then build; a source that fails is reported and left out."""
    steps: dict[str, Callable[[], object]] = {s: lambda s=s: _raise_on_error(load_day(lake, landing, s, date)) for s in SOURCES}
    return run_all(lake, steps | {"models": lambda: build(lake, seeds)})


def _raise_on_error(verdicts: dict[str, str]) -> None:
    _stop_on_error(verdicts)
