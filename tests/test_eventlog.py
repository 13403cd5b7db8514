"""Jobs from event logs: a log that Spark wrote against a count by hand, and a log made by hand."""

import json
import os
import subprocess
import sys
from collections import defaultdict
from datetime import datetime, timezone

from quarrylake.plans import analytics
from quarrylake.sources.eventlog import events, jobs, step_reads

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import sys
from pyspark.sql import functions as F
from quarrylake.plans.runner import run_all
from quarrylake.session import session
from quarrylake.sources.lake import Lake
logs, root = sys.argv[1:]
s = session("logged", spark__master="local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false", spark__eventLog__enabled="true",
            spark__eventLog__dir=logs, spark__eventLog__compress="false", spark__eventLog__rolling__enabled=sys.argv[2][-1] == "r" and "true" or "false")
orders = lambda: s.read.parquet("/root/testdata/sf0.001/orders.parquet")
print(run_all(Lake(s, root), {"count": lambda: orders().groupBy("o_orderstatus").count().collect(), "sum": lambda: orders().agg(F.sum("o_totalprice")).collect(), "bad": lambda: s.range(3).select(F.raise_error(F.lit("no"))).collect()}))
orders().count()
s.stop()
"""


def by_hand(folder):
    """For each job: bytes read, tasks and whether it passed, from the lines as they are."""
    out = {}
    for top, _, names in os.walk(folder):
        for name in names:
            if name.startswith((".", "appstatus")):
                continue
            for line in open(os.path.join(top, name)):
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    out[e["Job ID"]] = {"stages": e["Stage IDs"], "bytes": 0, "tasks": 0, "step": e["Properties"].get("spark.jobGroup.id")}
                elif e["Event"] == "SparkListenerJobEnd":
                    out[e["Job ID"]]["ok"] = e["Job Result"]["Result"] == "JobSucceeded"
                elif e["Event"] == "SparkListenerTaskEnd":
                    job = min(j for j, x in out.items() if e["Stage ID"] in x["stages"])
                    out[job]["tasks"] += 1
                    out[job]["bytes"] += (e.get("Task Metrics") or {}).get("Input Metrics", {}).get("Bytes Read", 0)
    return out


def written(tmp_path, rolling):
    logs, root = tmp_path / "logs", tmp_path / ("lake-r" if rolling else "lake-p")
    logs.mkdir()
    env = os.environ | {"PYTHONPATH": ROOT}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    done = subprocess.run([sys.executable, "-c", CODE, f"file://{logs}", f"file://{root}"], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "'count': 'pass'" in done.stdout, done.stderr[-2000:]
    return str(logs)


def test_a_log_that_spark_wrote(spark, tmp_path):
    for rolling in (False, True):
        folder = tmp_path / str(rolling)
        folder.mkdir()
        logs = written(folder, rolling)
        want = by_hand(logs)
        got = {r.job_id: r for r in jobs(events(spark, f"file://{logs}")).collect()}
        assert set(got) == set(want) and len({r.application for r in got.values()}) == 1
        for k, x in want.items():
            assert (got[k].bytes_read, got[k].tasks, got[k].step) == (x["bytes"], x["tasks"], x["step"])
            assert got[k].status == ("pass" if x["ok"] else "error") and got[k].seconds >= 0
        assert sum(x["bytes"] for x in want.values()) > 0 and {r.status for r in got.values()} == {"pass", "error"}
        steps = {r.step.split("/")[1]: r for r in step_reads(jobs(events(spark, f"file://{logs}"))).collect()}
        assert set(steps) == {"count", "sum", "bad"} and steps["sum"].bytes_read > 0


def line(kind, **fields):
    return json.dumps({"Event": f"SparkListener{kind}", **fields})


def task(stage, read, reason="Success"):
    return line("TaskEnd", **{"Stage ID": stage, "Task End Reason": {"Reason": reason}, "Task Metrics": {"Executor Run Time": 10, "Input Metrics": {"Bytes Read": read, "Records Read": 1}}})


def test_a_log_made_by_hand(spark, tmp_path):
    """A stage that two jobs list counts for the first; a job may not have ended; odd lines are nothing."""
    ms = lambda day, hour=0: int(datetime(2026, 1, day, hour, tzinfo=timezone.utc).timestamp() * 1000)
    start = lambda job, at, stages: line("JobStart", **{"Job ID": job, "Submission Time": at, "Stage IDs": stages, "Properties": {"spark.jobGroup.id": f"g{job % 2}"}})
    end = lambda job, at, how="JobSucceeded": line("JobEnd", **{"Job ID": job, "Completion Time": at, "Job Result": {"Result": how}})
    gib = 1 << 30
    a = [line("LogStart"), start(0, ms(1), [0, 1]), task(0, gib), task(1, gib // 2), task(1, gib // 2, "TaskKilled"), end(0, ms(1, 1)), start(1, ms(2), [1, 2]), task(2, gib), line("TaskEnd", **{"Stage ID": 2}), end(1, ms(2, 2), "JobFailed"), start(2, ms(3), [3])]
    b = [start(0, ms(1, 5), [0]), task(0, 3 * gib), end(0, ms(1, 6)), "{not json"]
    (tmp_path / "app-1").write_text("\n".join(a))
    (tmp_path / "app-2.inprogress").write_text("\n".join(b))
    found = jobs(events(spark, f"file://{tmp_path}"))
    got = {(r.application, r.job_id): r for r in found.collect()}
    assert {k: (r.bytes_read // (gib // 2), r.tasks, r.status) for k, r in got.items()} == {
        ("app-1", 0): (4, 3, "pass"), ("app-1", 1): (2, 2, "error"), ("app-1", 2): (0, 0, "running"), ("app-2", 0): (6, 1, "pass"),
    }
    assert got["app-1", 0].seconds == 3600 and got["app-1", 0].task_seconds == 0.03
    assert {(r.application, r.step): r.jobs for r in step_reads(found).collect()} == {("app-1", "g0"): 2, ("app-1", "g1"): 1, ("app-2", "g0"): 1}
    days = defaultdict(float)
    for r in analytics.daily_reads(found, days=100_000).collect():
        days[str(r.day)] = (r.gb_read, r.jobs)
    assert days == {"2026-01-01": (5.0, 2), "2026-01-02": (1.0, 1), "2026-01-03": (0.0, 1)}
    assert analytics.month_reads(found).first().gb is None
