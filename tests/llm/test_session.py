"""The operators in a session that names no shared folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: The pipeline runs operators 9, 1, 7, 3 and 4.
CODE = """
import __spark_entry__ as entry
from quarrylake.session import session
from quarrylake.llm.common import shared_dir
s = session("unset", spark__master="local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false")
assert s.conf.get("spark.checkpoint.dir", None) is None
for name in "op5_token_planes op10_toxicity op12_source_divergence op13_line_dedup pipeline".split():
    assert entry.queries()[name](s, "/root/testdata/sf0.001").count() > 0, name
assert shared_dir(s) == shared_dir(s)
print("all ran")
"""


def test_all_operators_run_without_a_shared_folder_setting(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT, "PYSPARK_SUBMIT_ARGS": "--driver-memory 3g pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", CODE], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]
