"""The operators that run in Spark's Python workers need no copy of the package there."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from haulyard.llm.queries import QUERIES
from haulyard.session import build_session, release
spark = build_session("ship", "local[4]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.sql.warehouse.dir": "w"}})
for name in ("op1_decontaminate", "op2_quality", "op3_token_counts", "op4_simhash", "op6_main_text", "op9_suffix_tree"):
    print("ROWS", name, QUERIES[name](spark, {data!r}).count())
release(spark)
spark.stop()
"""


def test_python_operators_run_from_another_folder(tmp_path, data):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=str(Path(__file__).resolve().parents[2]), data=data)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.stdout.count("ROWS") == 6, done.stderr[-2000:]
