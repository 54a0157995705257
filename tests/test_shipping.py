"""Functions that run in Spark's Python workers reach them without a copy of the package there."""

import os
import subprocess
import sys
from pathlib import Path

from haulyard import session

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import functions as F
from haulyard.plans import anomaly
from haulyard.session import build_session, release
spark = build_session("ship", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2", "spark.sql.warehouse.dir": "w"}})
rows = spark.range(200).select("id", F.lit("OLD").alias("vehicle_tier"), F.rand(1).alias("speed_kmh"), F.rand(2).alias("engine_rpm"))
print("FLAGGED", anomaly.detect(rows, trees=3).where("confirmed_anomaly = 1").count())
release(spark)
spark.stop()
"""


def test_python_operators_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=str(Path(__file__).resolve().parents[1]))
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "FLAGGED" in done.stdout and int(done.stdout.split()[-1]) > 0, done.stderr[-2000:]


def test_released_tables_are_gone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_folder", lambda _: str(tmp_path))
    assert session.materialise(spark.range(3)).count() == 3
    assert list(tmp_path.rglob("*.parquet"))
    session.release(spark)
    assert not list(tmp_path.rglob("*.parquet"))
