"""The entry points on a session this package did not build, from another directory."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

CODE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
import __spark_entry__ as e
assert e.entry(spark).count() > 0
made = e.queries()
for name in ("latest_per_key", "html_links", "value_runs", "upsert_plan", "ingest_roundtrip"):
    assert made[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


def test_ordinary_session_in_another_process(tmp_path):
    done = subprocess.run([sys.executable, "-c", CODE.format(repo=str(REPO))], cwd=tmp_path, capture_output=True,
                          text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-2000:]


def test_prepare_changes_only_what_can_change(spark):
    from tidemark.session import RUNTIME_SETTINGS, prepare
    assert all(spark.conf.isModifiable(name) for name in RUNTIME_SETTINGS)
    prepare(spark)
