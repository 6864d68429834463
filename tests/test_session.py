"""A session that exists keeps its settings."""
import os
from cantora.session import build_session, ensure_checkpoint_dir


def test_existing_session_is_returned_unchanged(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert build_session(shuffle_partitions=3) is spark
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_checkpoint_folder_is_the_one_named(spark):
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_workers_have_the_package_wherever_the_driver_starts(tmp_path):
    """A new interpreter in another folder, without PYTHONPATH."""
    import subprocess
    import sys

    from conftest import ROOT
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
from cantora.session import ship
s = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
ship(s)
ship(s)
def work(batches):
    import cantora.sources.tables as t
    for b in batches:
        yield b
print("rows", s.range(3).mapInArrow(work, "id long").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 3" in out.stdout, out.stderr[-2000:]
