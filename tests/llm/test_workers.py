"""Every operator and the pipeline on workers that cannot import the repository."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})  # the driver's path only
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
spark.sparkContext.setLogLevel("ERROR")

def importable(batches):
    import pyarrow as pa
    try:
        import cabmetrics
    except ImportError:
        cabmetrics = None
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([cabmetrics is not None] * b.num_rows)], names=["found"])

assert not any(r[0] for r in spark.range(4).mapInArrow(importable, "found boolean").collect())
import __spark_entry__ as entry
queries = entry.queries()
for name in {names!r}:
    queries[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


@pytest.mark.parametrize("names", [("op1_pack", "op2_substring_dedup", "op5_decontaminate", "op6_exact_dedup", "op7_secrets", "op9_language"), ("op3_near_dedup", "op4_chat_format", "op8_fixity", "op10_pseudo_likelihood"), ("op11_merkle_manifest", "op12_simhash", "op13_fill_in_middle"), ("pipeline",)])
def test_without_the_package_on_workers(names, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    if "PYTHONPATH" in os.environ:  # what others put there stays
        env["PYTHONPATH"] = os.pathsep.join(p for p in os.environ["PYTHONPATH"].split(os.pathsep) if p and os.path.abspath(p) != REPO)
    script = SCRIPT.format(repo=REPO, shared=str(tmp_path / "shared"), names=names)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900, check=False)
    assert done.returncode == 0, done.stderr[-3000:]
    assert done.stdout.split() == [w for n in names for w in ("ran", n)]
