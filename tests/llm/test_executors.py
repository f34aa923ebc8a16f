"""All corpus queries where executors have no copy of the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

SF_DIR = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parent.parent.parent
CODE = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from tidemark.session import get_spark
from tidemark.llm.queries import QUERIES

def found(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.record_batch([pa.array([importlib.util.find_spec("tidemark") is not None])], names=["found"])

spark = get_spark("local[4]", **{{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.checkpoint.dir": "checkpoints"}})
assert not any(r.found for r in spark.range(8).mapInArrow(found, "found boolean").collect())
for name, query in QUERIES.items():
    query(spark, {SF_DIR!r}).write.format("noop").mode("overwrite").save()
    print("ran", name, flush=True)
"""


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
def test_executors_need_no_package(tmp_path):
    from tidemark.llm.queries import QUERIES

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    ran = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")]
    assert ran == list(QUERIES), done.stderr[-3000:]
