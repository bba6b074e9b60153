"""Workers need no copy of the package: every query runs from a folder that does not hold it."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from tidedesk.llm.queries import LLM_QUERIES

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__ as contract
spark = (SparkSession.builder.master("local-cluster[1,2,1500]").config("spark.executor.memory", "1g")
         .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.executorEnv.PYTHONPATH", os.environ["SPARK_PYTHON"])
         .config("spark.checkpoint.dir", "file://" + os.getcwd() + "/shared").getOrCreate())
for name in sys.argv[1:]:
    print("ROWS", name, len(contract.queries()[name](spark, "/root/testdata/sf0.001").collect()))
"""


@pytest.mark.parametrize("names", [sorted(LLM_QUERIES)[:7], sorted(LLM_QUERIES)[7:]])
def test_every_query_runs_without_the_package_on_workers(tmp_path, names):
    import pyspark

    home = Path(pyspark.__file__).parent
    python = f"{home.parent}:{next(home.glob('python/lib/py4j*'), '')}"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_PYTHON": python, "SPARK_HOME": str(home)}
    env |= {"PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1", "SPARK_LOCAL_DIRS": str(tmp_path / "local"), "SPARK_WORKER_DIR": str(tmp_path / "work")}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=str(ROOT)), *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200
    )
    assert done.stdout.count("ROWS") == len(names), done.stdout[-500:] + done.stderr[-3000:]
