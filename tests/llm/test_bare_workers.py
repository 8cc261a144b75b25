"""Executors need no copy of the package: the queries run where workers cannot import it."""
import os
import subprocess
import sys

from conftest import ROOT

SCRIPT = """
import sys
sys.path.insert(0, {root!r})                      # the driver alone
from pyspark.sql import SparkSession
from txwatch.llm import catalog
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())

def found(batches):
    import importlib.util
    for b in batches:
        yield b.assign(n=int(importlib.util.find_spec("txwatch") is not None))

assert spark.range(2).withColumnRenamed("id", "n").mapInPandas(found, "n long").groupBy().sum("n").first()[0] == 0
for key in {keys!r}:
    print(key, catalog.QUERIES[key](spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_queries_run_without_the_package_on_workers(tmp_path):
    from txwatch.llm.catalog import QUERIES

    keys = [k for k in QUERIES if not k.startswith("op6_")]      # op6 takes minutes; its objects are functions and arrays
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, keys=keys)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stderr[-3000:]
    rows = dict(line.split() for line in done.stdout.splitlines() if line.startswith("op"))
    assert list(rows) == keys and all(int(n) > 0 for k, n in rows.items() if k != "op13_collocations")
