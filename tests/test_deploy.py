"""Deployment shape: the driver imports the repo from another working
directory and only adds it to its own sys.path. Queries with a Python
worker step must still run (functions are shipped by value)."""

import os
import subprocess
import sys
import textwrap

from conftest import ROOT, TEST_SF

SCRIPT = textwrap.dedent(f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark.sql import SparkSession
    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
    import __spark_entry__ as e
    q = e.queries()
    for name in ["rank_desc", "elo_ratings", "gini"]:
        assert q[name](spark, {TEST_SF!r}).count() > 0, name
    assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    print("DEPLOY_OK")
""")


def test_queries_run_from_foreign_cwd(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True,
                       timeout=900)
    assert "DEPLOY_OK" in r.stdout, r.stderr[-3000:]
