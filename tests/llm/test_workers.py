"""Every operator and the pipeline on workers that cannot import the package."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
spark.sparkContext.setLogLevel("OFF")

@F.udf("string")
def seen(x):
    import importlib.util
    return str(importlib.util.find_spec("eventlake"))

assert spark.range(1).select(seen("id")).first()[0] == "None", "the workers know the package"
import __spark_entry__
for name, query in __spark_entry__.queries().items():
    if name.startswith("op") or name == "pipeline":
        try:
            query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
        except Exception as e:
            print("FAILED", name, str(e)[-500:])
        else:
            print("DONE", name)
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(repo=REPO, shared=str(tmp_path / "shared"))
    ran = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert "FAILED" not in ran.stdout, ran.stdout
    from eventlake.llm.queries import QUERIES

    assert {line.split()[1] for line in ran.stdout.splitlines() if line.startswith("DONE")} == {*QUERIES, "pipeline"}
