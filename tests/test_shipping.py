import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CODE = """
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {path!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.driver.memory", "512m").config("spark.executor.memory", "1g").config("spark.ui.enabled", "false").getOrCreate()
print("ROWS", entry.entry(spark).count())
"""


def test_executors_get_the_code(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"SPARK_SCALA_VERSION": "2.13"}
    code = CODE.format(path=f"{ROOT}/__spark_entry__.py")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS 50" in done.stdout, f"{done.stderr[:3000]}\n...\n{done.stderr[-1000:]}"
