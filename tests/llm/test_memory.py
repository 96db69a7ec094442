"""What executors hold after an operator's many short stages, on a cluster of one executor."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent.parent
RUN = """
import re, sys, tempfile, time
import numpy as np
import psutil
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from linkloom.llm.storage import Workspace, lean

with tempfile.TemporaryDirectory() as where:
    conf = {"spark.master": "local-cluster[1,2,2000]", "spark.executor.memory": "1200m", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.checkpoint.dir": f"file://{where}"}
    spark = SparkSession.builder.config(map=conf).getOrCreate()

    def held(python):
        procs = [p for p in psutil.process_iter() if "CoarseGrainedExecutorBackend" in " ".join(p.cmdline()) and spark.sparkContext.applicationId in " ".join(p.cmdline())]
        procs = [c for p in procs for c in p.children(recursive=True)] if python else procs
        return sum(p.memory_info().rss for p in procs) >> 20

    spark.range(0, 3_000_000, 1, 2).select(F.array_sort(F.expr("transform(sequence(1, 40), x -> x * id)")).alias("x"), "id").sort("x").write.format("noop").mode("overwrite").save()
    grown = held(False)
    Workspace(spark, "test").release(executors=True)
    time.sleep(1)
    print("heap", grown, held(False))

    def kernel(batches):
        rows = [np.ones(100) for _ in range(300_000)]
        kept.append(np.ones(100))  # above the others, so that the heap's end can't just be cut
        del rows
        yield from batches

    kept = []
    for f in (kernel, lean(kernel)):
        spark.range(0, 1, 1, 1).mapInArrow(f, "id bigint").write.format("noop").mode("overwrite").save()
        time.sleep(1)
        print("python", held(True))
    spark.stop()
"""


def test_executors_give_memory_back(tmp_path):
    env = os.environ | {"PYTHONPATH": f"{REPO}:{os.environ.get('PYTHONPATH', '')}", "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1"}
    got = subprocess.run([sys.executable, "-c", RUN], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert got.returncode == 0, got.stderr[-2000:]
    said = [line.split() for line in got.stdout.splitlines()]
    (before, after), = [[int(x) for x in words[1:]] for words in said if words[0] == "heap"]
    assert after < 0.8 * before
    plain, given_back = [int(words[1]) for words in said if words[0] == "python"]
    assert given_back < plain - 100


DRIVER = """
import os
import numpy as np
import psutil
from pyspark.sql import SparkSession
from linkloom.llm.components import connected_components
from linkloom.llm.storage import Workspace

spark = SparkSession.builder.master("local[2]").config(map={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}).getOrCreate()
jvm = next(p for p in psutil.Process().children(recursive=True) if "java" in p.name())
space = Workspace(spark, "test")


def held():
    return [p.memory_info().rss >> 20 for p in (psutil.Process(), jvm)]


# the last of each stays, so that the heap's end can't just be cut
rows = [np.ones(100) for _ in range(300_000)]
kept = np.ones(100)
native = spark._jvm.org.apache.spark.unsafe.Platform
blocks = [native.allocateMemory(60_000) for _ in range(4_000)]
for block in blocks:
    native.setMemory(block, 1, 60_000)
del rows
for block in blocks[:-1]:
    native.freeMemory(block)
print("before", *held())
space.release()
print("after", *held())

calls = []
space.release = lambda *given: calls.append(given)
found = connected_components(spark.createDataFrame([(i, i + 1) for i in range(300)], "a bigint, b bigint"), space, "chain")
print("chain", found.where("comp = 0").count(), len(calls))
spark.stop()
"""


def test_driver_gives_memory_back(tmp_path):
    env = os.environ | {"PYTHONPATH": f"{REPO}:{os.environ.get('PYTHONPATH', '')}", "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_IP": "127.0.0.1"}
    got = subprocess.run([sys.executable, "-c", DRIVER], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert got.returncode == 0, got.stderr[-2000:]
    said = {words[0]: [int(x) for x in words[1:]] for words in map(str.split, got.stdout.splitlines())}
    assert all(after < before - 150 for before, after in zip(said["before"], said["after"])), said
    vertices, releases = said["chain"]
    assert vertices == 301
    assert releases >= 2
