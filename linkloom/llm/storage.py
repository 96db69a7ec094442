"""Intermediate tables in the folder that the whole cluster shares.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading it again, so a lost executor costs one
stage and not the whole chain.  The folder is read from the session; only a local session without one (tests) gets a
temporary folder of its own.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master.startswith("local") and not master.startswith("local-cluster")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="shared-")
    return _own[app]


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


#: Bytes of rows that pass to a Python worker at a time; what a worker and the JVM hold for it follows this.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_BYTES, as whole texts make them large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = "".join(c for c in str(spark.conf.get(key)) if c.isdigit())
    if not now or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def lean(kernel):
    """An Arrow kernel that gives freed memory back to the system after each partition, as idle Python workers live on."""

    def run(batches):
        try:
            yield from kernel(batches)
        finally:
            _trim_process()

    return run


def _trim_process() -> None:
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def _trim_jvm(spark: SparkSession) -> None:
    """The same for the native heap of the driver's JVM, by HotSpot's own command; a JVM without it keeps what it has freed."""
    jvm, new = spark._jvm, spark.sparkContext._gateway.new_array
    kind, name = jvm.java.lang.Class, jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    given = [name, "systemTrimNativeHeap", new(jvm.java.lang.Object, 0), new(jvm.java.lang.String, 0)]
    kinds, values = new(kind, 4), new(jvm.java.lang.Object, 4)
    for i, x in enumerate(given):
        kinds[i], values[i] = kind.forName("java.lang.String") if i == 1 else x.getClass(), x
    try:  # by the interface, as the server's own class isn't open to reflection
        invoke = kind.forName("javax.management.MBeanServer").getMethod("invoke", kinds)
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)
    except Py4JJavaError:
        pass


class Workspace:
    """Tables of one run of one operator; what the result still reads stays until the application ends."""

    _roots: set[str] = set()

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        small_batches(spark)
        root = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"
        self.path = f"{root}/{tag}-{uuid.uuid4().hex[:12]}"
        if root not in Workspace._roots:
            Workspace._roots.add(root)
            atexit.register(self._forget, root)

    def _forget(self, root: str) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                _delete(self.spark, root)
        except Exception:  # the application has ended: the cluster's cleaner takes the folder
            pass

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            _delete(self.spark, f"{self.path}/{name}")

    def clear(self) -> None:
        """Deletes all tables of this workspace, which nothing may read any more."""
        _delete(self.spark, self.path)
        self.release(executors=True)

    def release(self, executors: bool = False) -> None:
        """Let Spark's cleaner remove the shuffle files of plans that nothing refers to any more.

        The driver, Python and JVM, gives back what it has freed: the plans and threads of many short jobs leave garbage in its
        heap and gaps in its native memory, which add up from step to step.
        executors: they collect too, by one small task for each core, so that heap and direct buffers that many short
        stages left behind go back to the system; else an executor's memory grows from stage to stage up to its limits.
        An executor that gets no such task just keeps its garbage.
        """
        gc.collect()
        self.spark._jvm.System.gc()
        _trim_process()
        _trim_jvm(self.spark)
        if executors and not _is_local(self.spark):
            n = self.spark.sparkContext.defaultParallelism
            self.spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')")).write.format("noop").mode("overwrite").save()
