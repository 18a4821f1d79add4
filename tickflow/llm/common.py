"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import functools
import math
import sys
import tempfile
import time
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.session import work_path

# fixed values: the white space that separates words in every operator here
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Spark's setting that removes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: From this share of its largest heap on, the driver's JVM is asked to shrink a heap that has grown.
HEAP_SHARE = 0.5
#: Seconds between two such requests, at least.
GIVE_BACK_S = 5


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared checkpoint folder and read it back.

    Later steps then start from stored files: a lost executor costs no more than its own tasks,
    nothing is computed twice, and the planner knows the table's real size. Once it is stored, nobody
    reads the shuffle files that made it, so Spark is told to remove them with the write.
    """
    return _read_stored([_store(df, name)], df)


def _store(df: DataFrame, name: str) -> str:
    spark, path = df.sparkSession, work_path(df.sparkSession, f"llm-{name}")
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    give_back_jvm(spark)
    return path


def _read_stored(paths: list[str], like: DataFrame) -> DataFrame:
    return like.sparkSession.read.schema(like.schema).parquet(*paths)


def in_turns(turns: int, make: Callable[[int], DataFrame], name: str) -> DataFrame:
    """The rows of ``make(0)`` to ``make(turns - 1)``, stored one after the other: only one turn's shuffle files exist at a time.

    They are one table again, so that plans that read it hold one scan and not one a turn.
    """
    paths = []
    for turn in range(turns):
        part = make(turn)
        paths.append(_store(part, name))
    return _read_stored(paths, part)


def forget(table: DataFrame) -> None:
    """Delete the files of a shared table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def forget_all(*tables: DataFrame) -> None:
    """The same for tables of which no later step reads any."""
    for table in tables:
        forget(table)


def uniform(*keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys alone, so that a rerun draws the same."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11).cast("double") * F.lit(2.0 ** -53)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


@functools.lru_cache(maxsize=8)
def _shipped(application: str) -> bool:
    """Send this package to the executors' Python once per application."""
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    SparkSession.active().sparkContext.addPyFile(str(path))
    return True


#: What a Python worker keeps for later tasks of one operator: its name, and how to let go of it.
_kept: dict[str, Callable[[], None]] = {}


def keep(name: str, release: Callable[[], None]) -> None:
    """Called in a worker: ``release`` runs there before another operator's task starts."""
    _kept[name] = release


def _release_others(name: str) -> None:
    for other in [k for k in _kept if k != name]:
        _kept.pop(other)()


def give_back() -> None:
    """Return free memory to the system: a worker outlives its tasks, the driver its fits, and the allocators keep what they freed."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)


#: When the driver's JVM was last asked to give memory back, and the bytes of heap that it kept, by application.
_asked: dict[str, tuple[float, int]] = {}


def give_back_jvm(spark: SparkSession) -> None:
    """The same for the driver's JVM: what planned, compiled and ran a step is garbage after it.

    An operator runs hundreds of steps in one driver, and neither a heap that has grown nor the pools of
    its allocator (one for each few threads) shrink by themselves, so both would stay at their largest.
    The heap is collected only if it is large and has grown since the last time.
    """
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:  # Spark Connect
        return
    application = spark.sparkContext.applicationId
    last, kept = _asked.get(application, (-math.inf, 0))
    if time.monotonic() - last < GIVE_BACK_S:
        return
    runtime = jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > max(HEAP_SHARE * runtime.maxMemory(), kept):
        jvm.java.lang.System.gc()
        kept = runtime.totalMemory()
    _trim_jvm(jvm)
    _asked[application] = time.monotonic(), kept


def _trim_jvm(jvm) -> None:
    """Have the JVM's native allocator return free memory, where the JVM can (``jcmd`` has it as System.trim_native_heap)."""
    arguments = jvm.java.util.ArrayList()
    for value in (jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap", None, None):
        arguments.add(value)
    # the server's class is not open to reflection, its interface is
    invoke = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
    try:
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), arguments.toArray())
    except Py4JJavaError:  # another JVM, or another allocator
        pass


def map_in_arrow(df: DataFrame, run, schema, keeps: str = "") -> DataFrame:
    """``df.mapInArrow`` for functions of this package, which executors need not have installed.

    ``keeps``: the name under which its tasks keep things; workers outlive a stage, and what others kept goes first.
    """
    _shipped(df.sparkSession.sparkContext.applicationId)

    def alone(batches):
        _release_others(keeps)
        give_back()
        yield from run(batches)
        give_back()
    return df.mapInArrow(alone, schema)
