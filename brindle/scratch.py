"""Shared scratch storage, used to run an expensive stage once and cut its lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Set to true where spark.checkpoint.dir is a mount that all machines share, such as NFS.
SHARED_MOUNT = "spark.brindle.checkpointDirIsSharedMount"

_runs: list[str] = []
_proven: set[tuple[str, str]] = set()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    On a cluster a missing setting is an error. A folder in the local file system may be another one on each
    machine, so there it is tried out once whether the driver and the executors see each other's files, and
    an error if they do not. For a local master without the setting a
    temporary folder is set up and deleted when Python ends.
    """
    context = spark.sparkContext
    local = context.master.startswith("local")
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="brindle-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
        root = context.getCheckpointDir()
    if not local and spark.conf.get(SHARED_MOUNT, "false") != "true" and _scheme(spark, root) == "file" and not _is_shared(spark, root):
        raise RuntimeError(f"spark.checkpoint.dir names a local folder, {root}, that executors were not seen to share; if it is a shared mount, set {SHARED_MOUNT}=true")
    return root.rstrip("/")


def _is_shared(spark: SparkSession, root: str) -> bool:
    """Whether executors and the driver see in ``root`` what the others write, tried out once for each application.

    Every task slot writes a file, the driver commits the files, and tasks read them again. Without an executor besides the driver nothing is shown.
    """
    context = spark.sparkContext
    if (context.applicationId, root) in _proven:
        return True
    slots = max(context.defaultParallelism, 2)
    folder = f"{root.rstrip('/')}/brindle/probe-{uuid.uuid4().hex}"
    path, files = _hadoop_path(spark, folder)
    try:
        context.parallelize(range(slots), slots).saveAsTextFile(folder)
        seen = sorted(int(line) for line in context.textFile(folder, slots).collect())
    except Py4JJavaError:  # a task or the driver misses a file or folder that another one made
        return False
    finally:
        files.delete(path, True)
    executors = context._jsc.sc().getExecutorMemoryStatus().size() - 1
    if seen != list(range(slots)) or executors < 1:
        return False
    _proven.add((context.applicationId, root))
    return True


def _hadoop_path(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _scheme(spark: SparkSession, path: str) -> str:
    return _hadoop_path(spark, path)[1].getUri().getScheme()


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Everything put in scratch storage inside the block is deleted at its end.

    Frames that operators returned may still read it, so write or collect them before.
    """
    folder = f"{shared_root(spark)}/brindle/run-{uuid.uuid4().hex}"
    _runs.append(folder)
    try:
        yield
    finally:
        _runs.remove(folder)
        path, files = _hadoop_path(spark, folder)
        files.delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared root that nothing has been written to yet."""
    folder = _runs[-1] if _runs else f"{shared_root(spark)}/brindle"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared root once and return a reader over the files.

    Later jobs restart from the files after an executor loss, and the real
    file size feeds the planner's choice between broadcast and shuffle joins.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
