"""The folder all executors can see, for checkpoints and intermediate tables, and how long these live."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCOPE = "ratelab.scratch.scope"
_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    A session without that setting (a local test) gets a fresh temporary
    folder; a cluster is expected to name one on shared storage.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if folder is None and current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ratelab-")
    if current is None:
        spark.sparkContext.setCheckpointDir(folder)
    return (folder or current).rstrip("/")


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it takes it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _files(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or folder; none is fine too."""
    system, where = _files(spark, path)
    system.delete(where, True)


def scratch_root(spark: SparkSession) -> str:
    """This application's own folder in the shared one. It goes with the driver, and so do its checkpoints."""
    context = spark.sparkContext
    root = getattr(context, "_ratelab_scratch", None)
    if root is None:
        root = f"{shared_dir(spark)}/ratelab-{context.applicationId}"
        for folder in (root, context.getCheckpointDir()):
            system, where = _files(spark, folder)
            system.mkdirs(where)
            system.deleteOnExit(where)
        context._ratelab_scratch = root
    return root


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables and checkpoints made inside are removed at its end, also when it fails.

    Threads started inside with ``inheritable_thread_target`` belong to it. What
    is used after it must have been written elsewhere.
    """
    context = spark.sparkContext
    outer, name = context.getLocalProperty(_SCOPE), uuid.uuid4().hex
    _made[name] = []
    context.setLocalProperty(_SCOPE, name)
    try:
        yield
    finally:
        context.setLocalProperty(_SCOPE, outer)
        for path in _made.pop(name):
            remove(spark, path)


def _remember(spark: SparkSession, path: str) -> None:
    made = _made.get(spark.sparkContext.getLocalProperty(_SCOPE) or "")
    if made is not None:
        made.append(path)


def scratch_table_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _remember(spark, path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss. Runs a job."""
    spark = df.sparkSession
    scratch_root(spark)
    done = df.checkpoint(eager=True)
    if spark.sparkContext.getLocalProperty(_SCOPE):
        _remember(spark, done._jdf.queryExecution().logical().rdd().getCheckpointFile().get())
    return done


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to a scratch table and read back. Runs a job.

    A checkpoint keeps what the optimizer inferred about its rows. In rounds that
    make their rows from those of the round before, that grows with every round
    until planning takes minutes; a table starts anew.
    """
    path = scratch_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
