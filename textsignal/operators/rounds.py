"""Frames that one round of an iteration, or one step of a query, hands to the next."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Spark's setting by which the files of a query's shuffles go when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share, which `spark.checkpoint.dir` names; a session on one
    machine may do without the setting."""
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getConf().get(SETTING, None)
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError(f"set {SETTING} to a folder that all machines share")
    if context.applicationId not in _own:
        _own[context.applicationId] = tempfile.mkdtemp(prefix="rounds-")
    return _own[context.applicationId]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that begin in here delete their shuffle files as they end, not when the driver happens
    to collect its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """The same rows, computed once and written as Parquet, so that plans don't grow from round to
    round and lost executors cost no more than one step. What was shuffled for them is deleted."""
    spark = df.sparkSession
    path = path or new_path(spark)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses; `drop_written` will delete what is there."""
    path = f"{shared_folder(spark)}/round-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes what `written` has put at a path of `new_path`, which nothing will read again."""
    _delete(spark, path)
    _written[spark.sparkContext.applicationId].remove(path)


def drop_written(spark: SparkSession) -> int:
    """Deletes what this session has written here; frames that read it can't be used afterwards."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)
