"""Tables written once in the folder that all machines of the cluster share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_written: dict[str, list[str]] = {}
_own: dict[str, str] = {}

#: Parquet for rows of megabytes: the writer looks at its memory after each row, not after a hundred, and
#: a row group, which readers take into memory at once, has few rows.
WIDE_ROWS = {"parquet.block.size": str(4 << 20), "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1"}
#: Rows that Spark hands to Python at once.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a session on one machine may do without the setting."""
    named = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"set {SETTING} to a folder that all machines share")
    application = spark.sparkContext.applicationId
    if application not in _own:
        _own[application] = tempfile.mkdtemp(prefix="llm-")
    return _own[application]


@contextmanager
def rows_a_batch(spark: SparkSession, most: int) -> Iterator[None]:
    """Queries that begin in here hand Python at most so many rows at once."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def stored(df: DataFrame, wide: bool = False) -> DataFrame:
    """The same rows, written as Parquet now, so that lost executors cost no more than one step.

    Names of columns must differ. `wide` rows have megabytes each: a task then holds few of them. `drop_stored`
    removes what this session has written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.options(**(WIDE_ROWS if wide else {})).parquet(path)
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> int:
    """Deletes the tables this session has stored; frames that read them can't be used afterwards."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)
