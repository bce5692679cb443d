"""Tables to files, always in one distributed write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Writes a Parquet table, replacing an older one."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str, gap: str = " ") -> None:
    """Writes CSV files with a header; arrays become their elements with `gap` between."""
    flat = [
        F.array_join(field.name, gap).alias(field.name)
        if isinstance(field.dataType, ArrayType)
        else F.col(field.name)
        for field in df.schema.fields
    ]
    df.select(*flat).write.mode("overwrite").csv(path, header=True, escape='"')
