"""Folders shared by driver and executors, tables that cut lineage, and row numbers that no single task gives."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, one of our own.

    Without the setting a local session uses the temporary folder and a cluster the warehouse,
    which its executors share.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return os.path.join(tempfile.gettempdir(), "checkpoints")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def _filesystem(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _filesystem(spark, path)
    return files.exists(target)


def drop_path(spark: SparkSession, path: str) -> None:
    files, target = _filesystem(spark, path)
    files.delete(target, True)


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/sparkloom/{tag}-{uuid.uuid4().hex}"
    files, target = _filesystem(spark, path)
    files.deleteOnExit(target)
    return path


def written(df: DataFrame, tag: str = "step", path: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and safe when executors are lost."""
    spark = df.sparkSession
    path = path or scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_prefix(columns: list[str]) -> str:
    """A prefix that no column begins with, whatever its case."""
    prefix = "__sl_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix = "_" + prefix
    return prefix


def numbered(rows: DataFrame, *order: Column | str, name: str = "place") -> DataFrame:
    """``rows`` with ``name``, from 0 in this order: rows are dealt by ranges of it and counted by range, so no task holds all."""
    at, part = f"__{name}_at", f"__{name}_part"
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    dealt = written(dealt.withColumns({part: F.shiftright(at, 33).cast("int"), at: F.col(at).bitwiseAND(F.lit((1 << 33) - 1))}), "numbered")
    before, start = [], 0
    for r in dealt.groupBy(part).count().orderBy(part).collect():  # at most one row per partition
        before += [0] * (r[0] - len(before)) + [start]
        start += r[1]
    starts = F.array(*map(F.lit, before or [0]))
    return dealt.withColumn(name, (F.element_at(starts, F.col(part) + 1) + F.col(at)).cast("long")).drop(part, at)
