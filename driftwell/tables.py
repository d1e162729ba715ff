"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import math
import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir. Where that is unset a session in one process (tests) uses its warehouse; a cluster, a local one too, must set it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(root or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write df and read it back: cuts lineage, so that a lost executor costs a retry of this step at most."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_ranges(df: DataFrame, path: str, order: list[str], rows: int, file_rows: int, drop: list[str] = []) -> None:
    """Write df (of so many rows) as files that hold consecutive ranges of the order, at most file_rows rows each, in the order of their names."""
    write_in_order(in_ranges(df, order, rows, file_rows), path, order, file_rows, drop)


def in_ranges(df: DataFrame, order: list[str], rows: int, file_rows: int) -> DataFrame:
    """df (of so many rows) with partitions that are consecutive ranges of the order."""
    return df.repartitionByRange(max(1, math.ceil(rows / (0.8 * file_rows))), *order)  # ranges are sampled: most of them fit one file


def write_in_order(df: DataFrame, path: str, order: list[str], file_rows: int, drop: list[str] = []) -> None:
    """Write df, whose partitions are ranges of the order already, as files of at most file_rows rows each."""
    df.sortWithinPartitions(*order).drop(*drop).write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)


def stamp_in_order(spark: SparkSession, path: str, began: float) -> None:
    """Give a written table's files ascending modification times in the order of its tasks, all between `began` (seconds) and now: Spark's file stream takes files by these."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(m, s.getPath()) for s in fs.listStatus(folder) if (m := re.match(r"part-(\d+)-.+-c(\d+)\.", s.getPath().getName()))]
    files = [p for _, p in sorted(found, key=lambda f: (int(f[0][1]), int(f[0][2])))]
    time.sleep(max(0.0, began + (len(files) + 1) / 1000 - time.time()))
    first = int(time.time() * 1000) - len(files) + 1
    for i, p in enumerate(files):
        fs.setTimes(p, first + i, -1)
    if any(fs.getFileStatus(p).getModificationTime() != first + i for i, p in enumerate(files)):
        raise OSError(f"the file system of {path} keeps no modification times, so a stream can't read its files in order")
