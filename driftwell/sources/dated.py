"""A table in date partitions with the number of rows of each key and date, for latest-first access.

The latest k rows of a key lie in its newest dates that together hold k rows. The counts tell which those are without reading a row, so
only these partitions are listed and read, and of them only the rows of keys that need them: a dashboard's "latest per route" doesn't scan the past.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


class DatedTable:
    """rows: <path>/rows/_date=.../; counts: <path>/counts (keys, _date, n). Written once by `write`, extended by `append`."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def append(self, rows: DataFrame, date: str) -> None:
        """date: an expression for a row's date. Rows of a date stand by key in their files. Counts follow the rows: if only the rows were
        written, `recount` mends it."""
        dated = rows.withColumn("_date", F.expr(date).cast("date"))
        dated.repartition("_date", *self.keys).sortWithinPartitions("_date", *self.keys).write.mode("append").partitionBy("_date").parquet(f"{self.path}/rows")
        dated.groupBy(*self.keys, "_date").agg(F.count("*").alias("n")).write.mode("append").parquet(f"{self.path}/counts")

    def recount(self) -> None:
        """The counts anew from the rows' keys."""
        counts = self.rows().groupBy(*self.keys, "_date").agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{self.path}/counts-new")
        self.spark.read.parquet(f"{self.path}/counts-new").write.mode("overwrite").parquet(f"{self.path}/counts")

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")

    def needed(self, k: int) -> DataFrame:
        """keys, _date: where the latest k rows of each key are; a date in which a key's k-th row is reached is the key's last one."""
        counts = self.spark.read.parquet(f"{self.path}/counts").groupBy(*self.keys, "_date").agg(F.sum("n").alias("n"))
        newer = F.sum("n").over(W.partitionBy(*self.keys).orderBy(F.desc("_date")).rowsBetween(W.unboundedPreceding, -1))  # a row a date
        return counts.withColumn("_newer", F.coalesce(newer, F.lit(0))).where(F.col("_newer") < k).select(*self.keys, "_date")

    def latest(self, k: int, order: list) -> DataFrame:
        """The first k rows of each key by order (which must put later dates first), with rank."""
        needed = self.needed(k)
        dates = [r["_date"] for r in needed.select("_date").distinct().collect()]  # a row a date
        folders = [f"{self.path}/rows/_date={'__HIVE_DEFAULT_PARTITION__' if d is None else d}" for d in dates]
        rows = self.spark.read.option("basePath", f"{self.path}/rows").parquet(*folders) if folders else self.rows().limit(0)
        renamed = needed.select(*(F.col(x).alias(f"_n{i}") for i, x in enumerate([*self.keys, "_date"])))
        rows = rows.withColumn("_date", F.col("_date").cast("date"))
        same = [F.col(x).eqNullSafe(F.col(f"_n{i}")) for i, x in enumerate([*self.keys, "_date"])]
        w = W.partitionBy(*self.keys).orderBy(*order)
        return rows.join(renamed, same, "left_semi").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("_date")
