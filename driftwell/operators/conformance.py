"""Tables against their contracts: columns, types, required values, keys and partitioning, found by relational division over a catalogue.

The catalogue is read off the tables themselves: names and types from their files' footers, partition columns from their files' paths. What a file's
schema can't promise is counted: nulls in required columns (one aggregation a table, over those columns only) and values of a key that
repeat (an aggregation with a combine in the tasks).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    """columns: name to (type as Spark writes it, whether it is required); key: columns whose values don't repeat; partitioned_by: folders' columns."""

    table: str
    columns: dict[str, tuple[str, bool]]
    key: tuple[str, ...] = ()
    partitioned_by: tuple[str, ...] = field(default=())


def _opened(contracts: list[Contract], read: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    found = {}
    for c in contracts:
        try:
            found[c.table] = read(c.table)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return found


def catalogue(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, column_name, data_type of the tables' files."""
    rows = [(t, name, kind) for t, df in tables.items() for name, kind in df.dtypes]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def _folders(df: DataFrame) -> DataFrame:
    """found: the names of partition folders in a file's path, comma-joined; a row for each way in which the table's files stand."""
    return df.select(F.array_join(F.regexp_extract_all("_metadata.file_path", F.lit("/([^/=]+)=[^/]*(?=/)"), F.lit(1)), ",").alias("found")).distinct()


def problems(spark: SparkSession, contracts: list[Contract], read: Callable[[str], DataFrame]) -> DataFrame:
    """table_name, subject (a column, the key's columns, or the table), problem, n (rows or values concerned, null for what concerns the schema)."""
    tables = _opened(contracts, read)
    wanted = spark.createDataFrame([(c.table, name, kind) for c in contracts for name, (kind, _) in c.columns.items()], "table_name string, column_name string, wanted string")
    have = catalogue(spark, tables)
    nothing = F.lit(None).cast("long").alias("n")
    gone = spark.createDataFrame([(c.table,) for c in contracts], "table_name string").join(have, "table_name", "left_anti").select("table_name", F.col("table_name").alias("subject"), F.lit("the table is missing").alias("problem"), nothing)
    there = wanted.join(have, "table_name", "left_semi")
    lost = there.join(have, ["table_name", "column_name"], "left_anti").select("table_name", F.col("column_name").alias("subject"), F.lit("the column is missing").alias("problem"), nothing)
    other = wanted.join(have, ["table_name", "column_name"]).where("wanted <> data_type").select("table_name", F.col("column_name").alias("subject"), F.concat(F.lit("the type is "), "data_type", F.lit(" instead of "), "wanted").alias("problem"), nothing)
    out = gone.unionByName(lost).unionByName(other)
    for c in contracts:
        df = tables.get(c.table)
        if df is None:
            continue
        names = set(df.columns)
        required = [x for x, (_, must) in c.columns.items() if must and x in names]
        row = lambda subject, problem, n: F.struct(F.lit(c.table).alias("table_name"), F.lit(subject).alias("subject"), problem.alias("problem"), n.alias("n"))  # noqa: E731, B023
        if required:
            counts = df.agg(*(F.count_if(F.col(f"`{x}`").isNull()).alias(f"_{i}") for i, x in enumerate(required)))
            found = counts.select(F.explode(F.array(*(row(x, F.lit("required values are null"), F.col(f"_{i}")) for i, x in enumerate(required)))).alias("p")).select("p.*")
            out = out.unionByName(found.where("n > 0"))
        if c.key and set(c.key) <= names:
            repeated = df.groupBy(*(f"`{x}`" for x in c.key)).count().where("count > 1").agg(F.count("*").alias("_n"))
            out = out.unionByName(repeated.select(row(",".join(c.key), F.lit("values of the key repeat"), F.col("_n")).alias("p")).select("p.*").where("n > 0"))
        stands = _folders(df).where(F.col("found") != ",".join(c.partitioned_by))
        out = out.unionByName(stands.select(row(c.table, F.concat(F.lit("partitioned by ("), "found", F.lit(f") instead of ({','.join(c.partitioned_by)})")), F.lit(None).cast("long")).alias("p")).select("p.*"))
    return out


def ready(spark: SparkSession, contracts: list[Contract], read: Callable[[str], DataFrame]) -> DataFrame:
    """table_name, ready: tables without any problem."""
    found = problems(spark, contracts, read).groupBy("table_name").count()
    every = spark.createDataFrame([(c.table,) for c in contracts], "table_name string")
    return every.join(found, "table_name", "left").select("table_name", F.col("count").isNull().alias("ready"))
