"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Broadcast joins take a side of at most this many narrow rows; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Rows and bytes that a step takes at a time; a longer row is a slice of its own. Spark's own batches may hold 10 000 texts.
SLICE_ROWS, SLICE_BYTES = 1024, 4_000_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where that is unset a session in one process (tests) uses its warehouse; a cluster, a local one too, must set it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return (folder or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tables").rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives executor loss."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables that nothing reads any more."""
    for t in tables:
        spark, path = t.sparkSession, spark_path(t)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spark_path(t: DataFrame):
    return t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._table_path)


def release() -> None:
    """Give memory that a task has freed back to the system: a Python worker idles beside the next stage's JVM work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, where it has one
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in order, in pieces of at most SLICE_ROWS rows and SLICE_BYTES bytes (or one row)."""
    for batch in batches:
        left = [batch]
        while left:
            now = left.pop()
            if now.num_rows > 1 and (now.num_rows > SLICE_ROWS or now.nbytes > SLICE_BYTES):
                half = now.num_rows // 2
                left += [now.slice(half), now.slice(0, half)]
            else:
                yield now


def map_batches(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict]]) -> DataFrame:
    """mapInArrow with one step function per task; a step turns a dict of lists into a dict of lists or arrays."""

    typed = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, batch, out = make(), None, None
        for batch in slices(batches):
            out = step({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)})
            yield pa.RecordBatch.from_pydict(out, typed)
        step = batch = out = None
        release()

    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """mapInArrow over all columns, whatever their names (Spark's own takes dots and backticks in names for syntax): run must go by positions."""
    plain = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return plain.mapInArrow(run, plain.schema).toDF(*df.columns)


def filter_batches(df: DataFrame, columns: list[str], make: Callable[[], Callable[..., list]]) -> DataFrame:
    """Keep the rows for which a step over the named columns' values says so; all columns pass through."""
    at = [df.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, batch = make(), None
        for batch in slices(batches):
            keep = step(*(batch.column(i).to_pylist() for i in at))
            yield batch.filter(pa.array(keep, pa.bool_()))
        step = batch = None
        release()

    return map_rows(df, run)


def small_enough(ids: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    return ids.limit(limit + 1).count() <= limit


def checked_broadcast(ids: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The side with a broadcast hint if it has at most `limit` rows, else as it is (a shuffle join)."""
    return F.broadcast(ids) if small_enough(ids, limit) else ids


def span_digest(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)
