"""Scoring with a state per key that a batch scan can hand over.

Here a key is what is dealt out and what state is read for: a micro-batch reads and writes the baselines of its own keys, whatever else the store
holds, and a job has as many tasks as its shuffle has partitions. (The sharded job of `pipeline` behaves like one consumer for all keys of a
shard, with a capacity and one time; a key alone has its own time, and the inactivity limit.) `initial` starts the keys from the states in which
`detector.baselines` has left them, bit for bit: history is scanned once, as a batch, and the stream goes on from there.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..config import DetectorConfig
from ..operators.detector import SCORES, Baseline, ScoreError
from ..sources import filelog
from ..tables import stamp_in_order, write_ranges
from .pipeline import STATE_STORE

#: Verdicts that stand as Python objects at a time.
OUT_ROWS = 10_000


def read_in_order(rows: DataFrame, path: str, order: list[str]) -> DataFrame:
    """Rows as a stream in the given order: written as files of consecutive ranges, a few of which make a micro-batch, so a task holds a bounded number of rows of a key."""
    began = time.time()
    write_ranges(rows, path, order, rows.count(), filelog.FILE_RECORDS)
    stamp_in_order(rows.sparkSession, path, began)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", filelog.TRIGGER_FILES).parquet(path)


def score_by_key(rows: DataFrame, value: str = "latency_us", keys: tuple[str, ...] = ("service_name", "route"), clock: str = "clock", tie: tuple[str, ...] = (), config: DetectorConfig = DetectorConfig(), ttl: int | None = None, initial: DataFrame | None = None) -> DataFrame:
    """All columns of a stream's rows, their verdict (null where there is none) and error.

    A micro-batch's rows of a key are taken in order of clock and tie. A row whose time is before the key's latest scored one, or whose value can't be
    scored, has an error and changes nothing. Gaps of at least ttl (in the clock's unit) start a key afresh. initial: keys, mean, variance, count, last.
    """
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor

    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(SCORES), T.StructField("error", T.StringType())])
    verdicts = [f.name for f in T.StructType.fromDDL(SCORES)]

    class Scorer(StatefulProcessor):
        def init(self, handle) -> None:
            self.held = handle.getValueState("baseline", "mean double, variance double, count long, last long")

        def handleInitialState(self, key, initialState, timerValues) -> None:
            for mean, variance, count, last in initialState[["mean", "variance", "count", "last"]].itertuples(index=False, name=None):
                self.held.update((float(mean), float(variance), int(count), int(last)))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            frame = pd.concat(list(rows), ignore_index=True).sort_values([clock, *tie], kind="stable")
            mean, variance, count, last = self.held.get() if self.held.exists() else (0.0, 0.0, 0, None)
            state = Baseline(mean, variance, count)
            for a in range(0, len(frame), OUT_ROWS):
                part, out = frame.iloc[a : a + OUT_ROWS], []
                for x, now in zip(part[value].tolist(), part[clock].tolist(), strict=True):
                    try:
                        if last is not None and now < last:
                            raise ScoreError("observation time must not move backwards")
                        fresh = Baseline() if last is not None and ttl is not None and now - last >= ttl else state
                        m, s, score, odd, n, warmed = fresh.step(float("nan") if x is None else float(x), config)
                        state, last = fresh, now
                        out.append((m or 0.0, s or 0.0, score, odd, n, warmed, None))
                    except ScoreError as e:
                        out.append((None, None, None, None, None, None, str(e)))
                if last is not None:
                    self.held.update((state.mean, state.variance, state.count, last))
                scored = pd.DataFrame(out, columns=[*verdicts, "error"], dtype=object)
                yield pd.concat([part[names].reset_index(drop=True), scored], axis=1)

        def close(self) -> None:
            gc.collect()  # a worker lives on through later micro-batches

    start = None if initial is None else initial.select(*keys, "mean", "variance", "count", "last").groupBy(*keys)
    return rows.groupBy(*keys).transformWithStateInPandas(Scorer(), schema, "append", "none", initialState=start)


def run_to_end(scored: DataFrame, path: str, checkpoint: str) -> None:
    """Appends what there is to a table of files, and ends."""
    scored.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
