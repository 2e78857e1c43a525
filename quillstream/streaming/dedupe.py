"""Exact deduplication over the whole life of a stream.

The keys live in Spark's state store (RocksDB, so on disk and in the
checkpoint, not in executor heaps), one value per key with a time to live.
A watermark-only operator forgets a key as soon as the watermark passes it;
here a key stays known until ``keep`` has gone by since it was last seen,
across micro-batches and restarts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """Key state with a time to live needs the RocksDB provider."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class FirstOfKey(StatefulProcessor):
    """Returns the first row of a key that has no state, and marks the key."""

    def __init__(self, order: list[str], columns: list[str], keep_ms: int | None):
        self.order, self.columns, self.keep_ms = order, columns, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "known boolean", ttlDurationMs=self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        known, first = self.known.exists(), None
        for batch in rows:  # a hot key's rows pass in batches; one row is held
            if not known:
                best = batch.sort_values(self.order).head(1)
                first = best if first is None else pd.concat([first, best]).sort_values(self.order).head(1)
        self.known.update((True,))  # seen again: the time to live starts anew
        if first is not None:
            yield first[self.columns]

    def close(self) -> None:
        pass


def first_per_key_stream(stream: DataFrame, key: str, order: list[str], keep: str | None = None) -> DataFrame:
    """The first row (in ``order``) of every key of ``stream``, once in the
    stream's life; later rows of a key, however many micro-batches later,
    give nothing.  ``keep`` (such as "90 days") forgets keys that were not
    seen for that long, by processing time; without it they are kept.

    Copies within a micro-batch are reduced by the state operator's own
    shuffle on the key; rows of a key that differ beyond ``order`` are told
    apart by nothing, so ``order`` should end in a unique column."""
    use_state_store(stream.sparkSession)
    keep_ms = None
    if keep is not None:
        seconds = stream.sparkSession.sql(f"SELECT CAST(INTERVAL {keep} AS INTERVAL SECOND) AS s").select(F.col("s").cast("long")).first()[0]
        keep_ms = int(seconds) * 1000
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=FirstOfKey(order, stream.columns, keep_ms),
        outputStructType=stream.schema,
        outputMode="append",
        timeMode="processingTime",
    )
