"""Tables written by ``foreachBatch``: one folder per table and micro-batch.

A replay of a batch overwrites its folders as a whole, and a batch reads
only what earlier batches wrote, so nothing of a failed attempt is ever
read.  The ``metrics`` row of a batch is written last; readers from outside
take batches that have one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.session import read_or_empty


#: Rows of a batch: read, late, distinct unseen items, accepted answers, items
#: that wait for another try; and the newest time read.
METRICS = "collected long, late long, fresh long, accepted long, waiting long, newest timestamp"


class BatchTables:
    """Tables under ``root``; ``schemas`` gives the columns of each."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str]):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = {"metrics": METRICS} | schemas

    def write(self, table: str, batch_id: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/batch_id={batch_id}")

    def _all(self, table: str) -> DataFrame:
        return read_or_empty(self.spark, f"{self.root}/{table}", f"{self.schemas[table]}, batch_id long")

    def before(self, table: str, batch_id: int) -> DataFrame:
        """What batches before ``batch_id`` wrote (a partition filter)."""
        return self._all(table).filter(F.col("batch_id") < batch_id)

    def done(self) -> int:
        """The last finished batch, -1 if there is none."""
        last = self._all("metrics").agg(F.max("batch_id")).first()[0]
        return -1 if last is None else last

    def read(self, table: str) -> DataFrame:
        """Rows of all finished batches, with ``batch_id``."""
        return self._all(table).filter(F.col("batch_id") <= self.done())

    def finish(self, batch_id: int, **counts) -> None:
        """The batch's metrics row; ends the batch."""
        fields = [f.split()[0] for f in METRICS.split(", ")]
        row = self.spark.createDataFrame([tuple(counts.get(f) for f in fields)], METRICS)
        self.write("metrics", batch_id, row.coalesce(1))
