"""Periodic ingest as Structured Streaming.

The source system's ticker ("every N hours, look back N hours") becomes a
file stream over a landing directory with ``trigger(processingTime='N
hours')`` in production and ``availableNow`` in tests.  Each micro-batch
runs the same tick plan as the batch job inside ``foreachBatch`` over plain
tables (``streaming.tables``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.operators import ids as I
from quillstream.plans.ingest import run_tick, written
from quillstream.session import read_or_empty
from quillstream.sources import feed as FD
from quillstream.streaming.tables import BatchTables


def tick_counts(df: DataFrame, time_col: str, hours: int, by: str) -> DataFrame:
    """Tumbling windows of ``hours`` (interval = look-back), counted
    per ``by``; windows are aligned to the epoch."""
    w = F.window(F.col(time_col), f"{hours} hours")
    return df.groupBy(w.alias("w"), F.col(by)).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("tick"), F.col(by), "n"
    )


def run_available(
    spark: SparkSession,
    stream: DataFrame,
    checkpoint: str,
    sink: Callable | None = None,
    path: str | None = None,
    query_name: str | None = None,
):
    """Process everything available now and stop (test/backfill trigger).

    Batches without data are off for the run: an operator with processing-time
    state asks for another batch at any time, and would never let it end."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if query_name:
        w = w.queryName(query_name)
    setting = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")  # the query takes the session's settings as it starts
    try:
        if sink is not None:
            q = w.foreachBatch(sink).start()
        else:
            q = w.format("parquet").option("path", path).outputMode("append").start()
    finally:
        spark.conf.set(setting, before)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def newest_before(tables: BatchTables, batch_id: int) -> dt.datetime | None:
    """The newest time that batches before ``batch_id`` read."""
    return tables.before("metrics", batch_id).agg(F.max("newest")).first()[0]


def log_batch(batch: DataFrame, time_col: str, late_hours: float | None, newest: dt.datetime | None):
    """A3 / T4: the micro-batch, written once and observed while it is:
    (rows in time, late rows, figures).  Late rows are those at or before the
    watermark, the ``newest`` time of all earlier batches less
    ``late_hours``; without it none are late."""
    time = F.col(time_col).cast("timestamp")
    late = F.lit(False)
    if newest is not None and late_hours is not None:
        late = F.coalesce(time <= F.lit(newest - dt.timedelta(hours=late_hours)), F.lit(False))
    seen = Observation()
    marked = batch.withColumn("_late", late).observe(
        seen, F.count(F.lit(1)).alias("collected"), F.count(F.when(F.col("_late"), 1)).alias("late"), F.max(time).alias("newest")
    )
    rows = written(marked, "batch")
    figures = seen.get
    return rows.filter(~F.col("_late")).drop("_late"), rows.filter("_late").drop("_late"), figures


def batch_log(spark: SparkSession, root: str, schema: str, time_col: str, late_hours: float | None = None):
    """(tables, ``foreachBatch`` function) that only keep the figures of
    every micro-batch (``metrics``) and the late rows themselves (``late``):
    no limit on their number, unlike a query's recent progress."""
    tables = BatchTables(spark, root, {"late": schema})
    known: dict = {}  # what this run has written itself is not read again

    def process(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.update(done=tables.done(), newest=newest_before(tables, 1 << 62))
        if batch_id <= known["done"]:
            return
        _, late, figures = log_batch(batch, time_col, late_hours, known["newest"])
        if figures["late"]:
            tables.write("late", batch_id, late)
        tables.finish(batch_id, **figures)
        times = [t for t in (known["newest"], figures["newest"]) if t is not None]
        known.update(done=batch_id, newest=max(times, default=None))

    return tables, process


def _now(source: DataFrame | Callable[[], DataFrame] | None) -> DataFrame | None:
    """A side table of this micro-batch: a reader is called anew, so it lists
    files that landed since the stream started."""
    return source() if callable(source) and not isinstance(source, DataFrame) else source


ITEMS = "topic string, id long, guid string, title string, date timestamp, link string, source string, score string, analyse string"


class TickState(BatchTables):
    """Cross-tick tables under ``root``, one folder per micro-batch each:
    ``items``, ``seen``, ``quarantine``, ``counters``, ``waiting`` (items
    that wait for their link or for an accepted answer, with their tries),
    ``given_up`` (items that waited ``retry_ticks``; a table of the feed's
    columns, so it can be landed again), ``resolver_requests`` (for the
    fetcher), ``late`` and ``metrics``; and ``answers``, the model's landed
    responses, and ``counter_names``, over all batches.

    ``keep_seen`` (ticks) bounds the seen keys that a tick reads: a guid
    that the feed repeats after more ticks is a new item then.  Without it
    all keys count, and a tick reads one narrow column of all history."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        retry_ticks: int = 8,
        hold_ticks: int = 4,
        late_hours: float | None = None,
        keep_seen: int | None = None,
        feed_schema: T.StructType | str = FD.FEED_SCHEMA,
    ):
        feed = feed_schema if isinstance(feed_schema, str) else ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in feed_schema)
        times = dict(x.split() for x in feed.split(", "))["published"]
        super().__init__(
            spark,
            root,
            {
                "items": ITEMS.replace("date timestamp", f"date {times}"),
                "seen": "guid string",
                "quarantine": "guid string, reason string, answer string",
                "counters": "name string, seq long",
                "waiting": f"{feed}, tries int",
                "given_up": feed,
                "resolver_requests": "key string, payload string",
                "late": feed,
            },
        )
        self.retry_ticks, self.hold_ticks, self.late_hours, self.keep_seen = retry_ticks, hold_ticks, late_hours, keep_seen
        self.answers, self.counter_names = f"{self.root}/answers", f"{self.root}/counter_names"

    def init_counters(self, names: DataFrame) -> None:
        """K7: counters at seq 0 for the given names; names that are known
        keep their seq.  May be called at any time, also between ticks."""
        names.select("name").distinct().write.mode("append").parquet(self.counter_names)

    def _latest(self, table: str, batch_id: int, last: int | None = None) -> DataFrame:
        """The table as the last finished batch before ``batch_id`` left it."""
        last = min(self.done() if last is None else last, batch_id - 1)
        return self.before(table, last + 1).filter(F.col("batch_id") == last).drop("batch_id")

    def counters_before(self, batch_id: int, last: int | None = None) -> DataFrame:
        names = read_or_empty(self.spark, self.counter_names, "name string")
        return I.init_counters(self._latest("counters", batch_id, last), names)

    def seen_before(self, batch_id: int) -> DataFrame:
        keys = self.before("seen", batch_id)
        if self.keep_seen is not None:
            keys = keys.filter(F.col("batch_id") >= batch_id - self.keep_seen)
        return keys.select("guid")

    def waiting_before(self, batch_id: int, last: int | None = None) -> DataFrame:
        return self._latest("waiting", batch_id, last)

    def ingest(
        self,
        responses: DataFrame | Callable[[], DataFrame] | None = None,
        page_content: DataFrame | Callable[[], DataFrame] | None = None,
        make_scorer: Callable | None = None,
        make_client: Callable | None = None,
        resolver_responses: DataFrame | Callable[[], DataFrame] | None = None,
        concurrency: int | None = None,
    ) -> Callable[[DataFrame, int], None]:
        """``foreachBatch`` function running one tick per micro-batch.  Side
        tables that grow while the stream runs are given as readers
        (functions without arguments).  Every table of a batch is overwritten
        when the batch is replayed; a model answer that landed is kept."""

        def process(batch: DataFrame, batch_id: int) -> None:
            last = self.done()
            if batch_id <= last:  # replay of a finished batch
                return
            newest = None if self.late_hours is None else newest_before(self, batch_id)
            rows, late, figures = log_batch(batch, "published", self.late_hours, newest)
            waiting = self.waiting_before(batch_id, last)
            if not figures["collected"] and waiting.isEmpty():
                return  # K9: nothing collected, nothing changes
            work = rows.withColumn("tries", F.lit(0)).unionByName(waiting)
            before = written(self.counters_before(batch_id, last), "counters")
            landed = responses is None and (make_client or make_scorer)
            res = run_tick(
                work, self.seen_before(batch_id), before, page_content=_now(page_content), responses=_now(responses),
                make_scorer=make_scorer, make_client=make_client, concurrency=concurrency,
                resolver_responses=_now(resolver_responses), hold_ticks=self.hold_ticks,
                answers_path=self.answers if landed else None,
            )
            again = written(res.unresolved.unionByName(res.rejected).withColumn("tries", F.col("tries") + 1), "again")
            stays = F.col("tries") < self.retry_ticks
            outputs = {
                "items": res.items,
                "seen": res.seen,
                "quarantine": res.quarantine,
                "waiting": again.filter(stays),
                "given_up": again.filter(~stays).drop("tries"),
                "resolver_requests": res.resolver_requests,
                "late": late,
                "counters": I.apply_advance(before, res.counters),
            }
            counts = {"fresh": res.linked, "accepted": res.first, "waiting": again}
            # the tables do not depend on one another: their jobs run side by side
            with ThreadPoolExecutor(len(outputs)) as pool:
                done = [pool.submit(self.write, table, batch_id, found) for table, found in outputs.items()]
                figures |= {name: n.result() for name, n in {k: pool.submit(t.count) for k, t in counts.items()}.items()}
                for table in done:
                    table.result()
            self.finish(batch_id, **figures)

        return process

    def window_tick(self, landing: str, hi: dt.datetime, hours: int, batch_id: int, topics: list[str] | None = None, **sources) -> None:
        """One tick over the look-back window ``[hi - hours, hi]`` of a
        landing table laid out by topic and hour (``feed.land_feed``).  The
        window is a partition filter; windows may overlap, since items of
        earlier ticks are seen."""
        rows = FD.window_scan(self.spark, landing, hi, hours, topics)
        self.ingest(**sources)(rows, batch_id)


def clock(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A stream without rows that moves on with time: united with a file
    stream it makes the trigger fire its batch although no file landed, so
    waiting items are tried again in a quiet feed."""
    beats = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return beats.filter("value < 0").select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def ingest_stream(
    spark: SparkSession,
    landing: str,
    feed_schema,
    state_root: str,
    hours: int | None = None,
    checkpoint: str | None = None,
    every: str | None = None,
    state: TickState | None = None,
    **sources,
):
    """The periodic ingest.  ``hours`` set: a processing-time trigger
    every ``hours`` hours (the source system's interval, which is also its
    look-back), or ``every`` some other interval; neither: process what is
    available and stop.  ``sources`` are those of ``TickState.ingest``.
    Returns the started query (already finished for availableNow)."""
    state = state or TickState(spark, state_root, feed_schema=feed_schema)
    ckpt = checkpoint or f"{state_root.rstrip('/')}/_checkpoint"
    stream = spark.readStream.schema(feed_schema).parquet(landing)
    sink = state.ingest(**sources)
    every = every or (None if hours is None else f"{hours} hours")
    if every is None:
        return run_available(spark, stream, ckpt, sink=sink)
    timed = stream.unionByName(clock(spark, stream.schema))
    return timed.writeStream.option("checkpointLocation", ckpt).trigger(processingTime=every).foreachBatch(sink).start()
