"""Contiguous id allocation and named counters.

Ids ``prev_seq + 1 ... prev_seq + n`` in arrival order, per counter, without
a global single-partition window:

1. range-partition the batch on ``(counter, arrival...)`` and sort within
   partitions (one sampled range shuffle; a hot counter spans many
   partitions because the arrival columns split its range);
2. checkpoint, so partition ids and row order are fixed even if an
   executor is lost and tasks are re-run;
3. count rows per ``(partition, counter)`` -- at most
   ``partitions + counters`` rows -- and turn the counts into offsets with
   a window over that tiny table;
4. join the offsets back (broadcast by AQE at runtime: the table's size is
   bounded by partitions + counters, not by the data).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillstream.session import ensure_checkpoint_dir

COUNTER_SUFFIX = "-counter"  # fixed value: counter name = topic + "-counter"
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
MAX_RANGE_PARTITIONS = 100_000


def partitions_for(df: DataFrame) -> int:
    """Range-partition count for ``df``: the bytes of the files it scans
    over ~128 MiB, at least ``spark.sql.shuffle.partitions``.  A fixed
    count would give 100 TB inputs partitions of hundreds of GB.  Only
    file-scan leaves are counted: optimizer estimates above a join are
    products of the inputs, and checkpointed leaves carry such estimates
    too, so they are ignored (the floor applies)."""
    spark = df.sparkSession
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        size = 0
        for i in range(leaves.size()):
            leaf = leaves.apply(i)
            if leaf.nodeName() == "LogicalRelation":
                size += int(str(leaf.stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no plan statistics: keep the floor
        return floor
    return int(min(MAX_RANGE_PARTITIONS, max(floor, -(-size // TARGET_PARTITION_BYTES))))


def counter_name(topic):
    return F.concat(topic, F.lit(COUNTER_SUFFIX))


def rank_within(
    df: DataFrame,
    order: Sequence[str],
    group_col: str | None = None,
    rank_col: str = "_rank",
    num_partitions: int | None = None,
) -> DataFrame:
    """1-based rank of every row within ``group_col`` (or globally) in
    ``order`` -- the distributed equivalent of ``row_number()`` without a
    single-partition window (steps 1-4 in the module docstring)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    src = df if group_col else df.withColumn("_g", F.lit(0))
    g = group_col or "_g"
    keys = [g, *order]
    n = num_partitions or partitions_for(src)
    ranged = src.repartitionByRange(n, *keys).sortWithinPartitions(*keys).checkpoint(eager=True)
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    stats = tagged.groupBy("_pid", g).agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    w = Window.partitionBy(g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = tagged.join(stats.select("_pid", g, "_before", "_m0"), ["_pid", g])
    rank = (F.col("_before") + (F.col("_mid") - F.col("_m0")) + F.lit(1)).cast("long")
    out = out.withColumn(rank_col, rank).drop("_pid", "_mid", "_before", "_m0")
    return out if group_col else out.drop("_g")


def allocate_ids(
    df: DataFrame,
    order: Sequence[str],
    counter_col: str,
    counters: DataFrame,
    id_col: str = "id",
    num_partitions: int | None = None,
) -> DataFrame:
    """W1 + K6: add ``id_col`` = counter's previous seq + rank of the row
    within its counter in ``order``.  ``counters`` is ``(name, seq)`` and
    ``df[counter_col]`` holds the counter name.  A missing counter fails
    the job (the source system errors instead of upserting)."""
    ranked = rank_within(df, order, counter_col, num_partitions=num_partitions)
    c = counters.select(F.col("name").alias(counter_col), F.col("seq").alias("_prev"))
    out = ranked.join(c, counter_col, "left")
    prev = F.when(F.col("_prev").isNull(), F.raise_error(F.concat(F.lit("missing counter: "), F.col(counter_col)))).otherwise(
        F.col("_prev")
    )
    return out.withColumn(id_col, (prev + F.col("_rank")).cast("long")).drop("_prev", "_rank")


def advance_counters(counters: DataFrame, batch: DataFrame, counter_col: str) -> DataFrame:
    """K6 + A1/A2: ``(name, prev_seq, new_seq)`` for every counter that
    receives items in ``batch``; counters without items are unchanged and
    not listed (an empty batch changes nothing)."""
    counts = batch.groupBy(F.col(counter_col).alias("name")).agg(F.count(F.lit(1)).alias("_n"))
    j = counts.join(counters.select("name", F.col("seq").alias("prev_seq")), "name", "left")
    prev = F.when(F.col("prev_seq").isNull(), F.raise_error(F.concat(F.lit("missing counter: "), F.col("name")))).otherwise(
        F.col("prev_seq")
    )
    return j.select("name", prev.cast("long").alias("prev_seq"), (prev + F.col("_n")).cast("long").alias("new_seq"))


def apply_advance(counters: DataFrame, advanced: DataFrame) -> DataFrame:
    """New counters table: advanced seqs replace old ones."""
    upd = advanced.select("name", F.col("new_seq"))
    return counters.join(upd, "name", "left").select("name", F.coalesce("new_seq", "seq").cast("long").alias("seq"))


def init_counters(counters: DataFrame, names: DataFrame) -> DataFrame:
    """K7: counters table plus ``(name, 0)`` for names not present yet.
    Duplicate names (in the table or in ``names``) fail the job."""
    wanted = names.select("name").distinct()
    missing = wanted.join(counters.select("name"), "name", "left_anti").select("name", F.lit(0).cast("long").alias("seq"))
    out = counters.select("name", F.col("seq").cast("long")).unionByName(missing)
    dup = F.count(F.lit(1)).over(Window.partitionBy("name"))
    return out.withColumn("_dup", dup).select(
        "name",
        F.when(F.col("_dup") > 1, F.raise_error(F.concat(F.lit("duplicate counter: "), F.col("name"))))
        .otherwise(F.col("seq"))
        .cast("long")
        .alias("seq"),
    )


def lookup_counter(counters: DataFrame, name: str) -> DataFrame:
    """At most one row; no match is an empty result, not an error."""
    return counters.filter(F.col("name") == name).limit(1)


def counter_json(counters: DataFrame) -> DataFrame:
    """Every counter document as JSON text (null fields kept)."""
    return counters.select("name", F.to_json(F.struct("name", "seq"), {"ignoreNullFields": "false"}).alias("json"))
