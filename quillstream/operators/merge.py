"""Set-based table mutations.

The source system updates and deletes one document per round trip; here a
whole backfill is one join.  The update side is small (the backfilled
rows) and is reduced per key with a hash aggregate before the join, so
AQE broadcasts it at runtime when it fits and the base table is streamed
without a shuffle; when it does not fit the join falls back to a
sort-merge join on the key.

A stored table is laid out by buckets of its key (``write_bucketed``), and
``merge_into`` reads, checks and overwrites only the buckets that updates
hit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions.llm import is_neutral
from quillstream.session import scratch_path

DEFAULT_LINK = "default_link"  # fixed value used by the link repair


def backfill_candidates(items: DataFrame, field: str = "analyse") -> DataFrame:
    """Rows whose ``field`` is absent (NULL).  An empty string is a
    present value and is *not* a candidate."""
    return items.filter(F.col(field).isNull())


def merge_updates(
    base: DataFrame,
    updates: DataFrame,
    key: str,
    columns: Sequence[str],
    delete_neutral_col: str | None = None,
    check_base_unique: bool = False,
) -> DataFrame:
    """K3 + K4: set ``columns`` from ``updates`` on matching ``key``; when
    ``delete_neutral_col`` is given, matched rows whose new value there is
    the neutral score are deleted.  Unmatched rows are unchanged.  A key
    that appears twice in ``updates`` fails the job (merge needs a unique
    key; the source system silently touched the first match only).
    ``check_base_unique`` also verifies the base side (``merge_into`` does so
    for the buckets it touches); it is a full aggregation of ``base``."""
    cols = list(columns)
    reduced = updates.groupBy(key).agg(
        F.count(F.lit(1)).alias("_k"), *[F.first(c).alias(f"_u_{c}") for c in cols]
    )
    reduced = reduced.withColumn(
        "_k",
        F.when(F.col("_k") > 1, F.raise_error(F.concat(F.lit("duplicate update key: "), F.col(key).cast("string"))))
        .otherwise(F.col("_k")),
    )
    if check_base_unique:
        dup = base.groupBy(key).count().filter(F.col("count") > 1).limit(1).collect()
        if dup:
            raise ValueError(f"duplicate base key: {dup[0][key]}")
    j = base.join(reduced, key, "left")
    matched = F.col("_k").isNotNull()
    out = j
    for c in cols:
        out = out.withColumn(c, F.when(matched, F.col(f"_u_{c}")).otherwise(F.col(c)))
    if delete_neutral_col is not None:
        out = out.filter(~(matched & is_neutral(F.col(delete_neutral_col))))
    return out.select(*base.columns)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _put(rows: DataFrame, path: str, key: str, buckets: int, only: list[int] | None = None) -> None:
    """Overwrite the buckets ``only`` (None: all) with ``rows``.  Each gets a
    row without a key as well, so that a bucket whose last row goes is
    overwritten too; readers leave it out."""
    spark = rows.sparkSession
    numbers = spark.range(buckets) if only is None else spark.createDataFrame([(b,) for b in only], "id long")
    marks = numbers.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema), F.col("id").cast("int").alias("bucket"))
    laid = rows.withColumn("bucket", bucket_of(F.col(key), buckets)).unionByName(marks)
    parts = buckets if only is None else max(1, len(only))
    writer = laid.repartition(parts, "bucket").write.mode("overwrite").partitionBy("bucket")
    writer.option("partitionOverwriteMode", "static" if only is None else "dynamic").parquet(path)


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Store ``rows`` (keys not null) as a table of ``buckets`` folders."""
    _put(rows.filter(F.col(key).isNotNull()), path, key, buckets)


def read_bucketed(spark: SparkSession, path: str, key: str, only: list[int] | None = None) -> DataFrame:
    """The stored table, or the given buckets of it (a partition filter)."""
    rows = spark.read.parquet(path)
    if only is not None:
        rows = rows.filter(F.col("bucket").isin(only))
    return rows.filter(F.col(key).isNotNull())


def merge_into(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str,
    columns: Sequence[str],
    buckets: int,
    delete_neutral_col: str | None = None,
) -> list[int]:
    """K3 + K4 on a stored table: ``merge_updates`` for the buckets that
    ``updates`` hit; the others are neither read nor written.  A key that is
    there twice in such a bucket, or twice in ``updates``, fails the job
    before anything is written (C8).  Returns the buckets.

    The new content is written aside first, then the buckets are overwritten
    by one dynamic partition overwrite; run again after a failure in between,
    the merge gives the same table.  One writer at a time."""
    staged = scratch_path(spark, "updates")
    updates.withColumn("bucket", bucket_of(F.col(key), buckets)).write.parquet(staged)
    updates = spark.read.parquet(staged)
    hit = sorted(r["bucket"] for r in updates.select("bucket").distinct().collect())  # at most ``buckets``
    if not hit:
        return hit
    base = read_bucketed(spark, path, key, hit).drop("bucket")
    merged = merge_updates(base, updates.drop("bucket"), key, columns, delete_neutral_col, check_base_unique=True)
    aside = scratch_path(spark, "merged")
    merged.write.parquet(aside)
    _put(spark.read.parquet(aside), path, key, buckets, hit)
    return hit


def repair_links(items: DataFrame, link_col: str = "link") -> DataFrame:
    """K5 + P7: empty or absent links become the default link."""
    blank = F.coalesce(F.col(link_col), F.lit("")) == ""
    return items.withColumn(link_col, F.when(blank, F.lit(DEFAULT_LINK)).otherwise(F.col(link_col)))
