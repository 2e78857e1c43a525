"""Feed items: the topic window scan (S1-S3, P1-P3, W3) and the derivation

Driver binding: an ``events`` row is one feed item -- topic =
``event_type``, guid = ``user_id`` as text, published = ``ts``, arrival =
``(ts, event_id)`` -- whose link is the aggregator-wrapped URL of the page
with ``page_id = user_id`` and whose title is that page's title.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions import html as H
from quillstream.functions import links as L
from quillstream.operators.ids import counter_name
from quillstream.sources.tables import read_table

# Fixed values of the source system's search: language and location.
FEED_LANG = "en"
FEED_COUNTRY = "US"

# Fixture parameters: items published before CUTOFF were ingested by
# earlier ticks (they define the counters and the seen keys).
CUTOFF = dt.datetime(2024, 1, 15)


#: Columns of the landed feed.
FEED_SCHEMA = "topic string, lang string, country string, title string, link string, guid string, published timestamp, event_id long"
#: Folder of a landing table: name, its format in Spark and in Python.
SLOTS = {"hour": ("yyyyMMddHH", "%Y%m%d%H"), "day": ("yyyyMMdd", "%Y%m%d")}


def ts_lit(df: DataFrame, col: str, value: dt.datetime):
    """Timestamp literal typed like ``df[col]`` (TIMESTAMP or TIMESTAMP_NTZ),
    so the comparison needs no cast on the column and stays pushable."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast(df.schema[col].dataType)


def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed ``feed_items`` derived from events and pages."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    # page side is projected to (id, url, title) before the join: the HTML
    # never crosses the shuffle
    pages = read_table(spark, sf_dir, "pages").select(
        F.col("page_id"), H.page_title(F.col("html")).alias("title"), L.wrap_link(F.col("url")).alias("link")
    )
    # sort-merge, not broadcast: the page-side columns are expensive and each
    # page matches many events; behind a shuffle they are computed once per
    # page instead of once per matching row (codegen re-evaluates streamed-side
    # projections inside the match loop)
    j = events.join(pages.hint("merge"), events.user_id == pages.page_id)
    return j.select(
        F.col("event_type").alias("topic"),
        F.lit(FEED_LANG).alias("lang"),
        F.lit(FEED_COUNTRY).alias("country"),
        F.col("title"),
        F.col("link"),
        F.col("user_id").cast("string").alias("guid"),
        F.col("ts").alias("published"),
        F.col("event_id"),
    )


def topic_window(
    feed: DataFrame,
    topic: str,
    hi: dt.datetime,
    hours: int,
    time_col: str = "published",
    tie_col: str = "guid",
    limit: int | None = None,
    lang: str | None = FEED_LANG,
    country: str | None = FEED_COUNTRY,
) -> DataFrame:
    """Items of ``topic`` published in ``[hi - hours, hi]`` in the given
    language and country (None: any); a feed without such a column is an
    error, not a filter that is left out.  With ``limit`` (W3) the newest
    ones, by a per-partition top-k (TakeOrderedAndProject); without it all of
    them, unordered.  The bounds are literals, so the predicate is pushed into
    the parquet scan and a rerun is repeatable."""
    lo = hi - dt.timedelta(hours=hours)
    cond = (
        (F.col("topic") == topic)
        & (F.col(time_col) >= ts_lit(feed, time_col, lo))
        & (F.col(time_col) <= ts_lit(feed, time_col, hi))
    )
    for name, wanted in (("lang", lang), ("country", country)):
        if wanted is not None:
            if name not in feed.columns:
                raise ValueError(f"the feed has no column {name!r}: pass {name}=None to take any")
            cond = cond & (F.col(name) == wanted)
    found = feed.filter(cond)
    return found if limit is None else found.orderBy(F.col(time_col).desc(), F.col(tie_col)).limit(limit)


def land_feed(feed: DataFrame, path: str, slot: str = "hour") -> None:
    """Append feed items to a landing table laid out by topic and hour (or
    day); rows of a folder are gathered first, so it gets one file."""
    slotted = feed.withColumn(slot, F.date_format("published", SLOTS[slot][0]))
    slotted.repartition("topic", slot).write.mode("append").partitionBy("topic", slot).parquet(path)


def window_scan(
    spark: SparkSession, path: str, hi: dt.datetime, hours: int, topics: list[str] | None = None, time_col: str = "published"
) -> DataFrame:
    """S1/P2 over a landing table of ``land_feed``: items published in
    ``[hi - hours, hi]``, of the given topics or all.  Only the folders of
    those topics and hours (or days) are read (partition filters)."""
    lo = hi - dt.timedelta(hours=hours)
    feed = spark.read.parquet(path)
    name = next(n for n in SLOTS if n in feed.columns)
    # folder names may be read as numbers; compared as text either way
    slot, topic, form = F.col(name).cast("string"), F.col("topic").cast("string"), SLOTS[name][1]
    found = feed.filter((slot >= lo.strftime(form)) & (slot <= hi.strftime(form)))
    if topics is not None:
        found = found.filter(topic.isin(topics))
    found = found.filter((F.col(time_col) >= ts_lit(feed, time_col, lo)) & (F.col(time_col) <= ts_lit(feed, time_col, hi)))
    return found.withColumn("topic", topic).drop(name)


def project_items(feed: DataFrame) -> DataFrame:
    """P1 + P8: feed row -> news item (guid, title, date, link, source).
    The link is the unwrapped publisher link, or the original link when it
    cannot be decoded; source is the site name (host fallback of H4)."""
    x = L.source_links_df(feed.select("guid", "title", "published", "link"), "link")
    return x.select("guid", "title", F.col("published").alias("date"), "link", L.url_host(F.col("link")).alias("source"))


def counters_table(spark: SparkSession, sf_dir: str, before: dt.datetime | None = None) -> DataFrame:
    """Counters, one per topic, seq = its items; with ``before`` as earlier
    ticks left them: only items published before that time count."""
    events = read_table(spark, sf_dir, "events")
    past = events if before is None else events.filter(F.col("ts") < ts_lit(events, "ts", before))
    return (
        past.groupBy(counter_name(F.col("event_type")).alias("name"))
        .agg(F.count(F.lit(1)).cast("long").alias("seq"))
    )


def current_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the current tick (published at or after CUTOFF)."""
    events = read_table(spark, sf_dir, "events")
    return events.filter(F.col("ts") >= ts_lit(events, "ts", CUTOFF))


def hourly_guid(guid, published):
    """Guid of a user's items of one hour of the day: fine enough that a
    batch holds both known and new guids."""
    return F.concat_ws(":", guid.cast("string"), F.date_format(published, "HH"))


def seen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly guids of all items of earlier ticks."""
    events = read_table(spark, sf_dir, "events")
    past = events.filter(F.col("ts") < ts_lit(events, "ts", CUTOFF))
    return past.select(hourly_guid(F.col("user_id"), F.col("ts")).alias("guid"))
