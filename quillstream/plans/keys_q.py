"""Queries for feed windows, dedupe, id allocation and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstream.operators import dedupe as D
from quillstream.operators import ids as I
from quillstream.plans import sqlfrag as S
from quillstream.plans.catalog import register
from quillstream.sources import feed as FD
from quillstream.sources.tables import read_table

CUT = FD.CUTOFF.strftime("%Y-%m-%d %H:%M:%S")
_ALL_COUNTERS_SQL = f"SELECT event_type || '{I.COUNTER_SUFFIX}' AS name, count(*)::BIGINT AS seq FROM events GROUP BY 1"
_COUNTERS_SQL = (
    f"SELECT event_type || '{I.COUNTER_SUFFIX}' AS name, count(*)::BIGINT AS seq FROM events "
    f"WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1"
)
_BATCH_SQL = f"SELECT * FROM events WHERE ts >= TIMESTAMP '{CUT}'"

# ------------------------------------------------------------------ S1 / P2 / P3 / W3

WINDOW_TOPIC = "click"
WINDOW_HOURS = 48
WINDOW_LIMIT = 30  # fixed value: items per topic and poll
_LANG_SQL = "CASE WHEN user_id % 5 = 0 THEN 'de' ELSE 'en' END"
_COUNTRY_SQL = "CASE WHEN user_id % 7 = 0 THEN 'DE' ELSE 'US' END"


@register(
    "feed_topic_window",
    f"WITH hi AS (SELECT max(ts) AS t FROM events WHERE event_type = '{WINDOW_TOPIC}') "
    f"SELECT event_id, ts, user_id FROM events, hi WHERE event_type = '{WINDOW_TOPIC}' "
    f"AND ts >= t - INTERVAL {WINDOW_HOURS} HOURS AND ts <= t AND {_LANG_SQL} = 'en' AND {_COUNTRY_SQL} = 'US' "
    f"ORDER BY ts DESC, event_id LIMIT {WINDOW_LIMIT}",
)
def feed_topic_window(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", F.col("event_type").alias("topic"),
        F.expr(_LANG_SQL).alias("lang"), F.expr(_COUNTRY_SQL).alias("country"),
    )
    hi = events.filter(F.col("topic") == WINDOW_TOPIC).agg(F.max("ts")).first()[0]  # the topic's newest item
    w = FD.topic_window(events, WINDOW_TOPIC, hi, WINDOW_HOURS, time_col="ts", tie_col="event_id", limit=WINDOW_LIMIT)
    return w.select("event_id", "ts", "user_id")


# ------------------------------------------------------------------ P1 / P8


@register(
    "feed_project",
    f"SELECT e.user_id::VARCHAR AS guid, {S.page_title('p.html')} AS title, e.ts AS date, p.url AS link, "
    r"regexp_extract(p.url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1) AS source "
    "FROM events e JOIN pages p ON p.page_id = e.user_id",
)
def feed_project(spark, sf_dir):
    return FD.project_items(FD.feed_items(spark, sf_dir))


# ------------------------------------------------------------------ D1 / D2


@register(
    "dedupe_first",
    "SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id",
)
def dedupe_first(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id")
    return D.first_per_key(events, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id")


_HOURLY_SQL = "user_id || ':' || strftime(ts, '%H')"


@register(
    "dedupe_new_only",
    f"SELECT {_HOURLY_SQL} AS guid, arg_min(event_id, (ts, event_id)) AS event_id FROM ({_BATCH_SQL}) b "
    f"WHERE {_HOURLY_SQL} NOT IN (SELECT {_HOURLY_SQL} FROM events WHERE ts < TIMESTAMP '{CUT}') GROUP BY 1",
)
def dedupe_new_only(spark, sf_dir):
    batch = FD.current_batch(spark, sf_dir).select(FD.hourly_guid(F.col("user_id"), F.col("ts")).alias("guid"), "ts", "event_id")
    return D.new_only(batch, FD.seen_keys(spark, sf_dir), "guid", ["ts", "event_id"]).select("guid", "event_id")


# ------------------------------------------------------------------ W1 / K6 / K7 / S5 / K11


@register(
    "allocate_ids",
    f"WITH c AS ({_COUNTERS_SQL}) SELECT b.event_id, (c.seq + row_number() OVER "
    f"(PARTITION BY b.event_type ORDER BY b.ts, b.event_id))::BIGINT AS id "
    f"FROM ({_BATCH_SQL}) b JOIN c ON c.name = b.event_type || '{I.COUNTER_SUFFIX}'",
)
def allocate_ids(spark, sf_dir):
    batch = FD.current_batch(spark, sf_dir).select(
        "event_id", "ts", I.counter_name(F.col("event_type")).alias("counter")
    )
    out = I.allocate_ids(batch, ["ts", "event_id"], "counter", FD.counters_table(spark, sf_dir, FD.CUTOFF))
    return out.select("event_id", "id")


@register("counter_lookup", f"SELECT name, seq FROM ({_ALL_COUNTERS_SQL}) WHERE name = 'click{I.COUNTER_SUFFIX}' LIMIT 1")
def counter_lookup(spark, sf_dir):
    return I.lookup_counter(FD.counters_table(spark, sf_dir), f"click{I.COUNTER_SUFFIX}")


@register(
    "counter_json",
    f"SELECT name, to_json(struct_pack(name := name, seq := seq))::VARCHAR AS json FROM ({_ALL_COUNTERS_SQL})",
)
def counter_json(spark, sf_dir):
    return I.counter_json(FD.counters_table(spark, sf_dir))


@register(
    "counter_advance",
    f"WITH c AS ({_COUNTERS_SQL}), n AS (SELECT event_type || '{I.COUNTER_SUFFIX}' AS name, count(*) AS k "
    f"FROM ({_BATCH_SQL}) GROUP BY 1) "
    "SELECT n.name, c.seq::BIGINT AS prev_seq, (c.seq + n.k)::BIGINT AS new_seq FROM n JOIN c ON c.name = n.name",
)
def counter_advance(spark, sf_dir):
    batch = FD.current_batch(spark, sf_dir).select(I.counter_name(F.col("event_type")).alias("counter"))
    return I.advance_counters(FD.counters_table(spark, sf_dir, FD.CUTOFF), batch, "counter")


# per-day topics: the first half of the month already has counters
_DAY_NAME = "event_type || ':' || strftime(ts, '%Y-%m-%d') || '" + I.COUNTER_SUFFIX + "'"


def _day_name():
    return I.counter_name(F.concat(F.col("event_type"), F.lit(":"), F.date_format("ts", "yyyy-MM-dd")))


@register(
    "counter_init",
    f"WITH have AS (SELECT {_DAY_NAME} AS name, count(*)::BIGINT AS seq FROM events "
    f"WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1), want AS (SELECT DISTINCT {_DAY_NAME} AS name FROM events) "
    "SELECT name, seq FROM have UNION ALL SELECT name, 0::BIGINT AS seq FROM want "
    "WHERE name NOT IN (SELECT name FROM have)",
)
def counter_init(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    have = (
        events.filter(F.col("ts") < FD.ts_lit(events, "ts", FD.CUTOFF))
        .groupBy(_day_name().alias("name"))
        .agg(F.count(F.lit(1)).cast("long").alias("seq"))
    )
    want = events.select(_day_name().alias("name"))
    return I.init_counters(have, want)

