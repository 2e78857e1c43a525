"""The flagship query: one ingest tick over the whole current batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstream.functions import html as H
from quillstream.operators import ids as I
from quillstream.plans import ingest as G
from quillstream.plans import sqlfrag as S
from quillstream.plans.catalog import register
from quillstream.plans.pages_q import HOST_SQL, pages_with_meta
from quillstream.sources import feed as FD

CUT = FD.CUTOFF.strftime("%Y-%m-%d %H:%M:%S")
_GUID = "{u} || ':' || strftime({t}, '%H')"

# the site name that an https page states (and that was fetched whole), else the host
SOURCE_SQL = (
    f"CASE WHEN starts_with(p.url, 'https://') AND {S.has_complete_body('p.html')} THEN 'Site ' || p.page_id "
    f"ELSE {HOST_SQL.replace('url', 'p.url')} END"
)

BATCH_INGEST_SQL = f"""
WITH items AS (
  SELECT e.event_type AS topic, {_GUID.format(u='e.user_id', t='e.ts')} AS guid, e.ts, e.event_id,
         {S.page_title('p.html')} AS title, p.url AS link, {SOURCE_SQL} AS source
  FROM events e JOIN pages p ON p.page_id = e.user_id
  WHERE e.ts >= TIMESTAMP '{CUT}'),
fresh AS (SELECT * FROM items WHERE guid NOT IN (SELECT {_GUID.format(u='user_id', t='ts')} FROM events WHERE ts < TIMESTAMP '{CUT}')),
landed AS (SELECT url, {S.article_text('html')} AS content FROM pages WHERE {S.has_complete_body('html')}),
texts AS (SELECT f.*, {S.compose_scoring_text('f.title', 'l.content')} AS st FROM fresh f LEFT JOIN landed l ON l.url = f.link),
ans AS (SELECT *, ((length(st) % 11) - 5)::VARCHAR AS score, length(st) || ' characters' AS "analyse" FROM texts),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY guid ORDER BY ts, event_id) AS rn FROM ans) WHERE rn = 1),
kept AS (SELECT * FROM firsts WHERE score <> '0'),
c AS (SELECT event_type || '{I.COUNTER_SUFFIX}' AS name, count(*) AS seq FROM events WHERE ts < TIMESTAMP '{CUT}' GROUP BY 1)
SELECT k.topic, (c.seq + row_number() OVER (PARTITION BY k.topic ORDER BY k.ts, k.event_id))::BIGINT AS id,
       k.guid, k.title, k.ts AS date, k.link, k.source, k.score, k."analyse"
FROM kept k JOIN c ON c.name = k.topic || '{I.COUNTER_SUFFIX}'
"""


def batch_tick(spark, sf_dir):
    feed = FD.feed_items(spark, sf_dir)
    items = feed.filter(F.col("published") >= FD.ts_lit(feed, "published", FD.CUTOFF))
    items = items.withColumn("guid", FD.hourly_guid(F.col("guid"), F.col("published")))
    counters = FD.counters_table(spark, sf_dir, FD.CUTOFF)
    pages = pages_with_meta(spark, sf_dir).filter(H.has_complete_body(F.col("html"))).select("url", "html")
    return G.run_tick(items, FD.seen_keys(spark, sf_dir), counters, page_content=pages)


@register("batch_ingest", BATCH_INGEST_SQL)
def batch_ingest(spark, sf_dir):
    return batch_tick(spark, sf_dir).items
