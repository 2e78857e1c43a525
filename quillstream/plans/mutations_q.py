"""Queries for table mutations and sinks: backfill, merge, link repair,
table creation and append."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstream.functions import html as H
from quillstream.functions import llm as M
from quillstream.operators import merge as MG
from quillstream.operators.scoring import score_rows
from quillstream.plans import sqlfrag as S
from quillstream.plans.backfill import run_backfill
from quillstream.plans.catalog import register
from quillstream.plans.ingest import written
from quillstream.session import scratch_path
from quillstream.sources import feed as FD
from quillstream.sources import sinks as K
from quillstream.sources.tables import read_table

# Stored items for the backfill: one per document.  Labelled documents
# were scored before (score = quality - toxic; a 0/0 label left an empty
# analysis, which is present and is not backfilled); unlabelled documents
# predate the analysis field (absent -> NULL).


def stored_items(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    j = docs.join(labels, "doc_id", "left")
    labelled = F.col("quality").isNotNull()
    analyse = F.when(
        labelled,
        F.when((F.col("quality") == 0) & (F.col("toxic") == 0), F.lit("")).otherwise(
            F.concat(F.lit("quality="), F.col("quality"), F.lit(" toxic="), F.col("toxic"))
        ),
    )
    score = F.when(labelled, (F.col("quality") - F.col("toxic")).cast("string"))
    return j.select("doc_id", "text", score.alias("score"), analyse.alias("analyse"))


_STORED_SQL = """
SELECT d.doc_id, d.text, (l.quality - l.toxic)::VARCHAR AS score,
  CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.quality = 0 AND l.toxic = 0 THEN ''
       ELSE 'quality=' || l.quality || ' toxic=' || l.toxic END AS "analyse"
FROM documents d LEFT JOIN labels l USING (doc_id)
"""


@register("backfill_candidates", f"SELECT doc_id FROM ({_STORED_SQL}) WHERE \"analyse\" IS NULL")
def backfill_candidates(spark, sf_dir):
    return MG.backfill_candidates(stored_items(spark, sf_dir)).select("doc_id")


@register(
    "backfill_merge",
    f"""WITH base AS ({_STORED_SQL}),
upd AS (SELECT doc_id, ((length(text) % 11) - 5)::VARCHAR AS score, length(text) || ' characters' AS "analyse"
        FROM base WHERE "analyse" IS NULL AND text IS NOT NULL)
SELECT b.doc_id, CASE WHEN u.doc_id IS NULL THEN b.score ELSE u.score END AS score,
       CASE WHEN u.doc_id IS NULL THEN b."analyse" ELSE u."analyse" END AS "analyse"
FROM base b LEFT JOIN upd u USING (doc_id) WHERE u.doc_id IS NULL OR u.score <> '0'""",
)
def backfill_merge(spark, sf_dir):
    items = stored_items(spark, sf_dir)
    cand = MG.backfill_candidates(items)
    # the model is only called for candidates (filter before the Python hop)
    answers = score_rows(cand.select("doc_id", "text"), "text")
    # written: the model is called once, and the filter does not parse again
    parsed = written(answers.select("doc_id", M.strict_answer(F.col("answer")).alias("p")), "answers")
    updates = parsed.filter(F.col("p.reason").isNull()).select(
        "doc_id", F.col("p.score").alias("score"), F.col("p.analyse").alias("analyse")
    )
    merged = MG.merge_updates(items, updates, "doc_id", ["score", "analyse"], delete_neutral_col="score")
    return merged.select("doc_id", "score", "analyse")


# ------------------------------------------------------------------ backfill job
# Pages as stored items, every second one without an analysis, in a table of
# buckets; pages that never arrived whole are scored on the title alone.

BUCKETS = 16

_ITEMS_SQL = f"""
SELECT page_id AS id, {S.page_title('html')} AS title, url AS link,
  CASE WHEN page_id % 2 = 1 THEN 'old' END AS "analyse", CASE WHEN page_id % 2 = 1 THEN '1' END AS score,
  CASE WHEN {S.has_complete_body('html')} THEN {S.article_text('html')} END AS content
FROM pages"""


@register(
    "backfill_job",
    f"""WITH base AS ({_ITEMS_SQL}),
upd AS (SELECT *, {S.compose_scoring_text('title', 'content')} AS st FROM base)
SELECT id, CASE WHEN "analyse" IS NULL THEN ((length(st) % 11) - 5)::VARCHAR ELSE score END AS score,
       CASE WHEN "analyse" IS NULL THEN length(st) || ' characters' ELSE "analyse" END AS "analyse"
FROM upd WHERE "analyse" IS NOT NULL OR length(st) % 11 <> 5""",
)
def backfill_job(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    old = F.col("page_id") % 2 == 1
    items = pages.select(
        F.col("page_id").alias("id"), H.page_title(F.col("html")).alias("title"), F.col("url").alias("link"),
        F.when(old, "1").alias("score"), F.when(old, "old").alias("analyse"),
    )
    path = K.table_path(scratch_path(spark, "ns"), "test", "scored_items")
    MG.write_bucketed(items, path, "id", BUCKETS)
    fetched = pages.filter(H.has_complete_body(F.col("html"))).select("page_id", "url", "html")
    run_backfill(spark, path, "id", BUCKETS, pages=fetched, page_key="page_id")
    return MG.read_bucketed(spark, path, "id").select("id", "score", "analyse")


# ------------------------------------------------------------------ K5 / P7
# Pages as stored items whose link was lost: truncated http pages have no
# link field, truncated https pages an empty one.


@register(
    "repair_links",
    f"SELECT page_id, CASE WHEN {S.has_complete_body('html')} THEN url ELSE 'default_link' END AS link FROM pages",
)
def repair_links(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    complete = H.has_complete_body(F.col("html"))
    link = (
        F.when(complete, F.col("url"))
        .when(F.col("url").startswith("http://"), F.lit(None).cast("string"))
        .otherwise(F.lit(""))
    )
    items = pages.select("page_id", link.alias("link"))
    return MG.repair_links(items).select("page_id", "link")


# ------------------------------------------------------------------ K8


@register(
    "table_init",
    "SELECT DISTINCT event_type AS topic, 0::BIGINT AS n_rows FROM events",
)
def table_init(spark, sf_dir):
    path = K.table_path(scratch_path(spark, "ns"), "test", "news_items")
    table = K.init_table(spark, path, K.NEWS_ITEMS, partition_by="topic")
    topics = read_table(spark, sf_dir, "events").select(F.col("event_type").alias("topic")).distinct()
    counts = table.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return topics.join(counts, "topic", "left").select(
        "topic", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n_rows")
    )


# ------------------------------------------------------------------ K1 / K2 / K9


def _as_items(events):
    return events.select(
        F.col("event_id").alias("id"),
        F.lit(None).cast("string").alias("title"),
        F.col("ts").cast("timestamp").alias("date"),
        F.lit(None).cast("string").alias("link"),
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("string").alias("score"),
        F.lit(None).cast("string").alias("analyse"),
        F.col("event_type").alias("topic"),
    )


@register(
    "append_roundtrip",
    "SELECT event_type AS topic, count(*)::BIGINT AS n FROM events GROUP BY 1",
)
def append_roundtrip(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    path = K.table_path(scratch_path(spark, "ns"), "test2", "news_items")
    cut = FD.ts_lit(events, "ts", FD.CUTOFF)
    K.append(_as_items(events.filter(F.col("ts") < cut)), path)
    K.append(_as_items(events.filter(F.col("ts") >= cut)), path)
    K.append(_as_items(events.filter(F.lit(False))), path)  # empty batch: no-op
    back = spark.read.schema(K.NEWS_ITEMS).parquet(path)
    return back.groupBy("topic").agg(F.count(F.lit(1)).cast("long").alias("n"))
