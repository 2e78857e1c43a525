"""The backfill job: stored items without an analysis are scored and merged
(S4 -> J1 -> E3 -> E4 -> K3/K4)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.functions import llm as M
from quillstream.operators import dedupe as D
from quillstream.operators import merge as MG
from quillstream.plans.ingest import answered, with_pages, written


def run_backfill(
    spark: SparkSession,
    path: str,
    key: str,
    buckets: int,
    pages: DataFrame | None = None,
    make_scorer: Callable | None = None,
    make_client: Callable | None = None,
    concurrency: int | None = None,
    answers_path: str | None = None,
    only=None,
    page_key: str | None = None,
) -> list[int]:
    """Score every stored item whose ``analyse`` is absent and merge the
    answers into the table at ``path`` (``merge.write_bucketed``: key,
    title, link, score, analyse).  ``only`` is a further condition, such as
    one topic.  ``pages`` (url and html, or url and content) give the
    content; an item whose page is missing is scored on its title.  Items
    may share a link: with ``page_key``, the column of ``pages`` with the
    item's key, each has its own page.  An item with several pages is scored
    once, on the least of their texts (none before any).  An
    answer that does not parse leaves its item as it is, to be found by the
    next run; a neutral one deletes the item.  With ``answers_path`` a run
    that failed calls the model only for what has no answer yet.  Returns
    the buckets that were rewritten."""
    items = MG.backfill_candidates(MG.read_bucketed(spark, path, key))
    if only is not None:
        items = items.filter(only)
    wanted = written(items.select(F.col(key).alias("guid"), "title", "link"), "candidates")
    scored = with_pages(wanted, pages, page_key)
    if pages is not None:
        scored = D.first_per_key(scored.select("guid", "scoring_text"), ["guid"], ["scoring_text"])
    texts = answered(scored, None, make_client, make_scorer, concurrency, answers_path)
    # written, so that a filter on the parsed answer does not parse it again
    parsed = written(texts.select(F.col("guid").alias(key), M.strict_answer(F.col("answer")).alias("p")), "answers")
    updates = parsed.filter("p.reason IS NULL").select(key, "p.score", "p.analyse")
    return MG.merge_into(spark, path, updates, key, ["score", "analyse"], buckets, delete_neutral_col="score")
