"""One ingest tick as a DataFrame plan (S1 -> ... -> K1).

Plan order (contract C6, with the expensive steps moved after the cheap
filters -- Catalyst cannot reorder around the Python model call):

1. reduce copies of an item (same guid, title and link, hence the same
   scoring text) to their first arrival -- a partial aggregate, so a hot
   guid costs one model call and one page lookup, not one per copy, and
   reaches the joins as one row;
2. anti-join them against the persisted seen keys (D2);
3. unwrap links (U1/P8); an unresolved link takes the publisher link of a
   landed resolver response (U5), or waits for one: its resolver request
   (U4) is returned, and the item with it, until ``hold_ticks`` have gone by;
4. left-join pages (J1): article and site name (H5, H4/J2) of the linked
   pages only; compose the scoring text with the title-only fallback (X2/P9);
5. obtain answers: landed responses joined on the guid (J4/E2a/E5), a chat
   client whose status/body are parsed in Spark, or a scorer (E3); the
   result is written once so the model is never called twice;
6. strict parse (E4/C5); rejects go to the quarantine output and are
   *not* marked seen; ``rejected`` returns their items, which the streaming
   ingest feeds into its next tick;
7. first parseable row per guid in arrival order (D1, partial aggregate),
   written once: items, seen keys and counters are all read from it;
8. every survivor is marked seen (neutral ones too);
9. drop neutral scores (P4);
10. allocate contiguous ids per topic counter (W1/K6) and advance counters.

``arrival`` names the columns that order a tick's rows (default
``published, event_id``); ties must be broken by the last one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.functions import html as H
from quillstream.functions import links as L
from quillstream.functions import llm as M
from quillstream.functions import text as T
from quillstream.operators import dedupe as D
from quillstream.operators import ids as I
from quillstream.operators.scoring import Scorer, fetch_rows, land_responses, score_rows, scorer_client, standin_scorer
from quillstream.session import scratch_path

ARRIVAL = ["published", "event_id"]


@dataclass
class TickResult:
    items: DataFrame              # stored rows: topic, id, guid, title, date, link, source, score, analyse
    seen: DataFrame               # guid keys to mark seen
    counters: DataFrame           # name, prev_seq, new_seq
    quarantine: DataFrame         # guid, reason, answer
    requests: DataFrame           # guid, request (model request JSON for the scorer/fetcher)
    rejected: DataFrame           # input rows whose answer was rejected, columns of the input
    unresolved: DataFrame         # input rows that wait for their link, columns of the input
    resolver_requests: DataFrame  # key, payload (U4) of the links asked for
    first: DataFrame              # first parseable row per guid
    linked: DataFrame             # distinct unseen items with their links


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: computed once, and
    its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def resolve_links(items: DataFrame, resolver_responses: DataFrame | None = None) -> DataFrame:
    """``items`` with ``link`` unwrapped and ``_resolver_id`` set where the
    publisher link is not known yet.  ``resolver_responses``: key (resolver
    id), status, body, as the fetcher landed them, several per key at most
    as tries; a response without a link counts as none."""
    # written, so that the planner need not carry the decoding into the join's key
    x = written(L.unwrap_links_df(items, "link", "_u"), "unwrapped")
    if resolver_responses is not None:
        found = resolver_responses.select("key", L.resolver_parse(F.col("status"), F.col("body"))["link"].alias("found"))
        found = found.filter("found IS NOT NULL").groupBy("key").agg(F.min("found").alias("_found"))
        x = x.join(found, F.col("_u.resolver_id") == found["key"], "left").drop("key")
    else:
        x = x.withColumn("_found", F.lit(None).cast("string"))
    link = F.coalesce(F.col("_found"), F.col("_u.link"), F.col("link"))
    waits = F.when(F.col("_found").isNull(), F.col("_u.resolver_id"))
    return x.withColumns({"link": link, "_resolver_id": waits}).drop("_u", "_found")


def with_pages(items: DataFrame, pages: DataFrame | None, page_key: str | None = None) -> DataFrame:
    """Step 4: ``source`` (the page's site name, else the host), and the
    scoring text.  ``pages`` has url and html, of which only the pages that
    items link to are extracted, or url and content made elsewhere.  Several
    pages at one url give an item a row each; with ``page_key``, the column
    of ``pages`` with the guid of a page's item, only that item has it."""
    host = L.url_host(F.col("link"))
    if pages is None:
        return items.withColumns({"source": host, "scoring_text": T.compose_scoring_text(F.col("title"), F.lit(None).cast("string"))})
    if "html" in pages.columns:
        keys = ["url"] if page_key is None else ["url", page_key]
        wanted = items.select(*(F.col(c).alias(k) for c, k in zip(("link", "guid"), keys, strict=False))).distinct()
        own = pages.join(wanted, keys, "left_semi").select(*keys, H.page_parts(F.col("html")).alias("_p"))
        pages = own.select(*keys, T.clean_words(F.col("_p.article")).alias("content"), F.col("_p.site_name").alias("site_name"))
    site = F.col("site_name") if "site_name" in pages.columns else F.lit(None).cast("string")
    # AQE broadcasts the page side when its runtime size is under the
    # threshold, else sort-merge
    item = F.lit(None) if page_key is None else F.col(page_key)
    own = pages.select(F.col("url").alias("_url"), F.col("content").alias("_content"), site.alias("_site"), item.alias("_item"))
    met = F.col("link") == F.col("_url")
    x = items.join(own, met if page_key is None else met & (F.col("guid") == F.col("_item")), "left")
    x = x.withColumns(
        {"source": F.coalesce(F.col("_site"), host), "scoring_text": T.compose_scoring_text(F.col("title"), F.col("_content"))}
    )
    return x.drop("_url", "_content", "_site", "_item")


def answered(
    x: DataFrame,
    responses: DataFrame | None = None,
    make_client: Callable | None = None,
    make_scorer: Callable[[], Scorer] | None = None,
    concurrency: int | None = None,
    answers_path: str | None = None,
) -> DataFrame:
    """Step 5: ``x`` (guid, scoring_text, ...) with ``answer``.  With
    ``answers_path`` the model's responses are landed there by digest of the
    request, and only requests without one are called."""
    if responses is not None:
        r = responses.select(F.col("key").alias("_key"), M.first_choice_content(F.col("status"), F.col("body")).alias("answer"))
        x = x.join(r, x.guid == r._key, "left").drop("_key")
        return x.withColumn("answer", F.coalesce(F.col("answer"), F.lit(M.NO_RESULT)))
    scorer = make_scorer or (lambda: standin_scorer)
    request = M.scoring_request(F.col("scoring_text")) if make_client is not None else F.col("scoring_text")
    if answers_path is not None:
        x = x.withColumn("_request", request).withColumn("_key", F.sha2(F.col("_request"), 256))
        client = make_client or scorer_client(scorer)
        asked = x.filter("_request IS NOT NULL").select(F.col("_key").alias("key"), F.col("_request").alias("request"))
        landed = land_responses(asked, answers_path, client, concurrency=concurrency)
        content = M.first_choice_content(F.col("status"), F.col("body")) if make_client is not None else F.col("body")
        landed = landed.select(F.col("key").alias("_key"), content.alias("answer"))
        x = x.join(landed, "_key", "left").drop("_key", "_request")
        return x.withColumn("answer", F.coalesce(F.col("answer"), F.lit(M.NO_RESULT)))
    if make_client is not None:
        x = fetch_rows(x.withColumn("_request", request), "_request", make_client, concurrency)
        return x.withColumn("answer", M.first_choice_content(F.col("status"), F.col("body"))).drop("_request", "status", "body")
    return score_rows(x, "scoring_text", scorer, concurrency=concurrency)


def run_tick(
    items: DataFrame,
    seen: DataFrame,
    counters: DataFrame,
    page_content: DataFrame | None = None,
    responses: DataFrame | None = None,
    make_scorer: Callable[[], Scorer] | None = None,
    arrival: list[str] = ARRIVAL,
    concurrency: int | None = None,
    make_client: Callable | None = None,
    resolver_responses: DataFrame | None = None,
    hold_ticks: int = 0,
    answers_path: str | None = None,
) -> TickResult:
    """``items``: topic, guid, title, link, published (+ arrival columns).
    ``seen``: guid.  ``counters``: name, seq.  ``page_content``: url and
    html, or url and content.  Provide either landed ``responses`` (key,
    status, body) keyed by guid, ``make_client`` (a chat client returning
    status and body, parsed here in Spark), or ``make_scorer`` (returns the
    answer text); ``concurrency`` bounds the number of parallel model
    clients.  Items whose link is unresolved wait while their ``tries`` are
    below ``hold_ticks``; after that, and without ``hold_ticks``, they go on
    with the aggregator link (P8)."""
    # one model call per distinct item: the scoring text is a function of
    # (title, link), so copies are collapsed (map-side partial aggregate)
    # before the anti join, link decoding, page join or text composition
    distinct_items = D.first_per_key(items, ["guid", "title", "link"], arrival)
    fresh = D.not_seen(distinct_items, seen.select("guid"), "guid").withColumn("_feed_link", F.col("link"))
    linked = written(resolve_links(fresh, resolver_responses), "linked")
    waits = F.lit(False)
    if hold_ticks:
        tries = F.col("tries") if "tries" in items.columns else F.lit(0)
        waits = F.col("_resolver_id").isNotNull() & (tries < hold_ticks)
    held = linked.filter(waits)
    unresolved = held.withColumn("link", F.col("_feed_link")).select(items.columns)
    resolver_requests = held.select(F.col("_resolver_id").alias("key")).distinct()
    resolver_requests = resolver_requests.withColumn("payload", L.resolver_request(F.col("key")))

    x = with_pages(linked.filter(~waits).drop("_resolver_id"), page_content)
    x = answered(x, responses, make_client, make_scorer, concurrency, answers_path)

    # Materialise the answers once, as a table in the shared checkpoint
    # folder: a real model is not deterministic, several outputs read single
    # columns of them, and a lost executor must not call the model again.
    x = written(x.withColumn("_p", M.strict_answer(F.col("answer"))), "answers")
    quarantine = x.filter(F.col("_p.reason").isNotNull()).select("guid", F.col("_p.reason").alias("reason"), "answer")
    ok = x.filter(F.col("_p.reason").isNull()).select(
        "topic", "guid", "title", "link", "source", *arrival,
        F.col("_p.score").alias("score"), F.col("_p.analyse").alias("analyse"),
    )
    first = written(D.first_per_key(ok, ["guid"], arrival), "first")
    new_seen = first.select("guid")
    kept = first.filter(~M.is_neutral(F.col("score"))).withColumn("counter", I.counter_name(F.col("topic")))
    with_ids = I.allocate_ids(kept, arrival, "counter", counters)
    stored = with_ids.select(
        "topic", "id", "guid", "title", F.col(arrival[0]).alias("date"), "link", "source", "score", "analyse"
    )
    advanced = I.advance_counters(counters, kept, "counter")
    rejected = x.filter(F.col("_p.reason").isNotNull()).withColumn("link", F.col("_feed_link")).select(items.columns)
    rejected = D.not_seen(rejected, new_seen, "guid")
    requests = x.select("guid", M.scoring_request(F.col("scoring_text")).alias("request"))
    return TickResult(stored, new_seen, advanced, quarantine, requests, rejected, unresolved, resolver_requests, first, linked)
