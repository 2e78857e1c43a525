import os
import random

import pytest
from pyspark.sql import functions as F

from quillstream.operators import dedupe as D
from quillstream.operators import ids as I
from quillstream.operators import merge as MG


def _skewed(spark, n=3000, seed=7):
    """One key holds a third of the rows."""
    rnd = random.Random(seed)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rnd.randrange(200)}", rnd.randrange(10_000)) for i in range(n)]
    return spark.createDataFrame(rows, "pos long, key string, t long"), rows


def test_ids_contiguous_unique_under_skew(spark):
    df, rows = _skewed(spark)
    df = df.withColumn("counter", F.concat(F.when(F.col("key") == "hot", "hot").otherwise("cold"), F.lit("-counter")))
    counters = spark.createDataFrame([("hot-counter", 10), ("cold-counter", 0)], "name string, seq long")
    out = I.allocate_ids(df, ["t", "pos"], "counter", counters, num_partitions=7).collect()
    for name, start in (("hot-counter", 10), ("cold-counter", 0)):
        mine = sorted((r["t"], r["pos"], r["id"]) for r in out if r["counter"] == name)
        assert [x[2] for x in mine] == list(range(start + 1, start + 1 + len(mine)))


def test_missing_counter_fails(spark):
    df = spark.createDataFrame([(1, "x-counter")], "t long, counter string")
    counters = spark.createDataFrame([("y-counter", 0)], "name string, seq long")
    with pytest.raises(Exception, match="missing counter"):
        I.allocate_ids(df, ["t"], "counter", counters).collect()


def test_first_per_key_under_skew(spark):
    df, rows = _skewed(spark)
    got = {r["key"]: r["pos"] for r in D.first_per_key(df, ["key"], ["t", "pos"]).collect()}
    want = {}
    for pos, key, t in sorted(rows, key=lambda r: (r[2], r[0])):
        want.setdefault(key, pos)
    assert got == want


def test_merge_update_delete_and_idempotent(spark):
    base = spark.createDataFrame([(1, "a", None), (2, "b", None), (3, "c", "x")], "id long, score string, analyse string")
    upd = spark.createDataFrame([(1, "4", "up"), (2, "0", "neutral")], "id long, score string, analyse string")
    once = MG.merge_updates(base, upd, "id", ["score", "analyse"], delete_neutral_col="score")
    twice = MG.merge_updates(once, upd, "id", ["score", "analyse"], delete_neutral_col="score")
    assert sorted(map(tuple, once.collect())) == [(1, "4", "up"), (3, "c", "x")]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_merge_rejects_duplicate_update_keys(spark):
    base = spark.createDataFrame([(1, "a")], "id long, score string")
    upd = spark.createDataFrame([(1, "4"), (1, "5")], "id long, score string")
    with pytest.raises(Exception, match="duplicate update key"):
        MG.merge_updates(base, upd, "id", ["score"]).collect()


def test_repair_links(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "http://x")], "id long, link string")
    got = sorted(map(tuple, MG.repair_links(df).collect()))
    assert got == [(1, "default_link"), (2, "default_link"), (3, "http://x")]


def test_merge_base_uniqueness_check(spark):
    base = spark.createDataFrame([(1, "a"), (1, "b")], "id long, score string")
    upd = spark.createDataFrame([(1, "4")], "id long, score string")
    with pytest.raises(ValueError, match="duplicate base key"):
        MG.merge_updates(base, upd, "id", ["score"], check_base_unique=True)


def test_tick_with_a_hot_guid(spark):
    import datetime as dt

    from quillstream.plans.ingest import run_tick

    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        guid = "hot" if hot else f"g{i}"
        rows.append(("news" if i % 2 else "tech", guid, "Hot story" if hot else f"t{i}",
                     "https://a.example/hot" if hot else f"https://a.example/{i}",
                     base + dt.timedelta(minutes=(3000 - i)), i))
    feed = spark.createDataFrame(rows, "topic string, guid string, title string, link string, published timestamp, event_id long")
    counters = spark.createDataFrame([("news-counter", 100), ("tech-counter", 0)], "name string, seq long")
    res = run_tick(feed, spark.createDataFrame([], "guid string"), counters)
    out = res.items.collect()
    guids = [r["guid"] for r in out]
    assert len(guids) == len(set(guids))
    hot_rows = [r for r in rows if r[1] == "hot"]
    first_hot = min(hot_rows, key=lambda r: (r[4], r[5]))
    stored_hot = [r for r in out if r["guid"] == "hot"]
    # the hot item is either stored once (at its first arrival) or dropped as neutral
    assert len(stored_hot) <= 1
    if stored_hot:
        assert stored_hot[0]["date"] == first_hot[4] and stored_hot[0]["topic"] == first_hot[0]
    for topic, start in (("news", 100), ("tech", 0)):
        ids = sorted(r["id"] for r in out if r["topic"] == topic)
        assert ids == list(range(start + 1, start + 1 + len(ids)))
        by_arrival = [r["id"] for r in sorted((r for r in out if r["topic"] == topic), key=lambda r: r["date"])]
        assert by_arrival == ids


def test_a_stored_merge_touches_only_the_buckets_it_hits(spark):
    from quillstream.session import scratch_path

    path, schema = scratch_path(spark, "bucketed"), "id long, title string, score string, analyse string"
    rows = [(i, f"t{i}", None if i % 7 == 0 else "1", None if i % 7 == 0 else "x") for i in range(200)]
    MG.write_bucketed(spark.createDataFrame(rows, schema), path, "id", 40)
    before = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("bucket=")}
    upd = spark.createDataFrame([(0, "4", "up"), (7, "0", "neutral"), (999, "1", "nobody")], "id long, score string, analyse string")
    hit = MG.merge_into(spark, path, upd, "id", ["score", "analyse"], 40, delete_neutral_col="score")
    after = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("bucket=")}
    assert {d for d in before if before[d] != after[d]} == {f"bucket={b}" for b in hit} and len(hit) <= 3 and len(before) == 40
    got = {r["id"]: (r["score"], r["analyse"]) for r in MG.read_bucketed(spark, path, "id").collect()}
    want = {i: (s, a) for i, _, s, a in rows if i != 7} | {0: ("4", "up")}
    assert got == want
    assert MG.merge_into(spark, path, upd, "id", ["score", "analyse"], 40, delete_neutral_col="score") == hit  # again: the same
    assert {r["id"]: (r["score"], r["analyse"]) for r in MG.read_bucketed(spark, path, "id").collect()} == want
    plan = MG.read_bucketed(spark, path, "id", hit)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan


def test_a_bucket_that_loses_its_last_row_and_double_keys(spark):
    from quillstream.session import scratch_path

    schema = "id long, score string"
    path = scratch_path(spark, "bucketed")
    MG.write_bucketed(spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], schema), path, "id", 1000)
    MG.merge_into(spark, path, spark.createDataFrame([(1, "0")], schema), "id", ["score"], 1000, delete_neutral_col="score")
    assert [tuple(r)[:2] for r in MG.read_bucketed(spark, path, "id").collect()] == [(2, "b")]
    assert MG.merge_into(spark, path, spark.createDataFrame([], schema), "id", ["score"], 1000) == []
    twice = scratch_path(spark, "twice")
    MG.write_bucketed(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], schema), twice, "id", 8)
    with pytest.raises(ValueError, match="duplicate base key"):
        MG.merge_into(spark, twice, spark.createDataFrame([(1, "x")], schema), "id", ["score"], 8)
    with pytest.raises(Exception, match="duplicate update key"):
        MG.merge_into(spark, path, spark.createDataFrame([(2, "x"), (2, "y")], schema), "id", ["score"], 1000)


def test_backfill_resumes_and_leaves_what_does_not_parse(spark):
    from quillstream.plans.backfill import run_backfill
    from quillstream.session import scratch_path

    path, landed = scratch_path(spark, "items"), scratch_path(spark, "answers")
    rows = [(i, f"title {i}", f"https://a.example/{i}", None, None, "T" if i < 6 else "U") for i in range(8)]
    MG.write_bucketed(spark.createDataFrame(rows, "id long, title string, link string, score string, analyse string, topic string"), path, "id", 4)
    pages = spark.createDataFrame([("https://a.example/1", "<body><p>The content of page one.</p></body>")], "url string, html string")

    def scorer():
        return lambda texts: ["no json" if t == "title 2" else '{"score":"0"}' if t == "title 3" else '{"score":"%d","analyse":"a"}' % len(t) for t in texts]

    run_backfill(spark, path, "id", 4, pages, make_scorer=scorer, answers_path=landed, only=F.col("topic") == "T")
    got = {r["id"]: (r["score"], r["analyse"]) for r in MG.read_bucketed(spark, path, "id").collect()}
    content = len("Title:title 1\nContent:The content of page one.")
    assert got == {0: ("7", "a"), 1: (str(content), "a"), 2: (None, None), 4: ("7", "a"), 5: ("7", "a"), 6: (None, None), 7: (None, None)}


def test_backfill_of_items_that_share_a_link(spark):
    from quillstream.plans.backfill import run_backfill
    from quillstream.session import scratch_path

    schema = "id long, title string, link string, score string, analyse string"
    body = "<body><p>The content {} of the page.</p></body>".format
    rows = [(1, "t", "https://a.example/x"), (2, "t", "https://a.example/x"), (3, "t", "https://a.example/y"), (4, "t", None)]
    pages = [(1, rows[0][2], body("one")), (2, rows[0][2], body("is number two")), (5, rows[2][2], body("five")), (4, None, body("four"))]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    text = lambda words: f"Title:t\nContent:The content {words} of the page."
    # the item's own page; without keys one of the pages at the link
    for page_key, content in (("page_id", {1: text("one"), 2: text("is number two"), 3: "t"}), (None, dict.fromkeys((1, 2), text("is number two")) | {3: text("five")})):
        asked = scratch_path(spark, "answers")
        path = scratch_path(spark, "items")
        MG.write_bucketed(spark.createDataFrame([(*r, None, None) for r in rows], schema), path, "id", 4)
        scorer = lambda: lambda texts: ['{"score":"%d","analyse":"a"}' % len(t) for t in texts]
        run_backfill(spark, path, "id", 4, pages, make_scorer=scorer, page_key=page_key, answers_path=asked)
        got = {r["id"]: r["score"] for r in MG.read_bucketed(spark, path, "id").collect()}
        assert got == {k: str(len(v)) for k, v in (content | {4: "t"}).items()}
        assert spark.read.parquet(asked).count() == len({*content.values(), "t"})  # one call a text
