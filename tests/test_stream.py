import datetime as dt

import pytest
from pyspark.sql import functions as F

from quillstream.operators import ids as I
from quillstream.plans.streams_q import landed_responses
from quillstream.session import scratch_path
from quillstream.sources import feed as FD
from quillstream.streaming import ticks as TK
from quillstream.streaming.ticks import TickState
from tests.conftest import SMALL

T0 = dt.datetime(2024, 1, 1)
FEED = "topic string, lang string, country string, title string, link string, guid string, published timestamp, event_id long"


def feed_rows(spark, rows):
    """(guid, topic, minute) -> feed items."""
    full = [(t, "en", "US", f"title {g}", f"https://example.org/{g}", g, T0 + dt.timedelta(minutes=m), m) for g, t, m in rows]
    return spark.createDataFrame(full, FEED)


def answers(spark, scores):
    """{guid: answer text}; None stands for a failed call."""
    import json

    rows = [
        (g, 500 if a is None else 200, json.dumps({"choices": [{"message": {"role": "assistant", "content": a}}]}))
        for g, a in scores.items()
    ]
    return spark.createDataFrame(rows, "key string, status int, body string")


def good(score="3"):
    return f'{{"score":"{score}","analyse":"x"}}'


def state_of(st):
    """Items (with the batch that stored them) and counters."""
    items = sorted(map(tuple, st.read("items").select("topic", "id", "guid", "score", "batch_id").collect()))
    return items, sorted(map(tuple, st.counters_before(1 << 40).collect()))


def new_state(spark, topics=("A",), **options):
    st = TickState(spark, scratch_path(spark, "ticks"), **options)
    st.init_counters(spark.createDataFrame([(f"{t}-counter",) for t in topics], "name string"))
    return st


BATCHES = [[("g1", "A", 1), ("g2", "B", 2), ("g3", "A", 3)], [("g4", "A", 11), ("g1", "A", 12), ("g5", "B", 13)]]
SCORES = {"g1": good(), "g2": good("2"), "g3": good("1"), "g4": good("-1"), "g5": good()}


class Stop(Exception):
    pass


@pytest.fixture(scope="module")
def clean_end(spark):
    st = new_state(spark, ("A", "B"))
    for b, rows in enumerate(BATCHES):
        st.ingest(responses=answers(spark, {**SCORES, "g5": good("0")}))(feed_rows(spark, rows), b)
    return state_of(st)


@pytest.mark.parametrize("step", ["items", "seen", "waiting", "counters", "metrics"])
def test_a_stop_before_any_write_and_a_replay_with_other_answers(spark, monkeypatch, clean_end, step):
    """The second batch dies before it writes ``step``; its replay gets other
    answers.  The end is that of a run that saw only the last answers."""
    later = {**SCORES, "g5": good("0")}  # topic B has no item any more in the replay
    st = new_state(spark, ("A", "B"))
    st.ingest(responses=answers(spark, later))(feed_rows(spark, BATCHES[0]), 0)
    write = TickState.write

    def dying(self, table, batch_id, rows):
        if table == step:
            raise Stop
        write(self, table, batch_id, rows)

    with monkeypatch.context() as patch:
        patch.setattr(TickState, "write", dying)
        with pytest.raises(Stop):
            st.ingest(responses=answers(spark, SCORES))(feed_rows(spark, BATCHES[1]), 1)
    assert {b for *_, b in state_of(st)[0]} == {0}  # readers see finished batches only
    st.ingest(responses=answers(spark, later))(feed_rows(spark, BATCHES[1]), 1)
    items, counters = state_of(st)
    assert (items, counters) == clean_end
    assert len({(t, i) for t, i, *_ in items}) == len(items)


def test_a_topic_added_while_the_stream_runs(spark):
    st = new_state(spark, ("A",))
    st.ingest(responses=answers(spark, SCORES))(feed_rows(spark, [("g1", "A", 1)]), 0)
    st.init_counters(spark.createDataFrame([("B-counter",), ("A-counter",)], "name string"))
    st.ingest(responses=answers(spark, SCORES))(feed_rows(spark, [("g2", "B", 2), ("g3", "A", 3)]), 1)
    items, counters = state_of(st)
    assert [(t, i, g) for t, i, g, *_ in items] == [("A", 1, "g1"), ("A", 2, "g3"), ("B", 1, "g2")]
    assert counters == [("A-counter", 2), ("B-counter", 1)]


def test_rejected_items_are_tried_again_until_their_age(spark):
    st = new_state(spark, ("A",), retry_ticks=3)
    now = {"g1": None, "g2": "no json", "g3": good()}
    run = lambda b, rows: st.ingest(responses=lambda: answers(spark, now))(feed_rows(spark, rows), b)
    run(0, [("g1", "A", 1), ("g2", "A", 2), ("g3", "A", 3)])
    assert [g for _, _, g, *_ in state_of(st)[0]] == ["g3"]
    now["g1"] = good("4")  # the model is back
    run(1, [("g4", "A", 11)])  # g4 has no answer yet
    assert [(i, g) for _, i, g, *_ in state_of(st)[0]] == [(1, "g3"), (2, "g1")]
    assert {r["guid"]: r["tries"] for r in st.waiting_before(2).collect()} == {"g2": 2, "g4": 1}
    run(2, [("g5", "A", 21)])
    assert {r["guid"] for r in st.waiting_before(3).collect()} == {"g4", "g5"}
    assert [r["guid"] for r in st.read("given_up").collect()] == ["g2"]  # kept: it can be landed again
    now.update(g2=good(), g4=good())
    run(3, [])  # nothing new: waiting items are tried all the same
    assert [g for _, _, g, *_ in state_of(st)[0]] == ["g3", "g1", "g4"]


def test_side_tables_that_land_after_the_start_are_read(spark):
    root = scratch_path(spark, "late")
    pages, feed = f"{root}/pages", f"{root}/feed"
    spark.createDataFrame([("https://example.org/g1", "content one")], "url string, content string").write.parquet(pages)
    feed_rows(spark, [("g1", "A", 1)]).write.parquet(feed)
    st = new_state(spark, ("A",))
    read = lambda: spark.read.parquet(pages)
    scorer = lambda: (lambda texts: ['{"score":"' + str(len(t)) + '"}' for t in texts])
    for guid in ("g1", "g2"):
        if guid == "g2":
            spark.createDataFrame([("https://example.org/g2", "a longer content")], "url string, content string").write.mode("append").parquet(pages)
            feed_rows(spark, [("g2", "A", 11)]).write.mode("append").parquet(feed)
        TK.ingest_stream(spark, feed, feed_rows(spark, []).schema, st.root, page_content=read, make_scorer=scorer)
    scores = {g: int(s) for _, _, g, s, _ in state_of(st)[0]}
    assert scores["g2"] - scores["g1"] == len("a longer content") - len("content one")


def test_foreach_batch_replay_is_idempotent(spark):
    feed = FD.feed_items(spark, SMALL)
    state = TickState(spark, scratch_path(spark, "replay"), feed_schema=feed.schema)
    events = spark.read.parquet(f"{SMALL}/events.parquet")
    state.init_counters(events.select(I.counter_name(F.col("event_type")).alias("name")))
    process = state.ingest(responses=landed_responses(spark, SMALL))
    batch = feed.filter(F.col("published") < FD.ts_lit(feed, "published", FD.CUTOFF))
    process(batch, 0)
    first = sorted(map(tuple, state.read("items").select("topic", "id", "guid").collect()))
    process(batch, 0)  # replay of the finished batch
    again = sorted(map(tuple, state.read("items").select("topic", "id", "guid").collect()))
    assert first == again
    ids = {}
    for topic, i, _ in first:
        ids.setdefault(topic, []).append(i)
    for topic, v in ids.items():
        assert sorted(v) == list(range(1, len(v) + 1))


def test_empty_batch_is_noop(spark):
    feed = FD.feed_items(spark, SMALL)
    state = TickState(spark, scratch_path(spark, "empty"), feed_schema=feed.schema)
    state.ingest()(feed.filter(F.lit(False)), 0)
    assert state.read("items").count() == 0 and state.done() == -1


def test_periodic_trigger_starts_and_stops(spark):
    from quillstream.streaming.ticks import ingest_stream

    root = scratch_path(spark, "periodic")
    feed = FD.feed_items(spark, SMALL)
    feed.filter(F.lit(False)).write.parquet(f"{root}/landing")
    q = ingest_stream(spark, f"{root}/landing", feed.schema, f"{root}/state", hours=6)
    try:
        assert q.isActive
    finally:
        q.stop()
    assert not q.isActive and q.exception() is None


def test_two_streaming_ticks_equal_one_batch_tick(spark):
    from quillstream.plans.ingest import run_tick
    from quillstream.streaming.ticks import ingest_stream

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    names = events.select(I.counter_name(F.col("event_type")).alias("name")).distinct()
    feed = FD.feed_items(spark, SMALL).checkpoint(eager=True)
    responses = landed_responses(spark, SMALL)

    root = scratch_path(spark, "stream-vs-batch")
    state = TickState(spark, f"{root}/state", feed_schema=feed.schema)
    state.init_counters(names)
    cut = FD.ts_lit(feed, "published", FD.CUTOFF)
    for part in (F.col("published") < cut, F.col("published") >= cut):
        feed.filter(part).write.mode("append").parquet(f"{root}/landing")
        ingest_stream(spark, f"{root}/landing", feed.schema, f"{root}/state", responses=responses)
    streamed = sorted(map(tuple, state.read("items").select("topic", "id", "guid", "score").collect()))

    zero = names.select("name", F.lit(0).cast("long").alias("seq"))
    batch = run_tick(feed, spark.createDataFrame([], "guid string"), zero, responses=responses).items
    batched = sorted(map(tuple, batch.select("topic", "id", "guid", "score").collect()))
    assert streamed == batched and len(batched) > 0


def test_seen_keys_can_be_bounded(spark):
    st = new_state(spark, keep_seen=2)
    for b, rows in enumerate([[("g1", "A", 1)], [("g2", "A", 2)], [("g1", "A", 3)], [("g3", "A", 4)], [("g1", "A", 5)]]):
        st.ingest(responses=answers(spark, {**SCORES}))(feed_rows(spark, rows), b)
    assert [(b, g) for _, _, g, _, b in state_of(st)[0]] == [(0, "g1"), (1, "g2"), (3, "g3"), (4, "g1")]


def unresolved(guid):
    import base64

    payload = bytes.fromhex("081322") + bytes([9]) + b"AU_yqL" + guid.encode().ljust(3) + bytes.fromhex("D20100")
    return base64.urlsafe_b64encode(payload).decode().rstrip("=")


def test_unresolved_links_wait_for_the_resolver_and_then_go_on(spark):
    """g1's link is resolved in tick 2, g2's never: after two ticks it is
    stored with the aggregator link.  Both ask the resolver once a tick."""
    from quillstream.functions import links as L

    st = new_state(spark, hold_ticks=2)
    wrapped = lambda g: f"https://news.google.com/rss/articles/{unresolved(g)}?oc=5"
    rows = feed_rows(spark, [("g1", "A", 1), ("g2", "A", 2), ("g3", "A", 3)])
    rows = rows.withColumn("link", F.when(F.col("guid") == "g1", wrapped("g1")).when(F.col("guid") == "g2", wrapped("g2")).otherwise(F.col("link")))
    key = rows.filter("guid = 'g1'").select(L.unwrap_link(F.col("link"))["resolver_id"]).first()[0]
    landed = [("none", 500, "")]
    sources = {"responses": answers(spark, SCORES), "resolver_responses": lambda: spark.createDataFrame(landed, "key string, status int, body string")}
    st.ingest(**sources)(rows, 0)
    assert [g for _, _, g, *_ in state_of(st)[0]] == ["g3"]
    asked = {r["key"]: r["payload"] for r in st.read("resolver_requests").collect()}
    assert len(asked) == 2 and key in asked and asked[key].startswith("f.req=")
    body = L.RESOLVER_HEADER + "https://publisher.example/g1" + L.RESOLVER_FOOTER
    landed += [(key, 500, body), (key, 200, body), (key, 200, body)]
    st.ingest(**sources)(rows.limit(0), 1)
    st.ingest(**sources)(rows.limit(0), 2)
    links = {r["guid"]: (r["link"], r["source"], r["batch_id"]) for r in st.read("items").collect()}
    assert links["g1"] == ("https://publisher.example/g1", "publisher.example", 1)
    assert links["g2"] == (wrapped("g2"), "news.google.com", 2)
    assert st.waiting_before(3).count() == 0


def test_a_failed_tick_calls_the_model_only_for_what_has_no_answer(spark, monkeypatch, tmp_path):
    """Blocks of answers are landed before the next one is called; the tick
    dies in the third, and again before it ends."""
    from quillstream.operators import scoring as SC

    calls, broken = tmp_path / "calls", tmp_path / "broken"
    calls.mkdir()
    broken.touch()
    land = SC.land_responses
    monkeypatch.setattr("quillstream.plans.ingest.land_responses", lambda *a, **k: land(*a, **{**k, "block_rows": 4}))

    answer = good("2")  # executors cannot import this module

    def make_client():
        import json
        import uuid

        def call(request):
            text = json.loads(request)["messages"][1]["content"]
            if broken.exists() and len(list(calls.iterdir())) >= 9:
                raise RuntimeError("the executor is lost")
            (calls / f"{text.split()[-1]}-{uuid.uuid4().hex}").touch()
            return 200, json.dumps({"choices": [{"message": {"content": answer}}]})

        return call

    rows = feed_rows(spark, [(f"g{i}", "A", i) for i in range(20)])
    st = new_state(spark)
    process = st.ingest(make_client=make_client, concurrency=1)
    with pytest.raises(Exception, match="the executor is lost"):
        process(rows, 0)
    landed = spark.read.parquet(st.answers).count()
    assert 0 < landed < 20 and st.done() == -1
    broken.unlink()
    before = len(list(calls.iterdir()))
    with monkeypatch.context() as patch:
        patch.setattr(TickState, "finish", lambda *a, **k: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            process(rows, 0)
    assert len(list(calls.iterdir())) == before + 20 - landed
    process(rows, 0)  # every answer has landed: no call at all
    assert len(list(calls.iterdir())) == before + 20 - landed
    assert len(state_of(st)[0]) == 20


def test_failed_calls_are_called_again(spark):
    from quillstream.operators.scoring import land_responses

    path = scratch_path(spark, "landed")
    asked = spark.createDataFrame([("a", "ra"), ("a", "ra"), ("b", "rb")], "key string, request string")
    for status in (503, 200):
        found = land_responses(asked, path, lambda s=status: (lambda r: (s if r == "rb" else 200, f"{r} {s}")))
        got = {r["key"]: (r["status"], r["body"]) for r in found.collect()}
        assert got == {"a": (200, "ra 503"), "b": (status, f"rb {status}")}


def test_keys_stay_known_across_batches_and_restarts(spark):
    """Each part is a run of its own (a restart); a key that returns three
    batches later, with an older time, gives nothing."""
    from quillstream.streaming.dedupe import first_per_key_stream

    root = scratch_path(spark, "exact")
    schema = "k string, t long, v string"
    parts = [[("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z")], [("c", 1, "q")], [(None, 1, "null")], [("a", 0, "late"), ("d", 1, "n"), (None, 0, "again")]]
    sizes = []
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(schema).parquet(f"{root}/in")
        TK.run_available(spark, first_per_key_stream(stream, "k", ["t", "v"], keep="30 days"), f"{root}/c", path=f"{root}/out")
        sizes.append(spark.read.parquet(f"{root}/out").count())
    got = {(r["k"], r["v"]) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {("a", "y"), ("b", "z"), ("c", "q"), ("d", "n"), (None, "null")} and sizes == [2, 3, 4, 5]


def test_figures_and_late_rows_of_more_batches_than_progress_is_kept(spark):
    root = scratch_path(spark, "many")
    schema = "id long, ts timestamp"
    rows = spark.range(0, 240).selectExpr("id", "timestamp_seconds(1700000000 + CASE WHEN id % 50 = 49 THEN id - 200 ELSE id END * 60) AS ts")
    rows.repartitionByRange(12, "id").write.parquet(f"{root}/in")
    tables, sink = TK.batch_log(spark, f"{root}/log", schema, "ts", late_hours=1)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    files = len([f for f in spark.read.parquet(f"{root}/in").inputFiles()])
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "3")
    try:
        q = TK.run_available(spark, stream, f"{root}/c", sink=sink)
    finally:
        spark.conf.set(kept, before)
    assert len(q.recentProgress) < files
    figures = tables.read("metrics").collect()
    assert len(figures) == files > 8 and sum(r["collected"] for r in figures) == 240
    late = {r["id"] for r in tables.read("late").collect()}
    assert sum(r["late"] for r in figures) == len(late)
    # files are read in an order of their own: what is late follows from it
    newest, expected = None, 0
    for r in sorted(figures, key=lambda r: r["batch_id"]):
        newest = max(x for x in (newest, r["newest"]) if x)
        expected += r["late"]
    assert late and late <= set(range(240)) and expected == len(late)


def test_window_ticks_read_only_their_folders(spark):
    root = scratch_path(spark, "windows")
    rows = feed_rows(spark, [(f"g{h}", "A" if h % 3 else "B", 60 * h) for h in range(72)] + [("g5", "A", 60 * 40)])
    FD.land_feed(rows, f"{root}/landing")
    st = new_state(spark, ("A", "B"))
    scores = answers(spark, {f"g{h}": good() for h in range(72)})
    for tick, hours in enumerate((24, 36, 48)):  # windows of 24 hours that overlap by half
        st.window_tick(f"{root}/landing", T0 + dt.timedelta(hours=hours), 24, tick, topics=["A"], responses=scores)
    items, _ = state_of(st)
    stored = [(b, int(g[1:])) for _, _, g, _, b in items]
    assert stored == [(0 if h <= 24 else 1 if h <= 36 else 2, h) for h in range(49) if h % 3]
    scan = FD.window_scan(spark, f"{root}/landing", T0 + dt.timedelta(hours=24), 24, ["A"])
    plan = scan._sc._jvm.PythonSQLUtils.explainString(scan._jdf.queryExecution(), "formatted")
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert "hour" in filters and "topic" in filters


def test_a_quiet_feed_still_ticks(spark):
    """The timer works on waiting items although no file lands."""
    import time

    root = scratch_path(spark, "quiet")
    now = {"g1": None}
    feed_rows(spark, [("g1", "A", 1)]).coalesce(1).write.parquet(f"{root}/landing")
    st = new_state(spark)
    q = TK.ingest_stream(
        spark, f"{root}/landing", feed_rows(spark, []).schema, st.root, every="1 second", state=st, responses=lambda: answers(spark, now)
    )
    try:
        end = time.time() + 90
        while st.done() < 0 and time.time() < end:
            time.sleep(1)
        now["g1"] = good()
        while not state_of(st)[0] and time.time() < end:
            time.sleep(1)
    finally:
        q.stop()
    assert [g for _, _, g, *_ in state_of(st)[0]] == ["g1"]
