from pyspark.sql import functions as F

from quillstream.functions import llm as M
from quillstream.plans.llm_q import ANSWER_CASES


def test_strict_answer_contract(spark):
    df = spark.createDataFrame([c[:2] for c in ANSWER_CASES], "id long, a string")
    got = {r["id"]: tuple(r["p"]) for r in df.select("id", M.strict_answer(F.col("a")).alias("p")).collect()}
    for c in ANSWER_CASES:
        assert got[c[0]] == (c[2], c[3], c[4]), c


def test_neutral_gate_is_exact(spark):
    df = spark.createDataFrame([("0",), ("-0",), ("0.0",), ("",), (None,)], "s string")
    got = [r["n"] for r in df.select(M.is_neutral(F.col("s")).alias("n")).collect()]
    assert got == [True, False, False, False, False]


def test_response_first_and_all(spark):
    two = '{"choices":[{"index":0,"message":{"role":"assistant","content":"a"}},' \
          '{"index":1,"message":{"role":"assistant","content":"b"}}],"usage":{"total_tokens":3}}'
    none = '{"choices":[]}'
    rows = [
        (200, two), (200, none), (500, two), (200, "not json"),
        (200, '{"choices":"x"}'),                                   # wrong type -> decode error
        (200, '{"choices":[{"message":{"content":4}}]}'),           # numeric content -> error
        (200, "null"),                                              # decodes to an empty envelope
        (200, '{"created":1.5,"choices":[{"message":{"content":"z"}}]}'),
        (200, '{"choices":[{"message":{"content":"q"}}],"usage":{"total_tokens":"7"}}'),
        (200, '{"choices":null}'),
        (200, "[1]"),
    ]
    df = spark.createDataFrame(rows, "status int, body string")
    got = [(r["f"], r["a"]) for r in df.select(
        M.first_choice_content(F.col("status"), F.col("body")).alias("f"),
        M.all_choices_content(F.col("status"), F.col("body")).alias("a"),
    ).collect()]
    assert got == [("a", "ab"), ("0", ""), ("0", "0"), ("0", "0"), ("0", "0"), ("0", "0"), ("0", ""),
                   ("0", "0"), ("0", "0"), ("0", ""), ("0", "0")]


def test_scoring_request_shape(spark):
    import json

    df = spark.createDataFrame([("hello",)], "t string")
    req = json.loads(df.select(M.scoring_request(F.col("t")).alias("r")).first()["r"])
    assert req["model"] == M.SCORING_MODEL and req["stream"] is False
    assert req["response_format"] == {"type": "json_object"}
    assert [m["role"] for m in req["messages"]] == ["system", "user"]
    assert req["messages"][1]["content"] == "hello"


def test_fetch_responses_feeds_the_spark_parsers(spark):
    import json

    from quillstream.operators.scoring import fetch_responses

    def make_client():
        def call(request_json):
            text = json.loads(request_json)["messages"][1]["content"]
            if text == "down":
                return 503, "unavailable"
            answer = json.dumps({"score": str(len(text) % 3 - 1), "analyse": "ok"})
            return 200, json.dumps({"choices": [{"index": 0, "message": {"role": "assistant", "content": answer}}]})
        return call

    items = spark.createDataFrame([("g1", "aaaa"), ("g2", "down"), ("g3", "abc")], "guid string, text string")
    reqs = items.select("guid", M.scoring_request(F.col("text")).alias("request"))
    resp = fetch_responses(reqs, "guid", "request", make_client, concurrency=2)
    parsed = resp.select("key", M.strict_answer(M.first_choice_content(F.col("status"), F.col("body"))).alias("p"))
    got = {r["key"]: (r["p"]["score"], r["p"]["reason"]) for r in parsed.collect()}
    assert got == {"g1": ("0", None), "g2": (None, "not_object"), "g3": ("-1", None)}


def test_tick_with_a_chat_client(spark):
    import json

    from quillstream.plans.ingest import run_tick
    from quillstream.sources import feed as FD
    from tests.conftest import SMALL

    def make_client():
        def call(request_json):
            text = json.loads(request_json)["messages"][1]["content"]
            answer = json.dumps({"score": "2", "analyse": str(len(text))})
            return 200, json.dumps({"choices": [{"message": {"role": "assistant", "content": answer}}]})
        return call

    feed = FD.feed_items(spark, SMALL)
    counters = FD.counters_table(spark, SMALL)
    batch = feed.filter(F.col("published") >= FD.ts_lit(feed, "published", FD.CUTOFF))
    res = run_tick(batch, spark.createDataFrame([], "guid string"), counters, make_client=make_client, concurrency=3)
    rows = res.items.collect()
    assert rows and all(r["score"] == "2" for r in rows)
    assert len({r["guid"] for r in rows}) == len(rows)


def test_repeated_keys_in_envelopes_and_answers(spark):
    rows = [
        '{"choices":[{"message":{"content":"x","content":"y"}}]}',
        '{"choices":[{"message":{"content":"x"},"message":{"role":"r"}}]}',
        '{"choices":[{"message":{"content":"x","content":null}}]}',
        '{"choices":[{"message":{"content":1,"content":"x"}}]}',
        '{"choices":[{"message":{"content":"x"}}],"choices":null}',
        '{"created":10000000000000000000000,"choices":[]}',
        '{"choices":[null,{"message":null}]}',
    ]
    df = spark.createDataFrame([(200, r) for r in rows], "status int, body string")
    got = df.select(
        M.first_choice_content(F.col("status"), F.col("body")).alias("f"), M.all_choices_content(F.col("status"), F.col("body")).alias("a")
    ).collect()
    assert [(r["f"], r["a"]) for r in got] == [("y", "y"), ("x", "x"), ("x", "x"), ("0", "0"), ("0", ""), ("0", "0"), ("", "")]


def test_deep_and_null_answers(spark):
    df = spark.createDataFrame([("[" * 100_000,), (None,), ('{"score":"1","a":' + "[" * 50 + "]" * 50 + "}",)], "a string")
    got = [tuple(r["p"]) for r in df.select(M.strict_answer(F.col("a")).alias("p")).collect()]
    assert got == [(None, None, "invalid_json"), (None, None, "invalid_json"), ("1", "", None)]


def test_usage_fields(spark):
    body = '{"choices":[],"Usage":{"prompt_tokens":3,"completion_tokens":4,"total_tokens":7}}'
    df = spark.createDataFrame([(body,), ('{"usage":{"total_tokens":null}}',), ("no",)], "b string")
    assert [tuple(r) for r in df.select(*M.token_usage(F.col("b"))).collect()] == [(3, 4, 7), (None,) * 3, (None,) * 3]


def test_envelope_keys_in_any_case_and_finish_reason_by_decoder(spark):
    rows = [
        '{"Choices":[{"Message":{"CONTENT":"x"}}]}',
        '{"choices":[{"message":{"content":"x"},"finish_reason":3}]}',
        '{"choices":[{"message":{"content":"say \\"Role\\": no"}}]}',
    ]
    df = spark.createDataFrame([(200, r) for r in rows], "status int, body string")
    got = df.select(
        M.first_choice_content(F.col("status"), F.col("body")).alias("f"), M.all_choices_content(F.col("status"), F.col("body")).alias("a")
    ).collect()
    assert [(r["f"], r["a"]) for r in got] == [("x", "x"), ("0", "x"), ('say "Role": no', 'say "Role": no')]


def test_the_prompt_names_topic_and_scale():
    text = M.scoring_prompt("Acme", -3, 3, 50)
    assert "Acme" in text and "-3" in text and "50 words" in text


def test_scorer_gets_few_texts_at_a_time(spark):
    from quillstream.operators import scoring as SC

    rows = [(None if i % 3 == 0 else (1 << 60) + i, None if i == 5 else "x" * i) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, text string").coalesce(1)
    most = SC.SLICE_ROWS

    def make():
        def scorer(texts):
            assert len(texts) <= most
            return ["0" if t is None else str(len(t)) for t in texts]

        return scorer

    got = [tuple(r) for r in SC.score_rows(df, "text", make).collect()]
    assert got == [(i, t, "0" if t is None else str(len(t))) for i, t in rows]


def test_backfill_merge_parses_each_answer_once(spark, tmp_path):
    from quillstream.plans.mutations_q import backfill_merge

    docs = [(1, "a" * 16), (2, "a" * 9), (3, None), (4, "d")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(4, 3, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = backfill_merge(spark, str(tmp_path))
    assert {tuple(r) for r in out.collect()} == {(2, "4", "9 characters"), (3, None, None), (4, "2", "quality=3 toxic=1")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "MapInArrow" not in plan
