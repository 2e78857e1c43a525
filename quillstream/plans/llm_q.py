"""Queries for model requests, responses and score answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstream.functions import llm as M
from quillstream.operators.scoring import score_rows
from quillstream.plans.catalog import register
from quillstream.plans.sqlfrag import lit
from quillstream.sources import fixtures as FX
from quillstream.sources.tables import read_table

# ------------------------------------------------------------------ E1 / A5

_REQ_SQL = f"""
SELECT conv_id, count(*)::BIGINT AS n_messages,
       to_json(struct_pack(model := {lit(M.SCORING_MODEL)},
                           messages := list(struct_pack(role := role, content := text) ORDER BY turn),
                           stream := false,
                           response_format := MAP {{'type': 'json_object'}}))::VARCHAR AS request
FROM conversations GROUP BY conv_id
"""


@register("chat_requests", _REQ_SQL)
def chat_requests(spark, sf_dir):
    conv = read_table(spark, sf_dir, "conversations")
    g = conv.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_messages"),
        M.ordered_messages(F.col("turn"), F.col("role"), F.col("text")).alias("messages"),
    )
    return g.select("conv_id", "n_messages", M.chat_request(F.col("messages")).alias("request"))


# ------------------------------------------------------------------ responses


def response_bodies(spark, sf_dir):
    """Landed responses derived from conversations: assistant turns become
    the choices in turn order; conversations carrying a system turn were
    answered with HTTP 500."""
    conv = read_table(spark, sf_dir, "conversations")
    g = conv.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.when(F.col("role") == "assistant", F.struct(F.col("turn"), F.col("text"))))
        ).alias("answers"),
        F.sum(F.when(F.col("role") != "assistant", F.octet_length("text"))).alias("prompt_tokens"),
        F.sum(F.when(F.col("role") == "assistant", F.octet_length("text"))).alias("completion_tokens"),
        F.max(F.col("role") == "system").alias("has_system"),
    )
    choices = F.transform(
        F.col("answers"),
        lambda a, i: F.struct(
            i.alias("index"),
            F.struct(F.lit("assistant").alias("role"), a["text"].alias("content")).alias("message"),
            F.lit("stop").alias("finish_reason"),
        ),
    )
    pt = F.coalesce(F.col("prompt_tokens"), F.lit(0)).cast("int")
    ct = F.coalesce(F.col("completion_tokens"), F.lit(0)).cast("int")
    body = F.to_json(
        F.struct(
            F.concat(F.lit("cmpl-"), F.col("conv_id")).alias("id"),
            F.lit("chat.completion").alias("object"),
            F.lit(1700000000).cast("long").alias("created"),
            F.lit(M.SCORING_MODEL).alias("model"),
            choices.alias("choices"),
            F.struct(pt.alias("prompt_tokens"), ct.alias("completion_tokens"), (pt + ct).alias("total_tokens")).alias("usage"),
        )
    )
    status = F.when(F.col("has_system"), F.lit(500)).otherwise(F.lit(200))
    return g.select("conv_id", status.alias("status"), body.alias("body"))


_RESP_BASE = """
WITH c AS (
  SELECT conv_id,
         bool_or(role = 'system') AS has_system,
         list(text ORDER BY turn) FILTER (WHERE role = 'assistant') AS answers,
         coalesce(sum(strlen(text)) FILTER (WHERE role <> 'assistant'), 0)::BIGINT AS prompt_tokens,
         coalesce(sum(strlen(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS completion_tokens
  FROM conversations GROUP BY conv_id)
"""


@register(
    "response_parse_first",
    _RESP_BASE
    + """SELECT conv_id,
       CASE WHEN has_system OR coalesce(len(answers), 0) = 0 THEN '0' ELSE answers[1] END AS content,
       prompt_tokens, completion_tokens, prompt_tokens + completion_tokens AS total_tokens FROM c""",
)
def response_parse_first(spark, sf_dir):
    r = response_bodies(spark, sf_dir)
    return r.select(
        "conv_id",
        M.first_choice_content(F.col("status"), F.col("body")).alias("content"),
        *M.token_usage(F.col("body")),
    )


@register(
    "response_parse_all",
    _RESP_BASE
    + """SELECT conv_id,
       CASE WHEN has_system THEN '0' ELSE coalesce(array_to_string(answers, ''), '') END AS content,
       prompt_tokens, completion_tokens, prompt_tokens + completion_tokens AS total_tokens FROM c""",
)
def response_parse_all(spark, sf_dir):
    r = response_bodies(spark, sf_dir)
    return r.select(
        "conv_id",
        M.all_choices_content(F.col("status"), F.col("body")).alias("content"),
        *M.token_usage(F.col("body")),
    )


# ------------------------------------------------------------------ E4 / P4 / P5

# (doc_id, answer, expected score, expected analyse, expected reason)
ANSWER_CASES = [
    (-1, '{"score":"4","analyse":"ok"}', "4", "ok", None),
    (-2, '{"score":4,"analyse":"x"}', None, None, "score_type"),
    (-3, '{"Score":"4","ANALYSE":"y"}', "4", "y", None),
    (-4, '{"score":null,"analyse":"z"}', "", "z", None),
    (-5, "{}", "", "", None),
    (-6, "null", "", "", None),
    (-7, "[]", None, None, "not_object"),
    (-8, "0", None, None, "not_object"),
    (-9, '```json\n{"score":"1","analyse":"f"}\n```', None, None, "invalid_json"),
    (-10, '"0"', None, None, "not_object"),
    (-11, '{"score":"-0","analyse":""}', "-0", "", None),
    (-12, "", None, None, "invalid_json"),
    (-13, '{"score":"0","analyse":"neutral"}', "0", "neutral", None),
    (-14, '{"score":"2","analyse":{"a":1}}', None, None, "analyse_type"),
    (-15, '{"score":"1","analyse":"a","extra":[1,2]}', "1", "a", None),
    (-16, '""', None, None, "not_object"),
    (-17, '{"Score":"1","score":"2","analyse":"case"}', "2", "case", None),
    (-18, '{"score":"2","Score":"1","analyse":"case"}', "1", "case", None),
    (-19, '{"SCORE":3,"score":"3","analyse":"t"}', None, None, "score_type"),
    (-20, '{"score":"4","analyse":"ok"} This news is good', None, None, "invalid_json"),
    (-21, "null trailing", None, None, "invalid_json"),
    (-22, '{"score":"4"}{"score":"5"}', None, None, "invalid_json"),
    (-23, '{"score":"4"},{"score":"5"}', None, None, "invalid_json"),
    (-24, '{"score":"4"}] [2', None, None, "invalid_json"),
    (-25, '{"score":"4"}} {', None, None, "invalid_json"),
    (-26, ' {"score":"4","analyse":"ws"} \n', "4", "ws", None),
    (-27, '{"score":"2","Score":null,"analyse":"later null"}', "2", "later null", None),
    (-28, '{"score":"1","score":"2","analyse":"twice"}', "2", "twice", None),
    (-29, '{"score":"1","score":null,"analyse":"null last"}', "1", "null last", None),
    (-30, '{"score":5,"score":"1","analyse":"type first"}', None, None, "score_type"),
    (-31, '{"analyse":["x"],"score":"1","analyse":"y"}', None, None, "analyse_type"),
    (-32, '{"score":"1","analyse":"a","extra":NaN}', None, None, "invalid_json"),
    (-33, '{"score":"\\u0031","analyse":"a \\"quoted\\" part, {\\"score\\":\\"9\\"}"}', "1", 'a "quoted" part, {"score":"9"}', None),
    (-34, '{"extra":{"score":5},"score":"3"}', "3", "", None),
    (-35, '{"score":"3",}', None, None, "invalid_json"),
]


def score_answers(spark, sf_dir):
    """Model answers landed for labelled documents (score = quality - toxic)
    plus the inline edge cases.  A 0/1 label stands for a model that
    answered the score as a JSON number, which the strict contract rejects."""
    labels = read_table(spark, sf_dir, "labels")
    analyse = F.concat(F.lit("quality="), F.col("quality"), F.lit(" toxic="), F.col("toxic")).alias("analyse")
    diff = F.col("quality") - F.col("toxic")
    numeric = (F.col("quality") == 0) & (F.col("toxic") == 1)
    answer = F.when(numeric, F.to_json(F.struct(diff.alias("score"), analyse))).otherwise(
        F.to_json(F.struct(diff.cast("string").alias("score"), analyse))
    )
    derived = labels.select("doc_id", answer.alias("answer"))
    inline = spark.createDataFrame([c[:2] for c in ANSWER_CASES], "doc_id long, answer string")
    return derived.unionByName(inline)


def parsed_answers(spark, sf_dir):
    a = score_answers(spark, sf_dir)
    return a.select("doc_id", M.strict_answer(F.col("answer")).alias("p"))


_LABEL_SQL = (
    "SELECT doc_id, (quality - toxic)::VARCHAR AS score, "
    '\'quality=\' || quality || \' toxic=\' || toxic AS "analyse" FROM labels '
    "WHERE NOT (quality = 0 AND toxic = 1)"
)
_ACCEPTED = [(c[0], c[2], c[3]) for c in ANSWER_CASES if c[4] is None]
_REJECTED = [(c[0], c[4]) for c in ANSWER_CASES if c[4] is not None]
_ACCEPTED_SQL = f"{_LABEL_SQL} UNION ALL SELECT * FROM {FX.sql_values(_ACCEPTED, ['doc_id', 'score', 'analyse'])}"


@register("score_parse_strict", _ACCEPTED_SQL)
def score_parse_strict(spark, sf_dir):
    p = parsed_answers(spark, sf_dir)
    return p.filter(F.col("p.reason").isNull()).select("doc_id", F.col("p.score").alias("score"), F.col("p.analyse").alias("analyse"))


@register(
    "score_quarantine",
    "SELECT doc_id, 'score_type' AS reason FROM labels WHERE quality = 0 AND toxic = 1 UNION ALL "
    f"SELECT doc_id::BIGINT AS doc_id, reason FROM {FX.sql_values(_REJECTED, ['doc_id', 'reason'])}",
)
def score_quarantine(spark, sf_dir):
    p = parsed_answers(spark, sf_dir)
    return p.filter(F.col("p.reason").isNotNull()).select("doc_id", F.col("p.reason").alias("reason"))


@register("score_gate", f"SELECT doc_id, score FROM ({_ACCEPTED_SQL}) WHERE score <> '0'")
def score_gate(spark, sf_dir):
    p = parsed_answers(spark, sf_dir)
    ok = p.filter(F.col("p.reason").isNull())
    return ok.filter(~M.is_neutral(F.col("p.score"))).select("doc_id", F.col("p.score").alias("score"))


# ------------------------------------------------------------------ E3


@register(
    "score_items",
    "SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE ((length(text) % 11) - 5)::VARCHAR END AS score "
    "FROM documents",
)
def score_items(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    answers = score_rows(docs, "text")
    p = answers.select("doc_id", M.strict_answer(F.col("answer")).alias("p"))
    return p.select("doc_id", F.col("p.score").alias("score"))
