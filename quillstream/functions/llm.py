"""Model request/response tables as column expressions.

Requests and responses are *data*: a fetcher outside Spark (or the
``operators.scoring`` mapInPandas client) turns request rows into response
rows; everything around that call is a column expression.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstream.functions import columns, jsonscan

# Fixed values (must match the source system's behaviour):
#   scoring model             deepseek-chat
#   response format           {"type": "json_object"}
#   stream                    false
#   transport/envelope error  "0"  (the no-result answer)
#   score answer              JSON object {"score": <string>, "analyse": <string>}
#   neutral score             "0"
SCORING_MODEL = "deepseek-chat"
RESPONSE_FORMAT = {"type": "json_object"}
NO_RESULT = "0"
NEUTRAL_SCORE = "0"


def scoring_prompt(topic: str = "the subject of the title", low: int = -5, high: int = 5, words: int = 100) -> str:
    """System prompt of a scoring request: what to judge, on which scale, and
    the two string fields that the answer parser reads."""
    return (
        f"You rate news items. Judge how good or bad the item is for {topic} as a whole number from {low} (very bad) "
        f"to {high} (very good); 0 means no effect either way. If the content does not belong to the title, go by the "
        f"title alone. Reply with one JSON object and nothing else. It has two fields, both strings: "
        f'"score", the number, and "analyse", your reasons in at most {words} words.'
    )


def message(role: Column | str, content: Column) -> Column:
    r = F.lit(role) if isinstance(role, str) else role
    return F.struct(r.alias("role"), content.alias("content"))


@columns(1)
def chat_request(messages: Column, model: str = SCORING_MODEL, json_answer: bool = True) -> Column:
    """Request JSON for a chat completion."""
    fmt = F.create_map(*[x for k, v in RESPONSE_FORMAT.items() for x in (F.lit(k), F.lit(v))])
    fields = [F.lit(model).alias("model"), messages.alias("messages"), F.lit(False).alias("stream")]
    if json_answer:
        fields.append(fmt.alias("response_format"))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


@columns(1)
def scoring_request(text: Column, prompt: str | None = None) -> Column:
    """E1 for one item: a system prompt plus the item text."""
    return chat_request(F.array(message("system", F.lit(prompt or scoring_prompt())), message("user", text)))


@columns(3)
def ordered_messages(turn: Column, role: Column, content: Column) -> Column:
    """A5 aggregate: messages of one conversation in turn order."""
    ordered = F.array_sort(F.collect_list(F.struct(turn.alias("t"), role.alias("role"), content.alias("content"))))
    return F.transform(ordered, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))


#: Fields of the response envelope.  The all-choices decoder has
#: no ``finish_reason`` field.
CHOICE = {"index": int, "message": {"role": str, "content": str}}
USAGE_FIELDS = ("prompt_tokens", "completion_tokens", "total_tokens")
ENVELOPE = {
    "id": str, "object": str, "created": int, "model": str, "choices": [CHOICE], "usage": dict.fromkeys(USAGE_FIELDS, int),
}
FIRST_ENVELOPE = ENVELOPE | {"choices": [CHOICE | {"finish_reason": str}]}

DECODED = "first string, every string, " + ", ".join(f"{f} long" for f in USAGE_FIELDS)


def _contents(kind: dict, value) -> tuple[list[str] | None, dict]:
    """(contents of the choices, usage) of a parsed envelope; None if it does
    not decode."""
    try:
        found = jsonscan.fill(kind, value)
    except jsonscan.Wrong:
        return None, {}
    choices = found.get("choices") or []
    return [c.get("message", {}).get("content") or "" for c in choices], found.get("usage") or {}


def _decode(body: str | None) -> dict:
    out: dict = {}
    try:
        value = jsonscan.parse(body or "")
    except ValueError:
        return out
    contents, usage = _contents(FIRST_ENVELOPE, value)
    out["first"] = contents[0] if contents else None
    contents, other = _contents(ENVELOPE, value)
    out["every"] = None if contents is None else "".join(contents)
    return out | {k: v for k, v in (usage or other).items()}


@columns(1)
def decode_response(body: Column) -> Column:
    """Struct of a response envelope: ``first`` choice's content (null when
    it does not decode or has no choice), ``every`` choice's contents joined
    (null when it does not decode) and the usage counts.  Types are strict:
    a wrong one anywhere is a decode error; keys match in any case."""
    fields = [f.split()[0] for f in DECODED.split(", ")]

    def run(bodies: pd.Series) -> pd.DataFrame:
        rows = [_decode(b if isinstance(b, str) else None) for b in bodies]
        return pd.DataFrame({f: pd.array([r.get(f) for r in rows], dtype="Int64" if f in USAGE_FIELDS else object) for f in fields})

    return F.pandas_udf(run, DECODED)(body)


@columns(2)
def first_choice_content(status: Column, body: Column) -> Column:
    """E2a + E5: content of the first choice; "0" on non-200, undecodable
    body (bad JSON or wrong types) or no choices."""
    return F.coalesce(F.when(status == 200, decode_response(body)["first"]), F.lit(NO_RESULT))


@columns(2)
def all_choices_content(status: Column, body: Column) -> Column:
    """E2b + A4: concatenation of every choice's content in order; "0" on
    non-200 or undecodable body, "" when there are no choices."""
    return F.coalesce(F.when(status == 200, decode_response(body)["every"]), F.lit(NO_RESULT))


@columns(1)
def token_usage(body: Column) -> list[Column]:
    """Prompt, completion and total tokens of a response."""
    found = decode_response(body)
    return [found[field].alias(field) for field in USAGE_FIELDS]


ANSWER_FIELDS = ("score", "analyse")


def _answer(text: str | None) -> tuple[str | None, str | None, str | None]:
    """(score, analyse, reason) of a model answer."""
    try:
        value = jsonscan.parse(text or "")
    except ValueError:
        return None, None, "invalid_json"
    if value is not None and type(value) is not jsonscan.Pairs:
        return None, None, "not_object"
    found = {}
    for field in ANSWER_FIELDS:
        try:
            found[field] = jsonscan.fill({field: str}, value).get(field) or ""
        except jsonscan.Wrong:
            return None, None, f"{field}_type"
    return found["score"], found["analyse"], None


@columns(1)
def strict_answer(answer: Column) -> Column:
    """E4 (contract C5): struct(score, analyse, reason).

    Accepted when the whole answer is JSON ``null`` (both fields empty) or an
    object whose ``score`` and ``analyse`` keys (matched in any case, repeated
    ones in document order: the last that is not null wins) each hold a
    string or null under every match.  Anything else is rejected with a
    reason; rejected rows have score/analyse NULL."""

    def run(answers: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_answer(a if isinstance(a, str) else None) for a in answers], columns=["score", "analyse", "reason"], dtype=object)

    return F.pandas_udf(run, "score string, analyse string, reason string")(answer)


@columns(1)
def is_neutral(score: Column) -> Column:
    """Exact string equality with "0" ("-0", "0.0" and "" pass)."""
    return score.eqNullSafe(F.lit(NEUTRAL_SCORE))
