"""Score rows with a model client, batched through ``mapInArrow``.

The model call is the only step that leaves the JVM.  The client is a
parameter: ``scorer(texts: list[str]) -> list[str]`` returns one raw answer
per text (the model's message content, or "0" on any transport failure).
One client instance is built per partition (``make_scorer`` is called on
the executor), so connection setup is amortised over a whole Arrow batch
stream.  Concurrency against the model endpoint is bounded by the number of
partitions: pass ``concurrency`` to repartition before the call.  Catalyst
cannot move filters across the Python boundary, so callers filter (seen
keys, already-scored rows) *before* calling :func:`score_rows`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillstream.session import read_or_empty, scratch_path

Scorer = Callable[[list], list]

#: Texts handed to a scorer at a time.
SLICE_ROWS = 256


def standin_scorer(texts: list) -> list:
    """Deterministic offline stand-in for the model: score is
    (number of characters mod 11) - 5, i.e. an integer in -5..5."""
    out = []
    for t in texts:
        if t is None:
            out.append("0")
            continue
        n = len(t)
        out.append(json.dumps({"score": str(n % 11 - 5), "analyse": f"{n} characters"}))
    return out


def _default_factory() -> Scorer:
    return standin_scorer


def score_rows(
    df: DataFrame,
    text_col: str,
    make_scorer: Callable[[], Scorer] = _default_factory,
    concurrency: int | None = None,
    answer_col: str = "answer",
) -> DataFrame:
    """Return ``df`` with an ``answer_col`` column (one model answer per
    row).  All columns pass through the Arrow batches, so no join back on
    a synthetic row key is needed.  ``concurrency`` round-robin
    repartitions first (balanced even when one key dominates), bounding
    the number of concurrent clients.  The scorer gets at most
    ``SLICE_ROWS`` texts at a time; of an Arrow batch no more than these
    are Python strings at once."""
    src = df.repartition(concurrency) if concurrency else df
    out_schema = T.StructType(list(src.schema.fields) + [T.StructField(answer_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = make_scorer()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = batch.slice(at, SLICE_ROWS)
                texts = [t if isinstance(t, str) else None for t in rows.column(text_col).to_pylist()]
                answers = pa.array(scorer(texts), pa.string())
                yield pa.RecordBatch.from_arrays([*rows.columns, answers], names=[*rows.schema.names, answer_col])

    return src.mapInArrow(run, out_schema)


# --------------------------------------------------------------------- HTTP
# A model call returns (status, body); the body is parsed by the Spark
# column functions (llm.first_choice_content / llm.strict_answer), so the
# Python side stays a thin transport with timeout and retries.

Client = Callable[[str], tuple]


def http_chat_client(endpoint: str, api_key: str, timeout: float = 60.0, retries: int = 2) -> Callable[[], Client]:
    """Factory of a chat-completion client (standard library only).  The
    client takes a request JSON (``llm.scoring_request``) and returns
    ``(status, body)``; transport failures give ``(0, "")`` after
    ``retries`` extra attempts.  Built once per partition on executors."""

    def make() -> Client:
        import time
        import urllib.error
        import urllib.request

        def call(request_json: str) -> tuple:
            for attempt in range(retries + 1):
                req = urllib.request.Request(
                    endpoint,
                    data=request_json.encode("utf-8"),
                    headers={"Content-Type": "application/json", "Authorization": f"Bearer {api_key}"},
                    method="POST",
                )
                try:
                    with urllib.request.urlopen(req, timeout=timeout) as resp:
                        return resp.status, resp.read().decode("utf-8", errors="replace")
                except urllib.error.HTTPError as e:
                    if e.code < 500 or attempt == retries:
                        return e.code, e.read().decode("utf-8", errors="replace")
                except Exception:  # noqa: BLE001 - timeout, connection reset, DNS
                    if attempt == retries:
                        return 0, ""
                time.sleep(min(30.0, 2.0**attempt))
            return 0, ""

        return call

    return make


def fetch_rows(
    df: DataFrame,
    request_col: str,
    make_client: Callable[[], Client],
    concurrency: int | None = None,
    in_flight: int = 1,
) -> DataFrame:
    """``df`` plus ``status`` (int) and ``body`` (string) from one model call
    per row; all columns pass through the Arrow batches.  ``concurrency``
    round-robin repartitions first to bound parallel clients; each client
    has at most ``in_flight`` calls open at a time."""
    src = df.repartition(concurrency) if concurrency else df
    out_schema = T.StructType(
        list(src.schema.fields) + [T.StructField("status", T.IntegerType()), T.StructField("body", T.StringType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from concurrent.futures import ThreadPoolExecutor

        client = make_client()
        with ThreadPoolExecutor(max_workers=max(1, in_flight)) as pool:
            for pdf in batches:
                out = list(pool.map(lambda r: client(r) if isinstance(r, str) else (0, ""), pdf[request_col].tolist()))
                pdf["status"] = [int(s) for s, _ in out]
                pdf["body"] = [b for _, b in out]
                yield pdf

    return src.mapInPandas(run, out_schema)


def fetch_responses(
    df: DataFrame,
    key_col: str,
    request_col: str,
    make_client: Callable[[], Client],
    concurrency: int | None = None,
) -> DataFrame:
    """Call the model for every row and land ``(key, status, body)`` --
    the responses table the tick joins (J4)."""
    src = df.select(F.col(key_col).alias("key"), F.col(request_col).alias("request"))
    return fetch_rows(src, "request", make_client, concurrency).select("key", "status", "body")


LANDED = "key string, status int, body string, answered boolean"


def land_responses(
    requests: DataFrame,
    path: str,
    make_client: Callable[[], Client],
    block_rows: int = 10_000,
    concurrency: int | None = None,
    in_flight: int = 8,
    answered=lambda status, body: status == 200,
) -> DataFrame:
    """E3, resumable: (key, status, body) of every row of ``requests`` (key,
    request), landed in the table at ``path``.

    Keys that have an answer there are not called.  The others are dealt
    over blocks of about ``block_rows``, each its own job whose answers are
    landed before the next one starts: a failed tick, or a lost executor that
    ends a job, repeats the calls of one block at most.  ``answered`` says
    which responses count; others are landed, returned, and called again the
    next time.  A key is one call however many rows have it."""
    spark = requests.sparkSession
    wanted = scratch_path(spark, "requests")
    keyed = requests.select("key", "request").groupBy("key").agg(F.min("request").alias("request"))
    landed = read_or_empty(spark, path, LANDED)
    missing = keyed.join(landed.filter("answered").select("key"), "key", "left_anti")
    missing.write.parquet(wanted)
    todo = spark.read.parquet(wanted)
    blocks = -(-todo.count() // block_rows)
    for block in range(blocks):
        rows = todo.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block)
        got = fetch_rows(rows, "request", make_client, concurrency, in_flight)
        got = got.select("key", "status", "body", answered(F.col("status"), F.col("body")).alias("answered"))
        got.write.mode("append").parquet(path)
    best = F.max(F.struct("answered", "status", "body")).alias("best")
    found = read_or_empty(spark, path, LANDED).join(keyed.select("key"), "key", "left_semi").groupBy("key").agg(best)
    return found.select("key", "best.status", "best.body")


def scorer_client(make_scorer: Callable[[], Scorer]) -> Callable[[], Client]:
    """A scorer as a client: the answer text is the body."""

    def make() -> Client:
        scorer = make_scorer()
        return lambda text: (200, scorer([text])[0])

    return make
