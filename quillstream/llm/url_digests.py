"""URL rules in a sorted digest array (operator 7).

A rule is a host and a path prefix with a verdict.  Its key is the 64-bit
xxHash of host + path; keys are stored sorted, beside the full strings.  A
URL asks for the keys of all suffixes of its host (at label borders) joined
with the prefixes of its path that have a length some rule has.  All
questions of a batch go through one vectorised binary search over the
memory-mapped keys, and every hit is confirmed against the stored string, so
a digest collision cannot decide.  Of the rules that fit, the longest wins;
with no rule the verdict is ``default``.

The store is a folder of shards by the high bits of the key, written by
tasks into the shared folder and handed to executors by Spark's file
distribution, which gives each a local copy to map.  It is never held on the
driver, and the mapped pages are shared by the workers of a machine.
"""

from __future__ import annotations

import re
import sys
import types
import uuid

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm.token_files import open_folder
from quillstream.session import scratch_path

MAGIC = b"QDA1"
URL = re.compile(r"://([^/?#]*)([^?#]*)")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """(host in lower case, path); both empty without ``://``."""
    found = URL.search(url or "")
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


def shard_bytes(rules: list[tuple[str, str, str]]) -> bytes:
    """One shard: sorted keys, host lengths, verdict codes, string bounds and
    the strings themselves (``host + path``, UTF-8)."""
    import xxhash

    rows = sorted((xxhash.xxh64_intdigest((h + p).encode()), h, p, v) for h, p, v in rules)
    texts = [(h + p).encode() for _, h, p, _ in rows]
    return b"".join(
        [
            MAGIC,
            bytes(4),
            np.array([len(rows)], "<u8").tobytes(),
            np.array([k for k, *_ in rows], "<u8").tobytes(),
            np.cumsum([0, *map(len, texts)]).astype("<u8").tobytes(),
            np.array([len(h.encode()) for _, h, _, _ in rows], "<u4").tobytes(),
            np.array([v == "block" for *_, v in rows], "u1").tobytes(),
            *texts,
        ]
    )


class Shard:
    """A mapped shard file."""

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, dtype=np.uint8, mode="r")
        if raw[:4].tobytes() != MAGIC:
            raise ValueError("not a digest shard")
        n, at = int(raw[8:16].view("<u8")[0]), 16
        self.keys = raw[at : at + 8 * n].view("<u8")
        at += 8 * n
        self.bounds = raw[at : at + 8 * (n + 1)].view("<u8")
        at += 8 * (n + 1)
        self.hosts = raw[at : at + 4 * n].view("<u4")
        at += 4 * n
        self.block = raw[at : at + n]
        self.texts = raw[at + n :]

    def find(self, keys: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """Rule number of every question, -1 where no stored string equals it."""
        out = np.full(len(keys), -1, dtype=np.int64)
        at = np.searchsorted(self.keys, keys, side="left")
        stop = np.searchsorted(self.keys, keys, side="right")
        for i in np.flatnonzero(stop > at).tolist():
            for rule in range(int(at[i]), int(stop[i])):  # equal digests: the strings decide
                if self.texts[int(self.bounds[rule]) : int(self.bounds[rule + 1])].tobytes() == texts[i]:
                    out[i] = rule
                    break
        return out


class DigestStore:
    """Handle of a written store; small, travels with the task."""

    def __init__(self, names: list[str], lengths: list[int]) -> None:
        self.names, self.lengths = names, lengths

    def shards(self) -> list[Shard]:
        holder = sys.modules.setdefault("_quillstream_worker_state", types.ModuleType("_quillstream_worker_state"))
        made = holder.__dict__.setdefault("digest_shards", {})
        for name in self.names:
            if name not in made:
                made[name] = Shard(SparkFiles.get(name))
        return [made[name] for name in self.names]


def write_store(rules: DataFrame, shards: int = 1) -> DigestStore:
    """Write rules (host, path, verdict allow or block) as ``shards`` files
    under the shared folder.  A rule given twice counts once; of two verdicts
    for one rule block wins."""
    spark = rules.sparkSession
    folder = scratch_path(spark, "url-digests")
    run = uuid.uuid4().hex[:12]
    store, path = open_folder(folder)
    store.create_dir(path)
    names = [f"digests-{run}-{i:05d}.qda" for i in range(shards)]
    own = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull()).groupBy("host", "path")
    own = own.agg(F.max(F.col("verdict")).alias("verdict"))  # "block" > "allow"

    def number(batches):
        import xxhash

        for batch in batches:
            keys = [xxhash.xxh64_intdigest((h + p).encode()) for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([k * shards >> 64 for k in keys], pa.int32()), pa.array([len(p) for p in batch["path"].to_pylist()], pa.int32())],
                names=["host", "path", "verdict", "shard", "length"],
            )

    def write(batches):
        store, path = open_folder(folder)
        held: dict[int, list] = {}
        for batch in batches:
            for h, p, v, s in zip(*(batch[c].to_pylist() for c in ("host", "path", "verdict", "shard")), strict=True):
                held.setdefault(s, []).append((h, p, v))
        for s, rows in held.items():
            part = f"{path}/{names[s]}.{uuid.uuid4().hex}"
            with store.open_output_stream(part) as out:
                out.write(shard_bytes(rows))
            store.move(part, f"{path}/{names[s]}")
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32())], names=["shard"])

    numbered = own.mapInArrow(number, "host string, path string, verdict string, shard int, length int")
    lengths = [r["length"] for r in numbered.select("length").distinct().collect()]  # at most the longest path
    written = {r["shard"] for r in numbered.repartition(shards, "shard").mapInArrow(write, "shard int").collect()}
    kept = [names[s] for s in sorted(written)]
    for name in kept:
        spark.sparkContext.addFile(f"{folder}/{name}")
    return DigestStore(kept, sorted(lengths))


def judge_urls(
    pages: DataFrame, store: DigestStore, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """Per row: page_id, host, path, rule (null if none fits), verdict.

    Defined cases: a null url or one without ``://`` has empty host and path
    and the default verdict; null ids stay null; repeated rows are judged
    alike, one by one; rules of equal length: the longer host wins; an empty
    table gives no rows; other columns are ignored."""

    def judge(batches):
        import xxhash

        shards = store.shards()
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            owner, texts, hosts = [], [], []
            for i, (host, path) in enumerate(parts):
                at = 0
                while host and at >= 0:
                    suffix = host[at:]
                    for length in store.lengths:
                        if length <= len(path):
                            owner.append(i)
                            texts.append((suffix + path[:length]).encode())
                            hosts.append(len(suffix))
                    at = host.find(".", at) + 1 or -1
            keys = np.array([xxhash.xxh64_intdigest(t) for t in texts], dtype=np.uint64)
            best: dict[int, tuple[int, int, str, str]] = {}
            for shard in shards:
                found = shard.find(keys, texts)
                for q in np.flatnonzero(found >= 0).tolist():
                    text = texts[q].decode()
                    verdict = "block" if shard.block[found[q]] else "allow"
                    fit = (len(text), hosts[q], text, verdict)
                    best[owner[q]] = max(best.get(owner[q], fit), fit)
            chosen = [best.get(i) for i in range(len(parts))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h for h, _ in parts], pa.string()),
                    pa.array([p for _, p in parts], pa.string()),
                    pa.array([c and c[2] for c in chosen], pa.string()),
                    pa.array([c[3] if c else default for c in chosen], pa.string()),
                ],
                names=["page_id", "host", "path", "rule", "verdict"],
            )

    own = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"))
    return own.mapInArrow(judge, "page_id bigint, host string, path string, rule string, verdict string")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, verdict string")
