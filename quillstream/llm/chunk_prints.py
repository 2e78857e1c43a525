"""Document fingerprints from content-defined chunks (operator 9).

A gear hash over the last 16 bytes proposes chunk ends.  Sizes are
normalised: before ``NORMAL`` bytes only a strict pattern ends a chunk,
after it a loose one does, and ``MAX`` bytes end it in any case.  No end is
tested within ``MIN`` = 16 bytes of a chunk's start, so ends depend on the
chunk's own bytes only: an edit changes the chunks it touches and the cut
finds the old ends again after it.

The fingerprint is the set of chunk digests, each weighted by the chunk's
length; likeness is containment, the shared weight over the weight of the
lighter set.

Neighbours in id order meet without a global sort: ids are cut into ranges
at existing ids, a range is sorted in its task, and the row that opens a
range is also sent to the range before it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.arrow_text import CHUNK_BYTES, SpanHasher, byte_weights

MIN, NORMAL, MAX = 16, 48, 192
STRICT = np.uint64(0x7F << 57)  # 7 bits before NORMAL
LOOSE = np.uint64(0x0F << 57)  # 4 of them after it
LOWEST = -(1 << 63)


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunk ends, chunks per text) for texts standing side by side."""
    gear = byte_weights(seed=9)[data]
    step = 1
    while step < 16:  # sums over 2, 4, 8, 16 bytes, 4 bits a byte
        later = gear[step:] + (gear[:-step] << np.uint64(4 * step)) if len(gear) > step else gear[:0]
        gear = np.concatenate((gear[:step], later))
        step *= 2
    loose = np.flatnonzero((gear & LOOSE) == 0)
    strict = loose[(gear[loose] & STRICT) == 0].tolist()
    loose = loose.tolist()
    ends, counts = [], []
    for at, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        before = len(ends)
        while stop - at > MIN:
            end = min(at + MAX, stop)
            i = bisect_left(strict, at + MIN)
            if i < len(strict) and strict[i] < min(at + NORMAL, end):
                end = strict[i] + 1
            else:
                i = bisect_left(loose, at + NORMAL)
                if i < len(loose) and loose[i] < end:
                    end = loose[i] + 1
            ends.append(end)
            at = end
        if at < stop:
            ends.append(stop)
        counts.append(len(ends) - before)
    return np.array(ends, dtype=np.int64), np.array(counts, dtype=np.int64)


def fingerprints(texts: list[bytes], hasher: SpanHasher) -> list[dict[int, int]]:
    """Chunk digest -> length of every text."""
    out: list[dict[int, int]] = []
    at = 0
    while at < len(texts):
        stop, size = at, 0
        while stop < len(texts) and (stop == at or size + len(texts[stop]) <= CHUNK_BYTES):
            size += len(texts[stop])
            stop += 1
        data = np.frombuffer(b"".join(texts[at:stop]), dtype=np.uint8)
        offsets = np.cumsum([0, *map(len, texts[at:stop])])
        ends, counts = chunk_ends(data, offsets)
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        digest = (hasher.spans(hasher.prefix(data), starts, ends) >> np.uint64(16)).tolist()
        lengths = (ends - starts).tolist()
        k = 0
        for n in counts.tolist():
            out.append(dict(zip(digest[k : k + n], lengths[k : k + n], strict=True)))
            k += n
        at = stop
    return out


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Shared weight over the lighter set's weight; 1 for two empty sets, 0
    if one is empty."""
    if not a or not b:
        return float(not a and not b)
    shared = sum(a[d] for d in a.keys() & b.keys())
    return shared / min(sum(a.values()), sum(b.values()))


def written(prints: dict[int, int]) -> str:
    """``digest:length`` in hex, in digest order."""
    return " ".join(f"{d:012x}:{n:x}" for d, n in sorted(prints.items()))


def parsed(text: str) -> dict[int, int]:
    return {int(d, 16): int(n, 16) for d, n in (x.split(":") for x in text.split())}


def _ranges(docs: DataFrame, ranges: int) -> list[int]:
    """Existing ids that open a range, ascending; the first is the smallest."""
    probs = ", ".join(str(i / ranges) for i in range(ranges))
    row = docs.agg(
        F.min("place").alias("low"), F.expr(f"percentile_approx(place, array({probs}), {100 * ranges})").alias("cuts")
    ).first()
    return sorted({row["low"], *(row["cuts"] or [])}) if row["low"] is not None else []


def with_neighbours(docs: DataFrame, opens: list[int]) -> DataFrame:
    """Rows dealt to ranges; the rows with the id that opens a range go to
    the one before it as well, marked as tail."""
    opens_at = np.array(opens, dtype=np.int64)

    def deal(batches):
        for batch in batches:
            place = batch.column(0).to_numpy()
            own = np.searchsorted(opens_at, place, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own, pa.int32()), pa.array(np.zeros(len(own), bool))], names=["place", "text", "range", "tail"]
            )
            first = np.flatnonzero(opens_at[own] == place)
            if len(first):
                copies = batch.take(pa.array(first))
                before = (own[first] - 1) % len(opens_at)
                yield pa.RecordBatch.from_arrays(
                    [*copies.columns, pa.array(before, pa.int32()), pa.array(np.ones(len(first), bool))], names=["place", "text", "range", "tail"]
                )

    return docs.mapInArrow(deal, "place bigint, text string, range int, tail boolean")


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the fingerprint of the text and of its edited form (the last
    quarter replaced by the start of the next text in id order; the last row
    takes the first), and the likeness to the edited form and the next text.

    Defined cases: a null or empty text has an empty fingerprint; null ids
    come before all others; rows with equal ids follow one another by text;
    repeated rows are rows of their own; a single row is its own neighbour;
    an empty table gives no rows; other columns are ignored."""
    spark = docs.sparkSession
    place = F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("place")
    own = docs.select(place, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    opens = _ranges(own.select("place"), 4 * parts)  # several ranges a task even out the load

    def compare(batches):
        hasher = SpanHasher(seed=9)
        last: tuple | None = None  # the row waiting for its neighbour
        for batch in batches:
            rows = list(zip(*(batch[c].to_pylist() for c in ("place", "text", "range", "tail")), strict=True))
            raw = [r[1].encode() for r in rows]
            rows = [(p, t, g, x, b, f) for (p, t, g, x), b, f in zip(rows, raw, fingerprints(raw, hasher), strict=True)]
            pairs = []
            for row in rows:
                if last is not None and last[2] == row[2]:
                    pairs.append((last, row))
                last = None if row[3] else row  # of several tails only the first follows a row
            edited = []
            for (_, text, *_), (_, after, *_) in pairs:
                k = len(text) // 4
                edited.append((text[: len(text) - k] + after[:k]).encode())
            prints = fingerprints(edited, hasher)
            out = [
                (None if a[0] == LOWEST else a[0], len(a[1]), hashlib.sha256(e).hexdigest(), written(a[5]), written(p), containment(a[5], p), containment(a[5], b[5]))
                for (a, b), e, p in zip(pairs, edited, prints, strict=True)
            ]
            if out:
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=NAMES)

    dealt = with_neighbours(own, opens).repartition(parts, "range").sortWithinPartitions("range", "tail", "place", "text")
    return dealt.mapInArrow(compare, SCHEMA)


NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
