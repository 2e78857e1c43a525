"""Removal of byte strings that occur in an earlier document (operator 5).

A byte goes if a string of ``length`` bytes covering it also starts in a
document with a smaller id.  The corpus is never sorted as a whole; a
prefix-free parsing reduces it first:

* *Triggers.*  A rolling hash picks one trigger (a k-byte string) inside
  every ``length``-byte window, as a function of the window's bytes alone.
  Windows with one trigger are consecutive; together they are a *phrase*.
  Phrases of a document overlap by length - 1 bytes, so each window lies in
  exactly one phrase, and equal windows have equal triggers.
* *Pruning.*  Triggers seen in one text only cannot hold a repeated window.
  They are counted (grouped minimum and maximum of the text class) and their
  phrases never leave the text pass.
* *Dictionary.*  The distinct phrases that are left, each with the first
  document that has it.  Any later occurrence is covered as a whole.
* *Corpus order.*  Within a trigger's phrases the window-long suffixes are
  sorted (the part of the dictionary's suffix array that windows can share);
  neighbours with a common prefix of ``length`` bytes form runs, and the
  smallest first document of a run decides for its windows.  A window never
  reaches past its phrase, so the parse adds only where a phrase occurs: the
  parse table (document, place, phrase) carries the verdicts back.
  Triggers with more than ``max_class`` phrases are not gathered in a task:
  their windows are grouped by a distributed aggregate instead.

Exact copies of a text are found by digest and need none of this.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.arrow_text import SpanHasher, text_chunks
from quillstream.llm.scratch import cut, drop, free_name

LENGTH = 50
TRIGGER = 28
SEED_BYTES = 5  # hashes of so many bytes place the trigger; = TRIGGER modulo the places
PLACES = LENGTH - TRIGGER + 1
SEED_FACTOR = 0x9E3779B97F4A7C15
SEGMENT = 4_000_000
PHRASE_SCHEMA = "doc_id bigint, at bigint, key bigint, place int, phrase binary"


def _segments(data: np.ndarray, offsets: np.ndarray):
    """Cut texts longer than SEGMENT so that every window lies in one part."""
    if offsets[-1] <= SEGMENT:
        yield np.arange(len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64), data, offsets
        return
    for i in range(len(offsets) - 1):
        own = data[offsets[i] : offsets[i + 1]]
        for at in range(0, max(len(own) - LENGTH + 1, 1), SEGMENT):
            part = own[at : at + SEGMENT + LENGTH - 1]
            yield np.array([i]), np.array([at]), part, np.array([0, len(part)])


class Phrases:
    """Phrases of the texts of a chunk as arrays: text, start and end in the
    chunk, and the trigger's place in the phrase with its key."""

    def __init__(self, hasher: SpanHasher, data: np.ndarray, offsets: np.ndarray) -> None:
        n = len(data) - LENGTH + 1
        empty = np.empty(0, dtype=np.int64)
        self.text = self.start = self.end = self.place = empty
        self.key = empty
        if n <= 0:
            return
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        wide = np.ndarray((len(data) - SEED_BYTES + 1,), dtype="<u8", buffer=padded, strides=(1,))
        low = wide << np.uint64(64 - 8 * SEED_BYTES)  # the seed's bytes alone
        low *= np.uint64(SEED_FACTOR)
        low ^= low >> np.uint64(32)
        low *= np.uint64(SEED_FACTOR)
        low &= ~np.uint64((1 << 24) - 1)
        low |= np.arange(len(low), dtype=np.uint64)
        width, span = 1, LENGTH - SEED_BYTES + 1
        while 2 * width <= span:  # minimum over 1, 2, 4 ... places
            low = np.minimum(low[: len(low) - width], low[width:])
            width *= 2
        least = np.minimum(low[:n], low[span - width : span - width + n])
        least &= np.uint64((1 << 24) - 1)
        trigger = least.astype(np.int64)
        trigger -= PLACES * (trigger - np.arange(n) >= PLACES)
        inside = np.ones(n, dtype=bool)
        for end in offsets[1:].tolist():
            inside[max(0, end - LENGTH + 1) : end] = False
        # a text under LENGTH bytes has no window of its own
        for start in offsets[:-1][np.diff(offsets) < LENGTH].tolist():
            inside[start : start + 1] = False
        change = np.flatnonzero((trigger[1:] != trigger[:-1]) | (inside[1:] != inside[:-1])) + 1
        first = np.concatenate(([0], change))
        last = np.concatenate((change, [n])) - 1
        good = inside[first]
        first, last = first[good], last[good]
        if not len(first):
            return
        self.text = np.searchsorted(offsets, first, side="right") - 1
        self.start, self.end = first, last + LENGTH
        self.place = trigger[first] - first
        prefix = hasher.prefix(data)
        self.key = hasher.spans(prefix, trigger[first], trigger[first] + TRIGGER).view(np.int64)


def _phrases(column: pa.Array):
    """Yield (row of each text, offset of the part, part, its phrases)."""
    hasher = SpanHasher(seed=5)
    for row, data, offsets in text_chunks(column):
        for rows, shift, part, bounds in _segments(data, offsets):
            yield row + rows, shift, part, Phrases(hasher, part, bounds), bounds


def with_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (null: empty) and the 64-bit class of equal texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).withColumn("cls", F.xxhash64("text"))


def text_heads(docs: DataFrame) -> DataFrame:
    """Id, class, byte length and SHA-256 of every text."""
    raw = F.col("text").cast("binary")
    return docs.select("doc_id", "cls", F.length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("sha256"))


def _trigger_keys(docs: DataFrame) -> DataFrame:
    """(text class, trigger key), once for each phrase of a text; a text that
    comes again within an Arrow batch gives nothing new."""

    def keys(batches):
        for batch in batches:
            cls = batch.column(1).to_numpy()
            _, first = np.unique(cls, return_index=True)
            first.sort()
            own = cls[first]
            for rows, _, _, found, _ in _phrases(batch.column(0).take(pa.array(first))):
                yield pa.RecordBatch.from_arrays([pa.array(own[rows[found.text]]), pa.array(found.key)], names=["cls", "key"])

    return docs.select("text", "cls").mapInArrow(keys, "cls bigint, key bigint")


def _shared_phrases(texts: DataFrame) -> DataFrame:
    """Phrases of each text (doc_id, text, keys) whose trigger is in keys."""

    def phrases(batches):
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            wanted = [np.sort(np.asarray(x, dtype=np.int64)) for x in batch.column(2).to_numpy(zero_copy_only=False)]
            for rows, shift, part, found, bounds in _phrases(batch.column(1)):
                if not len(found.key):
                    continue
                keep = np.zeros(len(found.key), dtype=bool)
                cuts = np.searchsorted(found.text, np.arange(len(rows) + 1))
                for i, row in enumerate(rows):
                    lo, hi = cuts[i], cuts[i + 1]
                    at = np.searchsorted(wanted[row], found.key[lo:hi])
                    at[at == len(wanted[row])] = 0
                    keep[lo:hi] = wanted[row][at] == found.key[lo:hi]
                at = np.flatnonzero(keep)
                raw = part.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc[rows[found.text[at]]]),
                        pa.array(found.start[at] - bounds[found.text[at]] + shift[found.text[at]]),
                        pa.array(found.key[at]),
                        pa.array(found.place[at], pa.int32()),
                        pa.array([raw[a:b] for a, b in zip(found.start[at], found.end[at], strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "at", "key", "place", "phrase"],
                )

    return texts.mapInArrow(phrases, PHRASE_SCHEMA)


def _suffix_runs(phrases: list[bytes], places: np.ndarray, first: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Bit j of the result of a phrase: its window j also starts in a
    document before the phrase's own first one.

    Sorts the window-long suffixes of the phrases (a suffix array cut at
    ``LENGTH`` bytes) within equal trigger group and place."""
    count = np.array([len(p) - LENGTH + 1 for p in phrases])
    owner = np.repeat(np.arange(len(phrases)), count)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    data = np.frombuffer(b"".join(phrases) + b"\0" * 8, dtype=np.uint8)
    begin = np.cumsum([0, *map(len, phrases)])[owner] + offset
    words = []
    for k in range(0, LENGTH, 8):  # big-endian words keep byte order
        word = np.zeros(len(owner), dtype=np.uint64)
        for b in range(8):
            word <<= np.uint64(8)
            if k + b < LENGTH:
                word |= data[begin + k + b].astype(np.uint64)
        words.append(word)
    keys = [*words[::-1], places[owner] - offset, group[owner]]
    order = np.lexsort(keys)
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for key in keys:
        ranked = key[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    runs = np.flatnonzero(new)
    least = np.minimum.reduceat(first[owner[order]], runs)[np.cumsum(new) - 1]
    hit = np.zeros(len(order), dtype=np.int64)
    hit[order] = least < first[owner[order]]
    flags = np.zeros(len(phrases), dtype=np.int64)
    np.bitwise_or.at(flags, owner, hit << offset)
    return flags


def _ordered_classes(dictionary: DataFrame, slice_rows: int = 20_000) -> DataFrame:
    """Window flags of dictionary phrases, with whole triggers in a task; the
    task keeps about ``slice_rows`` phrases at a time."""

    def flags(batches):
        held: list[tuple] = []

        def solve(rows: list[tuple]) -> pa.RecordBatch:
            key = np.array([r[0] for r in rows], dtype=np.int64)
            place = np.array([r[1] for r in rows], dtype=np.int64)
            first = np.array([r[3] for r in rows], dtype=np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(key),
                    pa.array(place, pa.int32()),
                    pa.array([r[2] for r in rows], pa.binary()),
                    pa.array(first),
                    pa.array(_suffix_runs([r[2] for r in rows], place, first, key)),
                ],
                names=["key", "place", "phrase", "first", "flags"],
            )

        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
            if len(held) > slice_rows:
                end = len(held)
                while end and held[end - 1][0] == held[-1][0]:  # the last trigger may go on
                    end -= 1
                if end:
                    yield solve(held[:end])
                    held = held[end:]
        if held:
            yield solve(held)

    ready = dictionary.repartition("key").sortWithinPartitions("key")
    return ready.mapInArrow(flags, "key bigint, place int, phrase binary, first bigint, flags bigint")


def _hot_classes(dictionary: DataFrame) -> DataFrame:
    """The same flags for triggers of very many phrases, by aggregates."""
    windows = F.sequence(F.lit(0), F.length("phrase") - LENGTH)
    rows = dictionary.select("*", F.explode(windows).alias("j")).withColumn("rel", F.col("place") - F.col("j"))
    rows = rows.withColumn("window", F.expr(f"substring(phrase, j + 1, {LENGTH})"))
    least = rows.groupBy("key", "rel", "window").agg(F.min("first").alias("least"))
    hit = rows.join(least, ["key", "rel", "window"]).withColumn(
        "bit", F.when(F.col("least") < F.col("first"), F.expr("shiftleft(1L, j)")).otherwise(F.lit(0))
    )
    return hit.groupBy("key", "place", "phrase", "first").agg(F.sum("bit").alias("flags"))


def repeated_spans(docs: DataFrame, heads: DataFrame, max_class: int = 20_000) -> DataFrame:
    """(doc_id, spans): where texts that are the first of their copies repeat
    windows of earlier documents.  A span is (at, size, flags): bytes
    [at, at + size), and [at + j, at + j + LENGTH) for every bit j of flags.
    ``docs`` comes from ``with_class``, ``heads`` from ``text_heads``."""
    keys = _trigger_keys(docs)
    shared = cut(
        keys.groupBy("key").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo != hi").select("key"),
        "triggers",
    )
    firsts = heads.where("doc_id is not null").groupBy("cls", "sha256").agg(F.min("doc_id").alias("doc_id"))
    # one row a key and partition: the build side of each partition is bounded
    wanted = keys.join(shared.hint("shuffle_hash"), "key").groupBy("cls").agg(F.collect_set("key").alias("keys"))
    wanted = cut(firsts.select("cls", "doc_id").join(wanted, "cls").select("doc_id", "keys"), "wanted")
    drop(shared)
    parse = cut(
        _shared_phrases(docs.select("doc_id", "text").join(wanted, "doc_id")).withColumn(
            "id", F.xxhash64("key", "place", "phrase")
        ),
        "parse",
    )
    drop(wanted)
    dictionary = cut(parse.groupBy("key", "place", "phrase").agg(F.min("doc_id").alias("first")), "dictionary")
    sizes = dictionary.groupBy("key").count().where("count > 1")
    several = cut(dictionary.join(sizes.hint("shuffle_hash"), "key"), "classes")
    flagged = _ordered_classes(several.where(F.col("count") <= max_class).drop("count")).unionByName(
        _hot_classes(several.where(F.col("count") > max_class).drop("count"))
    )
    flagged = cut(
        flagged.where("flags != 0").select(F.xxhash64("key", "place", "phrase").alias("id"), "key", "flags"), "flags"
    )
    drop(several)
    first = dictionary.select(F.xxhash64("key", "place", "phrase").alias("id"), "key", "first")
    # written, so that the join below has a shuffle on both sides and a phrase
    # of very many documents can be split
    verdicts = cut(first.join(flagged, ["id", "key"], "left"), "verdicts")
    drop(dictionary, flagged)
    places = parse.select("doc_id", "at", "id", "key", F.length("phrase").alias("size")).join(verdicts, ["id", "key"])
    whole = F.col("first") < F.col("doc_id")
    span = F.struct(
        "at",
        F.when(whole, F.col("size")).otherwise(F.lit(0)).alias("size"),
        F.when(whole, F.lit(0)).otherwise(F.col("flags")).cast("long").alias("flags"),
    )
    found = places.where(whole | F.col("flags").isNotNull()).select("doc_id", span.alias("span"))
    spans = cut(found.groupBy("doc_id").agg(F.collect_list("span").alias("spans")), "spans")
    drop(parse, verdicts)
    return spans


def kept_bytes(raw: bytes, spans: list[dict]) -> tuple[bytes, int, int]:
    """(bytes left, bytes removed, maximal removed runs) of one text."""
    step = np.zeros(len(raw) + 1, dtype=np.int64)
    for span in spans:
        at, size, flags = span["at"], span["size"], span["flags"]
        if size:
            step[at] += 1
            step[min(at + size, len(raw))] -= 1
        while flags:
            j = (flags & -flags).bit_length() - 1
            flags &= flags - 1
            step[at + j] += 1
            step[at + j + LENGTH] -= 1
    gone = np.cumsum(step[:-1]) > 0
    runs = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1])))) if len(raw) else 0
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def _cleaned(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Ids with spans: text class, remaining bytes and counts."""

    def clean(batches):
        for batch in batches:
            out = [kept_bytes((t or "").encode(), s) for t, s in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([x[1] for x in out], pa.int64()),
                    pa.array([x[2] for x in out], pa.int64()),
                    pa.array([hashlib.sha256(x[0]).hexdigest() for x in out], pa.string()),
                    pa.array([x[0] for x in out], pa.binary()),
                ],
                names=["doc_id", "cls", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return docs.select("doc_id", "text", "cls").join(spans, "doc_id").mapInArrow(
        clean, "doc_id bigint, cls bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    )


EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Defined cases: a null text is empty; a text under ``LENGTH`` bytes loses
    nothing; a row whose id is null has no place in the order, so it neither
    loses bytes nor makes others lose them; rows with equal ids do not affect
    one another; repeated rows are reported alike, one by one; an empty table
    gives no rows; other columns are ignored."""
    docs = with_class(docs, id_col, text_col)
    heads = cut(text_heads(docs), "heads")
    spans = repeated_spans(docs, heads)
    cleaned = _cleaned(docs, spans).drop("kept").distinct()
    firsts = heads.where("doc_id is not null").groupBy("cls", "sha256").agg(F.min("doc_id").alias("first"))
    copy = (F.col("first") < F.col("doc_id")) & (F.col("n_bytes") >= LENGTH)
    rows = heads.join(firsts, ["cls", "sha256"], "left").join(cleaned, ["doc_id", "cls"], "left")
    return rows.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.lit(EMPTY_SHA256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text column; bytes of
    a character of which only a part was cut go too.  Other columns stay,
    whatever their names; the cases of ``repeat_report`` hold, and a null text
    stays null."""
    own = with_class(docs, id_col, text_col)
    heads = cut(text_heads(own), "heads")
    spans = repeated_spans(own, heads)
    firsts = heads.where("doc_id is not null").groupBy("cls", "sha256").agg(F.min("doc_id").alias("first"))
    gone = heads.join(firsts, ["cls", "sha256"]).where((F.col("first") < F.col("doc_id")) & (F.col("n_bytes") >= LENGTH))
    marks = cut(
        spans.select("doc_id", "spans", F.lit(None).cast("bigint").alias("whole")).unionByName(
            gone.select("doc_id", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), F.col("cls").alias("whole")).distinct()
        ),
        "marks",
    )
    id_, spans_, whole_ = (free_name(n, docs.columns) for n in ("marked", "spans", "whole"))
    marks = marks.groupBy(F.col("doc_id").alias(id_)).agg(F.max("spans").alias(spans_), F.collect_set("whole").alias(whole_))
    joined = docs.join(marks, F.col(id_col).cast("long") == F.col(id_), "left").drop(id_)
    at = joined.columns.index(text_col)
    width = len(docs.columns)
    copy = F.array_contains(whole_, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    joined = joined.withColumn(whole_, F.coalesce(copy, F.lit(False)))

    def clean(batches):
        for batch in batches:
            texts, spans, whole = (batch.column(i).to_pylist() for i in (at, width, width + 1))
            new = [
                "" if w else t if not s or t is None else kept_bytes(t.encode(), s)[0].decode("utf-8", "ignore")
                for t, s, w in zip(texts, spans, whole, strict=True)
            ]
            columns = list(batch.columns[:width])
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:width])

    return joined.mapInArrow(clean, docs.schema)
