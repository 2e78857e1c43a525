"""Token-id files: frequency-ranked ids in a byte-aligned variable-length
code with separate control bytes (operator 3).

An id is replaced by its rank by falling corpus frequency and stored in 1 to
4 bytes; a control byte holds the lengths of four values.  Ranks under 256
take one byte.  Decoding looks the four lengths up in a 256-row table, so a
block decodes with a few NumPy gathers and no loop over values.

Layout of a dataset folder (little-endian): ``ranks.bin``, the ids in rank
order (u32); ``part-SSSSSS-BBBBBB.qtok`` per block of consecutive documents:
magic ``QTK1``, u64 document and id counts, document ids (i64), id counts
(u32), control bytes (ceil(ids / 4)), data bytes.  Blocks sort by name into
ascending document id.

A block holds at most ``block_bytes`` of text (or one longer document), so
no task gathers more.  Files are written under another name and renamed;
a repeated task writes the same bytes again.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm.piece_cache import encoder
from quillstream.llm.scratch import cut
from quillstream.session import scratch_path

MAGIC = b"QTK1"
VALUE_LIMITS = np.array([1 << 8, 1 << 16, 1 << 24], dtype=np.uint64)


def length_table() -> np.ndarray:
    """Byte lengths (1-4) of the four values of every control byte."""
    control = np.arange(256)
    return np.stack([(control >> (2 * k) & 3) + 1 for k in range(4)], axis=1).astype(np.int64)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of u32 values."""
    values = values.astype(np.uint32)
    code = np.searchsorted(VALUE_LIMITS, values.astype(np.uint64), side="right").astype(np.uint8)
    padded = np.zeros(-(-len(values) // 4) * 4, dtype=np.uint8)
    padded[: len(code)] = code
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    octets = values.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.astype(np.uint8).tobytes(), octets[np.arange(4) <= code[:, None]].tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """Inverse of ``pack`` for ``count`` values."""
    lengths = length_table()[np.frombuffer(control, dtype=np.uint8)].reshape(-1)[:count]
    ends = np.cumsum(lengths)
    raw = np.concatenate((np.frombuffer(data, dtype=np.uint8), np.zeros(3, np.uint8))).astype(np.uint32)
    begin = ends - lengths
    out = np.zeros(count, dtype=np.uint32)
    for k in range(4):
        out |= np.where(lengths > k, raw[np.minimum(begin + k, len(raw) - 1)], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def block_bytes_of(doc_ids: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack(ranks)
    head = MAGIC + np.array([len(doc_ids), len(ranks)], dtype="<u8").tobytes()
    return head + doc_ids.astype("<i8").tobytes() + counts.astype("<u4").tobytes() + control + data


def read_block(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document ids, id counts, ranks) of a block file."""
    if raw[:4] != MAGIC:
        raise ValueError("not a token block")
    docs, ids = (int(x) for x in np.frombuffer(raw, "<u8", 2, 4))
    at = 20
    doc_ids = np.frombuffer(raw, "<i8", docs, at)
    counts = np.frombuffer(raw, "<u4", docs, at + 8 * docs)
    at += 12 * docs
    stop = at + -(-ids // 4)
    return doc_ids, counts, unpack(raw[at:stop], raw[stop:], ids)


def open_folder(uri: str):
    """(file system, path) of a folder URI; a plain path is a local one."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if ":/" in uri else (fs.LocalFileSystem(), uri)


def _encoded_blocks(docs: DataFrame, vocab: str, end_id: int, block_bytes: int) -> DataFrame:
    """Blocks of consecutive documents with raw ids; ``docs`` arrives sorted."""

    def blocks(batches):
        from pyspark import TaskContext

        shard, number = TaskContext.get().partitionId(), 0
        coder = encoder(vocab)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def flush():
            doc, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([number], pa.int32()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([doc.astype("<i8").tobytes()], pa.binary()),
                    pa.array([counts.astype("<u4").tobytes()], pa.binary()),
                    pa.array([ids.astype("<u2" if wide == 2 else "<u4").tobytes()], pa.binary()),
                ],
                names=["shard", "block", "n_ids", "docs", "counts", "ids"],
            )

        wide = 2 if max(coder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            for row, ids, bounds in coder.chunks(batch.column(1)):
                n = len(bounds) - 1
                held.append((doc[row : row + n], np.diff(bounds) + 1, np.insert(ids, bounds[1:], end_id)))
                size += 4 * len(ids)
                if size >= block_bytes:
                    yield flush()
                    held, size, number = [], 0, number + 1
        if held:
            yield flush()

    return docs.mapInArrow(blocks, "shard int, block int, n_ids bigint, docs binary, counts binary, ids binary")


def _id_counts(blocks: DataFrame, wide: str) -> list[tuple[int, int]]:
    """(id, count) over the corpus; as many rows as the vocabulary has ids."""

    def count(batches):
        for batch in batches:
            for raw in batch.column(0):
                found = np.bincount(np.frombuffer(raw.as_buffer(), dtype=wide))
                ids = np.flatnonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found[ids])], names=["id", "n"])

    rows = blocks.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return [(r["id"], r["n"]) for r in rows.collect()]


def write_token_files(
    docs: DataFrame,
    vocab: str,
    folder: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = 16_000_000,
) -> DataFrame:
    """Encode ``docs`` and write the dataset; returns one row per block
    (shard, block, n_ids, first: ids of all blocks before it).

    Defined cases: a null or empty text is its end id alone; null ids come
    first and are stored as the smallest 64-bit integer; equal ids are
    ordered by text; repeated rows are stored as often as they come; an empty
    table gives no block; other columns are ignored."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = own.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered = ordered.withColumn("doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))))
    blocks = cut(_encoded_blocks(ordered, vocab, end_id, block_bytes), "blocks")
    size = max(Tokenizer.from_file(vocab).get_vocab_size(), end_id + 1)
    wide = "<u2" if size <= 1 << 16 else "<u4"
    counts = sorted(_id_counts(blocks, wide), key=lambda x: (-x[1], x[0]))
    order = np.array([x[0] for x in counts], dtype=np.int64)
    rank_of = np.zeros(size, dtype=np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    store, path = open_folder(folder)
    store.create_dir(path)
    with store.open_output_stream(f"{path}/ranks.bin") as out:
        out.write(order.astype("<u4").tobytes())

    def write(batches):
        store, path = open_folder(folder)
        for batch in batches:
            for shard, block, n, doc, counts, ids in zip(*batch.columns, strict=True):
                raw = block_bytes_of(
                    np.frombuffer(doc.as_buffer(), "<i8"),
                    np.frombuffer(counts.as_buffer(), "<u4"),
                    rank_of[np.frombuffer(ids.as_buffer(), dtype=wide)],
                )
                name = f"{path}/{block_name(shard.as_py(), block.as_py())}"
                part = f"{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(part) as out:
                    out.write(raw)
                store.move(part, name)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.as_py()], pa.int32()), pa.array([block.as_py()], pa.int32()), pa.array([n.as_py()])],
                    names=["shard", "block", "n_ids"],
                )

    index = cut(blocks.mapInArrow(write, "shard int, block int, n_ids bigint"), "index")
    return block_starts(index)


def block_name(shard: int, block: int) -> str:
    return f"part-{shard:06d}-{block:06d}.qtok"


def block_starts(index: DataFrame) -> DataFrame:
    """Adds ``first``: a running sum within a shard, plus the totals of the
    shards before it (one number per shard on the driver)."""
    from pyspark.sql import Window

    totals = {r["shard"]: r["n"] for r in index.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    run, rows = 0, []
    for shard in sorted(totals):
        rows.append((shard, run))
        run += totals[shard]
    base = index.sparkSession.createDataFrame(rows, "shard int, base bigint")
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summed = index.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return summed.join(F.broadcast(base), "shard").select("shard", "block", "n_ids", (F.col("base") + F.col("inside")).alias("first"))


def read_token_files(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids before it), n_tokens and
    ids_crc32 over its ids as little-endian u32."""

    def decode(batches):
        store, path = open_folder(folder)
        with store.open_input_stream(f"{path}/ranks.bin") as file:
            id_of = np.frombuffer(file.read(), dtype="<u4")
        for batch in batches:
            for shard, block, first in zip(*batch.columns, strict=True):
                with store.open_input_stream(f"{path}/{block_name(shard.as_py(), block.as_py())}") as file:
                    doc_ids, counts, ranks = read_block(file.read())
                ids = id_of[ranks].astype("<u4")
                ends = np.cumsum(counts, dtype=np.int64)
                begins = ends - counts
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids), pa.array(begins + first.as_py()), pa.array(counts.astype(np.int64)), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = index.select("shard", "block", "first").repartition(
        max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "shard", "block"
    )
    rows = spread.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.withColumn("doc_id", F.when(F.col("doc_id") == -(1 << 63), None).otherwise(F.col("doc_id")))


def token_folder(spark: SparkSession) -> str:
    """A fresh dataset folder under the shared checkpoint folder."""
    return scratch_path(spark, "token-files")
