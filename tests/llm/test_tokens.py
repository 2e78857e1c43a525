import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillstream.llm import genetic_packing, token_files
from quillstream.llm.catalog import QUERIES, vocabulary
from quillstream.llm.piece_cache import PieceEncoder
from tests.conftest import SMALL
from tests.llm.cases import edge_frame, edge_rows, empty_frame

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ENCODER = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abS'stredmvlé½3٣ \t\n\r\x85 .,#-’日本🎉<|>endoftx\x00")), max_size=40), max_size=6))
def test_pieces_equal_the_library(texts):
    got = [ids[a:b].tolist() for _, ids, bounds in ENCODER.chunks(pa.array(texts, pa.string())) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == [ids_of(t) for t in texts]


def test_pieces_with_special_strings_and_other_vocabularies():
    texts = ["a <|endoftext|> b", "plain", None, "it's 'tis ''s 're"]
    got = [ids[a:b].tolist() for _, ids, bounds in ENCODER.chunks(pa.array(texts)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == [ids_of(t) for t in texts]
    path = public_tokenizers.path("word_bpe_49k.json")
    other = PieceEncoder(path)
    assert not other.by_piece
    (_, ids, bounds), = other.chunks(pa.array(["Hello World", ""]))
    assert ids.tolist() == Tokenizer.from_file(path).encode("Hello World", add_special_tokens=False).ids and bounds.tolist()[1:] == [len(ids)] * 2


def test_the_table_of_pieces_starts_anew_when_full(monkeypatch):
    from quillstream.llm import piece_cache

    monkeypatch.setattr(piece_cache, "MAX_PIECES", 5)
    coder = PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ("one two three four", "five six seven", "one two nine ten"):
        (_, ids, _), = coder.chunks(pa.array([text]))
        assert ids.tolist() == ids_of(text)


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=70))
def test_control_byte_code_round_trip(values):
    control, data = token_files.pack(np.array(values, dtype=np.uint32))
    assert len(control) == -(-len(values) // 4)
    assert token_files.unpack(control, data, len(values)).tolist() == values


def expected_rows(rows):
    start, out = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(text) + [2]
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def test_token_file_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    df = QUERIES["op3_token_files"](spark, SMALL)
    assert sorted(tuple(r) for r in df.collect()) == sorted(expected_rows(rows))


@pytest.mark.parametrize("block_bytes", [2_000, 16_000_000])
def test_token_files_of_edge_rows(spark, block_bytes):
    folder = token_files.token_folder(spark)
    index = token_files.write_token_files(edge_frame(spark), vocabulary(), folder, block_bytes=block_bytes)
    got = sorted(map(tuple, token_files.read_token_files(spark, folder, index).collect()), key=lambda r: r[1])
    want = expected_rows(edge_rows())
    assert [r[1:] for r in got] == [r[1:] for r in want] and [r[0] for r in got] == [r[0] for r in want]


def test_token_files_of_an_empty_table(spark):
    folder = token_files.token_folder(spark)
    index = token_files.write_token_files(empty_frame(spark), vocabulary(), folder)
    assert token_files.read_token_files(spark, folder, index).count() == 0


def check_packing(rows, packed, capacity):
    pieces, sequences = [], {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.append((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = []
    for i, text in rows:
        ids = ids_of(text) + [0]
        start, length, piece = 0, len(ids) % capacity or capacity, 0
        while start < len(ids):
            want.append((i, piece, start, length, crc(ids[start : start + length])))
            start, length, piece = start + length, capacity, piece + 1
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(pieces, key=key) == sorted(want, key=key)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), -(-sum(p[3] for p in pieces) // capacity)


def test_packing_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    used, bound = check_packing(rows, QUERIES["op10_genetic_packing"](spark, SMALL).collect(), 2048)
    assert used <= bound + 1


def test_packing_of_edge_rows_and_small_shards(spark):
    for search in ({}, {"shard_pieces": 8, "islands": 3, "slack": 2}):
        packed = genetic_packing.pack_documents(edge_frame(spark), vocabulary(), capacity=256, **search).collect()
        used, bound = check_packing(edge_rows(), packed, 256)
        assert used <= bound + 3


def test_packing_of_an_empty_table(spark):
    assert genetic_packing.pack_documents(empty_frame(spark), vocabulary()).count() == 0


def test_crossover_keeps_every_piece_and_the_capacity():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 100, 400)
    a = genetic_packing.best_fit(sizes, np.argsort(-sizes), 100)
    b = genetic_packing.best_fit(sizes, rng.permutation(400), 100)
    for _ in range(20):
        child = genetic_packing.cross(sizes, a, b, 100, rng)
        assert (np.bincount(child, weights=sizes) <= 100).all() and len(child) == 400
    best = genetic_packing.evolve(sizes, [a, b], 100, rng, 6, 30)[0]
    assert genetic_packing.fitness(sizes, best, 100)[0] <= min(genetic_packing.fitness(sizes, s, 100)[0] for s in (a, b))
