"""Quality forest, fingerprints, SentencePiece codec and URL rules."""

import hashlib
import re
import struct
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from quillstream.llm import chunk_prints, piece_models, quality_forest, url_digests
from quillstream.llm.arrow_text import SpanHasher
from quillstream.llm.catalog import ORACLES, QUERIES, vocabulary
from tests.conftest import MEDIUM, SMALL
from tests.llm.cases import edge_frame, edge_rows, empty_frame, prose

# --- quality -----------------------------------------------------------------


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = Counter(zip(words, words[1:], words[2:]))  # noqa: B905 - of unequal length on purpose
    repeated = {k + d for k in range(len(words) - 2) if triples[tuple(words[k : k + 3])] > 1 for d in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated)


def test_statistics_equal_a_plain_count(spark):
    texts = [t for _, t in edge_rows()] + ["a b a b a b", "x\nx\n \nx y\nx y\r\n", "to to to to", "#$% a|b <c> é & *"]
    texts += [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    stats = quality_forest.rule_statistics(pa.array(texts, pa.string()))
    got = list(zip(*(stats[c].tolist() for c in quality_forest.BASE), strict=True))
    assert got == [brute_statistics(t) for t in texts]


def test_quality_query_and_held_out_accuracy(spark):
    df = QUERIES["op8_quality_forest"](spark, MEDIUM)
    rows = {r["doc_id"]: r for r in df.collect()}
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    for r in rows.values():
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    forest = quality_forest.fit_forest(docs, labels.where("doc_id % 2 = 0"))
    judged = {r["doc_id"]: r for r in quality_forest.score_quality(docs, forest).collect()}
    held = [(judged[r["doc_id"]], r["quality"]) for r in labels.where("doc_id % 2 = 1").collect()]
    good = [j["kept"] for j, q in held if q and not j["base_failed"]]
    bad = [j["kept"] for j, q in held if not q and not j["base_failed"]]
    assert np.mean(good) > 0.97 and np.mean(bad) < 0.15


def test_quality_edge_cases(spark):
    docs = edge_frame(spark)
    for labels in (spark.createDataFrame([], "doc_id long, quality int"), spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")):
        forest = quality_forest.fit_forest(docs, labels)
        rows = quality_forest.score_quality(docs, forest).collect()
        assert len(rows) == len(edge_rows()) and all(r["kept"] != r["base_failed"] for r in rows)
        kept = quality_forest.filter_quality(docs, forest)
        assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in rows)
    assert quality_forest.score_quality(empty_frame(spark), None).count() == 0


# --- fingerprints ------------------------------------------------------------


def brute_prints(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    hasher, out = SpanHasher(seed=9), []
    for k, (i, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = (chunk_prints.fingerprints([t.encode()], hasher)[0] for t in (text, edited, after))
        near = (chunk_prints.containment(a, b), chunk_prints.containment(a, c))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), chunk_prints.written(a), chunk_prints.written(b), *near))
    return Counter(out)


def test_fingerprint_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op9_chunk_prints"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == brute_prints(rows)
    long = [r for r in got if r["n_chars"] > 400]
    assert np.median([r["near_edited"] for r in long]) > 0.65


def test_fingerprints_of_edge_rows(spark):
    assert Counter(map(tuple, chunk_prints.fingerprint_documents(edge_frame(spark)).collect())) == brute_prints(edge_rows())
    assert chunk_prints.fingerprint_documents(empty_frame(spark)).count() == 0
    one = spark.createDataFrame([(5, prose(1, 60))], "doc_id long, text string")
    assert [r["near_next"] for r in chunk_prints.fingerprint_documents(one).collect()] == [1.0]


def test_chunks_do_not_depend_on_what_stands_before():
    text, hasher = prose(3, 400).encode(), SpanHasher(seed=9)
    whole = chunk_prints.fingerprints([text], hasher)[0]
    assert chunk_prints.fingerprints([b"zz", text, b"", text], hasher)[1] == whole
    shifted = chunk_prints.fingerprints([b"some words in front " + text], hasher)[0]
    assert chunk_prints.containment(whole, shifted) > 0.9
    assert chunk_prints.parsed(chunk_prints.written(whole)) == whole
    assert all(n <= chunk_prints.MAX for n in chunk_prints.fingerprints([b"a" * 5000], hasher)[0].values())


# --- SentencePiece -----------------------------------------------------------


def test_piece_query_has_parity_on_every_row(spark):
    df = QUERIES["op2_piece_models"](spark, SMALL)
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    reference = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    rows = df.collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = reference.encode(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_crc32"]) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r["decoded_sha256"] == hashlib.sha256(reference.decode(ids).encode()).hexdigest()
        assert r["parity"] and r["round_trip"]


def test_pieces_of_awkward_texts(spark):
    path = vocabulary("piece_bpe_32k.model")
    reference = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", " ", "  a", "a  b   c", " " * 40 + "x", " " * 17, "a" + " " * 33 + "b", "日本語 🎉 \x00\x01", "<s> </s> <unk> <0x41>", "t\tn\n\n x", "▁▁ x ▁", "x" * 3000]
    coder = piece_models.PieceCodec(path)
    ids, bounds = coder.encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == reference.encode(texts)
    assert coder.decode(ids.astype(np.int64), bounds) == [coder.core.decode(x, skip_special_tokens=False) for x in got]
    broken = np.array([3 + 0xE3, 3 + 0x41], dtype=np.int64)  # a lone lead byte
    assert coder.decode(broken, np.array([0, 2])) == [coder.core.decode(broken.tolist(), skip_special_tokens=False)]
    frame = edge_frame(spark)
    coded = piece_models.encode_pieces(frame, path)
    back = piece_models.decode_pieces(coded, path)
    assert Counter(map(tuple, back.collect())) == Counter((i, t or "") for i, t in edge_rows())
    assert piece_models.check_pieces(empty_frame(spark), path).count() == 0


def message(*pairs):
    """Protobuf bytes of (field, value) pairs."""

    def varint(n):
        out = b""
        while n > 0x7F:
            out, n = out + bytes([n & 0x7F | 0x80]), n >> 7
        return out + bytes([n])

    out = b""
    for number, value in pairs:
        if isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += varint(number << 3) + varint(value)
        else:
            out += varint(number << 3 | 2) + varint(len(value)) + value
    return out


@pytest.mark.parametrize("remove_extra", [0, 1])
def test_unigram_model_written_by_hand(tmp_path, remove_extra):
    """A unigram model with byte fallback, byte by byte; the scores decide
    between splits as sentencepiece decides."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    for i, p in enumerate(["▁", "a", "b", "c", "ab", "bc", "▁ab", "▁a", "abc", "▁c", "ca", "é"]):
        pieces.append((p, -1.0 - 0.37 * i, 1))
    trainer = message((3, 1), (4, len(pieces)), (35, 1), (40, 0), (41, 1), (42, 2))
    normalizer = message((1, b"identity"), (2, b""), (3, 1), (4, remove_extra), (5, 1))
    raw = message(*((1, message((1, p.encode()), (2, s), (3, k))) for p, s, k in pieces), (2, trainer), (3, normalizer))
    path = tmp_path / "unigram.model"
    path.write_bytes(raw)
    reference = sentencepiece.SentencePieceProcessor(model_file=str(path))
    coder = piece_models.PieceCodec(str(path))
    texts = ["abc", "ab cab abcabc", " a  b ", "", "é日a", "cabcabbca abc"]
    ids, bounds = coder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == reference.encode(texts)


# --- URL rules ---------------------------------------------------------------


def test_url_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SMALL}/pages.parquet')")
    got = QUERIES["op7_url_digests"](spark, SMALL).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.execute(ORACLES["op7_url_digests"]).fetchall()))


def test_url_rules_on_awkward_urls(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("b.c", "", "block"), ("c", "/é", "allow"), ("c", "/é", "block"), (None, "/", "block")]
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    urls = [
        (1, "http://A.Example.ORG/es/x?y", "example.org/es/", "block"),
        (2, "http://example.org/es", "org/", "allow"),
        (3, "http://notexample.org.evil/es/", None, "allow"),
        (4, "http://xorg/", None, "allow"),
        (5, None, None, "allow"),
        (6, "no scheme/es/", None, "allow"),
        (7, "x://a.b.c", "b.c", "block"),
        (8, "x://a.b.c/é/ü#f", "b.c", "block"),
        (9, "x://c/é", "c/é", "block"),
        (10, "x:///path", None, "allow"),
        (None, "http://org/", "org/", "allow"),
        (11, "http://org?q", None, "allow"),
    ]
    for shards in (1, 3):
        store = url_digests.write_store(frame, shards=shards)
        pages = spark.createDataFrame([(i, u, "h", "r") for i, u, _, _ in urls], "page_id long, url string, host string, rule string")
        got = {(r["page_id"], r["rule"], r["verdict"]) for r in url_digests.judge_urls(pages, store).collect()}
        assert got == {(i, r, v) for i, _, r, v in urls}
        assert url_digests.judge_urls(pages.limit(0), store).count() == 0
    nothing = url_digests.write_store(frame.limit(0))
    assert {r["verdict"] for r in url_digests.judge_urls(pages, nothing, default="block").collect()} == {"block"}


def test_equal_digests_are_told_apart_by_the_string(tmp_path):
    path = tmp_path / "one.qda"
    path.write_bytes(url_digests.shard_bytes([("a.b", "/x", "block"), ("c.d", "/", "allow")]))
    shard = url_digests.Shard(str(path))
    key = shard.keys[:1].astype(np.uint64)
    text = shard.texts[int(shard.bounds[0]) : int(shard.bounds[1])].tobytes()
    assert shard.find(np.concatenate((key, key)), [text, b"other string"]).tolist() == [0, -1]
