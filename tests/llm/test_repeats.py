import hashlib
import random

import numpy as np
import pyarrow as pa

from quillstream.llm import repeats
from quillstream.llm.catalog import QUERIES
from tests.conftest import SMALL
from tests.llm.cases import edge_frame, edge_rows, empty_frame, prose


def brute(rows):
    """Rows of the report for (doc_id, text) rows with ids."""
    first = {}
    for i, text in rows:
        raw = (text or "").encode()
        for x in range(len(raw) - 49):
            w = raw[x : x + 50]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for x in range(len(raw) - 49):
            if first[raw[x : x + 50]] < i:
                gone[x : x + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_query_on_the_small_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    df = QUERIES["op5_repeats"](spark, SMALL)
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(tuple(r) for r in df.collect()) == brute(docs)


def test_edge_rows(spark):
    rows = edge_rows()
    got = [tuple(r) for r in repeats.repeat_report(edge_frame(spark)).collect()]
    assert sorted(r for r in got if r[0] is not None) == brute([r for r in rows if r[0] is not None])
    nameless = [r for r in got if r[0] is None]
    assert [(r[2], r[3]) for r in nameless] == [(0, 0)]


def test_empty_table(spark):
    assert repeats.repeat_report(empty_frame(spark)).count() == 0


def periodic_rows():
    rng = random.Random(5)
    passage = prose(9, 40)
    rows = [(i, prose(20 + i, 30) + passage[: rng.randint(30, len(passage))] + prose(60 + i, 20)) for i in range(30)]
    rows += [(100, "ab" * 60), (101, "ba" * 40), (102, "a" * 49), (103, "a" * 50), (104, "a" * 120), (105, "ab" * 25 + "c")]
    rows += [(200, "é" * 40), (201, "xé" + "é" * 30), (202, "")]
    return rows


def test_passages_periodic_texts_and_window_borders(spark):
    df = spark.createDataFrame(periodic_rows(), "doc_id long, text string")
    assert sorted(tuple(r) for r in repeats.repeat_report(df).collect()) == brute(periodic_rows())


def test_large_trigger_classes_take_the_aggregate_path(spark):
    docs = repeats.with_class(spark.createDataFrame(periodic_rows(), "doc_id long, text string"))
    heads = repeats.text_heads(docs)
    one, two = (
        {r["doc_id"]: sorted(map(tuple, r["spans"])) for r in repeats.repeated_spans(docs, heads, max_class=m).collect()}
        for m in (20_000, 1)
    )
    assert one == two


def test_every_window_lies_in_one_phrase_and_long_texts_are_cut(monkeypatch):
    texts = ["", "x" * 49, "y" * 50, "z" * 300, prose(1, 2000), "ab" * 500]
    whole = [(f.key.tolist(), f.place.tolist()) for *_, f, _ in repeats._phrases(pa.array(texts))]
    for *_, f, bounds in repeats._phrases(pa.array(texts)):
        for i in range(len(bounds) - 1):
            cover = np.zeros(max(bounds[i + 1] - bounds[i] - 49, 0), dtype=int)
            for k in np.flatnonzero(f.text == i):
                cover[f.start[k] - bounds[i] : f.end[k] - 49 - bounds[i]] += 1
            assert (cover == 1).all()
    monkeypatch.setattr(repeats, "SEGMENT", 700)
    cut = [k for *_, f, _ in repeats._phrases(pa.array(texts)) for k in f.key.tolist()]
    assert set(cut) == {k for keys, _ in whole for k in keys}


def test_remove_repeats_changes_the_text_only(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    docs = edge_frame(spark).where("doc_id is not null")
    out = repeats.remove_repeats(docs)
    assert out.columns == docs.columns
    got = sorted((r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in out.where("doc_id != 9").collect())
    assert got == sorted((r[0], r[4]) for r in brute(rows) if r[0] != 9)
    assert out.where("cls != -2 or range != -4").count() == 0
