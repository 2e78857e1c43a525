import hashlib
import zlib

import duckdb

from quillstream.llm import merkle_manifest as mm
from quillstream.llm.catalog import ORACLES, QUERIES
from tests.conftest import MEDIUM

NAME = "op12_merkle_manifest"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, lower=False):
    i, text, lang, source, n = row
    if lower and text is not None:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return digest("".join(part(v) for v in (i, source, lang, n, text)))


def climb(nodes):
    """(last node, siblings of each first node as [(left, right), ...])."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 16] for k in range(0, len(nodes), 16)]
        for leaf_no, k in enumerate(at):
            run = runs[k // 16]
            paths[leaf_no].append(("".join(run[: k % 16]), "".join(run[k % 16 + 1 :])))
        nodes, at = [digest("".join(r)) for r in runs], [k // 16 for k in at]
    return nodes[0], paths


def brute(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[3], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in order}
    trees = {s: climb([leaf(r) for r in own[s]]) for s in order}
    root, over = climb([trees[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for row, path in zip(own[s], trees[s][1], strict=True):
            path = path + over[k]
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = leaf(row, lower=hit)
            for left, right in path:
                folded = digest(left + folded + right)
            out.append((row[0], leaf(row), trees[s][0], root, digest("".join(a + b for a, b in path)), folded, folded == root))
    return sorted(out, key=repr)


def found(spark, rows, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema)
    return sorted((tuple(r) for r in mm.merkle_manifest(df, tampered=mm.lowered_leaf()).collect()), key=repr)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{MEDIUM}/documents.parquet')")
    cursor = con.execute(ORACLES[NAME])
    df = QUERIES[NAME](spark, MEDIUM)
    assert df.columns == [d[0] for d in cursor.description]
    assert sorted(tuple(r) for r in df.collect()) == sorted(cursor.fetchall())


def edge_rows():
    rows = [
        (None, "Null ID", "en", "a", 7), (None, None, None, None, None), (3, "", "en", "", 0), (3, "", "en", "", 0),
        (5, "ABC é 日本 🎉", "en", "a", None), (10, "x" * 300_000, "de", "b", 300_000), (-4, "MINUS", None, "Ä", 5),
    ]
    rows += [(i, f"Text {i}", "en", "hot", 6) for i in range(300)]
    rows += [(1000 + i, "One Each", "fr", f"s{i}", 8) for i in range(20)]
    return rows


def test_edge_rows(spark):
    """Null ids and sources, equal rows, lone leaves, more than 16 sources."""
    assert found(spark, edge_rows()) == brute(edge_rows())


def test_a_source_of_many_blocks(spark):
    """5,000 leaves end in two blocks, whose digests form a run above."""
    rows = [(i, f"T{i}", "en", "hot", 3) for i in range(5000)] + [(i, "x", "en", "b", 1) for i in range(17)]
    assert found(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    rows = edge_rows()[:30]
    schema = SCHEMA + ", tree string, node string, pos int, block int, leaf string, entries string"
    assert found(spark, [(*r, "t", "n", 1, 2, "l", "e") for r in rows], schema) == brute(rows)


def test_without_tampering_every_row_is_verified(spark):
    rows = mm.merkle_manifest(spark.createDataFrame(edge_rows(), SCHEMA)).collect()
    assert len(rows) == len(edge_rows()) and all(r["verified"] for r in rows)
