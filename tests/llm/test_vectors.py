import math
import random

import duckdb
import numpy as np

from quillstream.llm import vector_cells as vc
from quillstream.llm.catalog import ORACLES, QUERIES
from tests.conftest import MEDIUM

NAME = "op13_vector_cells"
SCHEMA = "vec_id long, embedding array<double>, label int"


def usable(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows):
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    links = [0] * len(rows)
    fit = [i for i, r in enumerate(rows) if usable(r[1])]
    for k, i in enumerate(fit):
        for j in fit[:k]:
            if len(rows[i][1]) == len(rows[j][1]) and vc.exact_cosine(np.array(rows[i][1], float), np.array(rows[j][1], float)) >= 0.9:
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                group[b] = a
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[root(i)] = min(r[0], ids.get(root(i), r[0]))
    out = [(r[0], links[i], ids.get(root(i)), r[0] is not None and r[0] == ids.get(root(i))) for i, r in enumerate(rows)]
    return sorted(out, key=repr)


def found(spark, rows, schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema).repartition(3)
    return sorted((tuple(r) for r in vc.embedding_components(df, **kw).collect()), key=repr)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{MEDIUM}/embeddings.parquet')")
    cursor = con.execute(ORACLES[NAME])
    df = QUERIES[NAME](spark, MEDIUM)
    assert df.columns == [d[0] for d in cursor.description]
    assert sorted(tuple(r) for r in df.collect()) == sorted(cursor.fetchall())


def test_edge_rows(spark):
    """Unusable vectors, equal ones, scaled ones, other lengths, null and
    repeated ids, a pair at the threshold."""
    nan, inf = float("nan"), float("inf")
    side = math.sqrt(1 - 0.81)
    rows = [
        (1, None, 0), (2, [], 0), (3, [0.0, 0.0, -0.0], 0), (4, [1.0, None, 0.0], 0), (5, [nan, 1.0, 0.0], 0), (6, [inf, 1.0, 0.0], 0),
        (7, [1.0, 0.0, 0.0], 0), (8, [1.0, 0.0, 0.0], 1), (9, [1e300, 0.0, -0.0], 1), (10, [1e-300, 0.0, 0.0], 1),
        (11, [0.9, side, 0.0], 2), (12, [0.0, 1.0], 2), (13, [0.0, 2.0], 2), (14, [-1.0, 0.0, 0.0], 2),
        (None, [0.0, 0.0, 1.0], 3), (None, [0.0, 0.1, 1.0], 3), (None, [0.0, 0.0, 5.0, 1.0], 3), (20, [0.0, 0.2, 1.0], 3),
        (21, [0.0, 1.0, 0.0], 4), (21, [0.0, 0.0, -1.0], 4), (21, [0.0, 0.0, -1.0], 4), (-7, [0.0, 0.01, -1.0], 4),
    ]
    assert found(spark, rows) == brute(rows)


def cloud(seed=2):
    """Tight groups, a wide group, a chain, copies and a background."""
    rng = np.random.default_rng(seed)
    rows = [rng.normal(size=16) for _ in range(150)]
    for spread, n in ((0.05, 90), (0.12, 60), (0.02, 30)):
        centre = rng.normal(size=16)
        rows += [centre / np.linalg.norm(centre) + spread * rng.normal(size=16) for _ in range(n)]
    a, b = rng.normal(size=16), rng.normal(size=16)
    rows += [a + t * b for t in np.linspace(0, 2, 25)]
    rows += [rows[160]] * 40
    ids = list(range(len(rows)))
    random.Random(seed).shuffle(ids)
    return [(i, r.tolist(), 0) for i, r in zip(ids, rows, strict=True)]


def test_cells_chunks_and_cores(spark, monkeypatch):
    rows = cloud()
    expected = brute(rows)
    assert len({r[2] for r in expected}) < 220
    for cell_rows, chunk in ((50_000, 4096), (40, 4096), (100, 25)):
        # small chunks: the operator's own size only grows with the table
        place = vc.Chunks.__init__
        monkeypatch.setattr(vc.Chunks, "__init__", lambda self, f, lay, _, p=place, c=chunk: p(self, f, lay, c))
        assert found(spark, rows, cell_rows=cell_rows) == expected
        monkeypatch.undo()
    assert found(spark, rows, sample_rows=1) == expected


def test_replication_keeps_every_pair():
    """Property: linked vectors meet in the chunk of one of them, once,
    unless both lie in the core of one pivot."""
    x = vc.normalised(np.array([r[1] for r in cloud(4)]))
    layout = vc.Layout({16: vc.choose_pivots(x[::3], 0.9, 6)}, 0.9)
    home, core, distance = layout.homes(x)
    figures = []
    for p, c in sorted(set(zip(home.tolist(), core.tolist(), strict=True))):
        own = distance[(home == p) & (core == c), p]
        figures.append({"dim": 16, "pivot": p, "core": c, "n": len(own), "near": own.min(), "far": own.max(), "w": len(own), "least": ""})
    chunks = vc.Chunks(figures, layout, 20)
    own, rows, where = chunks.place(x, np.arange(len(x)))
    visits = set(zip(rows.tolist(), where.tolist(), strict=True))
    for i, j in np.argwhere(np.triu(x @ x.T >= 0.9, 1)):
        met = (own[i] == own[j]) + ((i, own[j]) in visits) + ((j, own[i]) in visits)
        assert met == 1 or (core[i] and core[j] and home[i] == home[j])
    assert core.sum() > 100 and len(visits) < len(x) * (chunks.total - 1)


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    rows = cloud()[:40]
    schema = SCHEMA + ", digest string, vertex string, w int, v string, component_id long, n_links string"
    assert found(spark, [(*r, "d", "x", 1, "v", 2, "n") for r in rows], schema) == brute(rows)
