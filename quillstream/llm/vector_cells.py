"""Exact metric range join of embeddings (operator 13).

Cosine >= t is a distance of at most r = sqrt(2 - 2 t) between unit vectors.
Pivots partition the vectors: each lives in the *cell* of its nearest pivot.
If u and v are within r, the triangle inequality gives for the cell of u,
with pivot q and home distances from ``near`` to ``far``,

    d(v, q) - r <= far   and   d(v, q) + r >= near   and
    d(v, q) - d(v, own pivot) <= 2 r.

A vector is replicated to the cells that pass all three, and to no other;
each cell then joins its own vectors, and its own with its visitors, by
blocks of matrix products, independently of all other cells.  Of two cells
only one is visited by the other's vectors, so a pair is met once.

Hot cells.  Equal vectors become one class with a weight first.  Within r/2
of a pivot all vectors are linked with each other, which is known without a
comparison: these *cores* are cells of their own (a tight group of a third
of all rows costs one pass), and only the shell around them is compared.  A
cell beyond ``chunk`` vectors is dealt over chunks, which count as cells that
share a pivot.

Output is counts per vector and a spanning forest of the links in each
chunk, never the links themselves.
"""

from __future__ import annotations

import hashlib
import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.components import connected_components
from quillstream.llm.scratch import cut

#: Slack of a distance computed in double precision near zero (its square is
#: exact to some 1e-15).
SLACK = 1e-7
#: Added to ids so that their digits sort like the numbers.
SHIFT = Decimal(1 << 63)


def unit_rows(column: pa.Array) -> list[np.ndarray | None]:
    """Each usable vector as float64; None for null, empty or zero ones and
    those with a null or non-finite component."""
    out = []
    for value in column:
        own = None
        if value.is_valid and value.values is not None and not value.values.null_count:
            own = np.asarray(value.values.to_numpy(zero_copy_only=False), dtype=np.float64) + 0.0
            if not len(own) or not np.isfinite(own).all() or not own.any():
                own = None
        out.append(own)
    return out


def normalised(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine of two vectors with correctly rounded sums."""
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    dot, na, nb = (math.fsum((x * y).tolist()) for x, y in ((a, b), (a, a), (b, b)))
    return dot / math.sqrt(na * nb)


def linked(a: np.ndarray, b: np.ndarray, raw_a: np.ndarray, raw_b: np.ndarray, threshold: float) -> np.ndarray:
    """Boolean matrix of cosine >= threshold; entries that rounding could
    turn are computed again with exact sums."""
    cosine = a @ b.T
    hit = cosine >= threshold
    for i, j in np.argwhere(np.abs(cosine - threshold) < 1e-12):
        hit[i, j] = exact_cosine(raw_a[i], raw_b[j]) >= threshold
    return hit


def choose_pivots(sample: np.ndarray, threshold: float, cells: int) -> np.ndarray:
    """Pivots from a sample of unit vectors: the centres of its dense groups
    (at least three vectors within r/2 of a centre), then vectors far from
    all pivots so far until there are ``cells``."""
    radius = math.sqrt(2 - 2 * threshold)
    close = np.array([(row >= threshold).sum() for row in sample @ sample.T])
    pivots: list[np.ndarray] = []
    for i in np.argsort(-close, kind="stable"):
        if close[i] < 3:
            break
        if pivots and (np.array(pivots) @ sample[i] >= 1 - radius**2 / 8).any():
            continue
        group = sample[sample @ sample[i] >= threshold]
        centre = group.mean(axis=0)
        centre /= np.sqrt((centre * centre).sum())
        if (sample @ centre >= 1 - radius**2 / 8).sum() >= 3 and not (pivots and (np.array(pivots) @ centre >= 1 - radius**2 / 8).any()):
            pivots.append(centre)
    nearest = (sample @ np.array(pivots).T).max(axis=1) if pivots else np.full(len(sample), -2.0)
    wanted = len(pivots) + cells
    while len(pivots) < min(wanted, len(sample)):
        i = int(nearest.argmin())
        if nearest[i] >= 1 - 1e-12:
            break
        pivots.append(sample[i])
        nearest = np.maximum(nearest, sample @ sample[i])
    return np.array(pivots)


class Union:
    """Disjoint sets over array indexes, joined in arrays of pairs."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def root(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            self.parent[x] = self.parent[up]
            x = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.root(a), self.root(b)
            apart = a != b
            a, b = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
            np.minimum.at(self.parent, b, a)


CLASSES = "digest binary, vec_id bigint, v array<double>"


def _marked(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Each row with the digest of its vector (null if unusable)."""

    def mark(batches):
        for batch in batches:
            own = unit_rows(batch.column(1))
            digests = [None if v is None else hashlib.blake2b(v.tobytes(), digest_size=16).digest() for v in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), batch.column(0), pa.array(own, pa.list_(pa.float64()))],
                names=["digest", "vec_id", "v"],
            )

    return rows.select(F.col(id_col).cast("long"), F.col(vector_col)).mapInArrow(mark, CLASSES)


def _vertex() -> Column:
    """Text that sorts by id (null last), then by digest: the least vertex of
    a component names its smallest id."""
    shifted = (F.col("vec_id").cast("decimal(20,0)") + F.lit(SHIFT)).cast("string")
    return F.concat(F.coalesce(F.lpad(shifted, 20, "0"), F.lit("~" * 20)), F.lower(F.hex("digest")))


class Layout:
    """Where vectors live: pivots by dimension, and the cells' figures."""

    def __init__(self, pivots: dict[int, np.ndarray], threshold: float) -> None:
        self.pivots, self.threshold = pivots, threshold
        self.radius = math.sqrt(2 - 2 * threshold)

    def homes(self, x: np.ndarray):
        """(pivot, is core, distances to all pivots) of unit rows of one
        dimension; a dimension without pivots is one cell."""
        pivots = self.pivots.get(x.shape[1])
        if pivots is None:
            return np.full(len(x), -1), np.zeros(len(x), dtype=bool), None
        distance = np.sqrt(np.maximum(0, 2 - 2 * (x @ pivots.T)))
        home = distance.argmin(axis=1)
        return home, distance[np.arange(len(x)), home] <= self.radius / 2 - SLACK, distance


HOMES = "dim int, pivot int, core boolean, vertex string, w bigint, distance double"


def _by_dimension(vectors: list):
    """(rows, matrix) per vector length of a batch."""
    sizes = np.array([len(v) for v in vectors])
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), rows, np.array([vectors[i] for i in rows], dtype=np.float64)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat, offsets = column.flatten().to_numpy(), column.offsets.to_numpy()
    return [flat[a - offsets[0] : b - offsets[0]] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _cell_figures(classes: DataFrame, layout: Layout) -> list:
    def homes(batches):
        for batch in batches:
            for size, rows, x in _by_dimension(_vectors(batch.column(2))):
                home, core, distance = layout.homes(normalised(x))
                own = np.zeros(len(rows)) if distance is None else distance[np.arange(len(rows)), home]
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), size), pa.int32()), pa.array(home, pa.int32()), pa.array(core), batch.column(0).take(take), batch.column(1).take(take), pa.array(own)],
                    names=["dim", "pivot", "core", "vertex", "w", "distance"],
                )

    found = classes.select("vertex", "w", "v").mapInArrow(homes, HOMES)
    return (
        found.groupBy("dim", "pivot", "core")
        .agg(F.count("*").alias("n"), F.sum("w").alias("w"), F.min("vertex").alias("least"), F.min("distance").alias("near"), F.max("distance").alias("far"))
        .collect()  # at most two rows a pivot
    )


class Chunks:
    """Numbers of the chunks of all cells, and who visits whom."""

    def __init__(self, figures: list, layout: Layout, chunk: int) -> None:
        self.layout, self.cells, at = layout, {}, 0
        for f in sorted(figures, key=lambda f: (f["dim"], f["pivot"], f["core"])):
            parts = max(1, math.ceil(f["n"] / chunk))
            self.cells[f["dim"], f["pivot"], f["core"]] = {"first": at, "parts": parts, "near": f["near"], "far": f["far"], "w": f["w"], "least": f["least"]}
            at += parts
        self.total = at

    def place(self, x: np.ndarray, salt: np.ndarray):
        """Per unit row of one dimension: its own chunk; and (rows, chunks)
        of all visits."""
        size, radius = x.shape[1], self.layout.radius
        home, core, distance = self.layout.homes(x)
        own = np.empty(len(x), dtype=np.int64)
        cells = [(pivot, c, f) for (dim, pivot, c), f in self.cells.items() if dim == size]
        for pivot, c, f in cells:
            rows = (home == pivot) & (core == c)
            own[rows] = f["first"] + salt[rows] % f["parts"]
        rows_out, chunks_out = [], []
        for pivot, c, f in cells:
            may = np.ones(len(x), dtype=bool)
            if distance is not None:
                to, mine = distance[:, pivot], distance[np.arange(len(x)), home]
                may = (to - radius <= f["far"] + SLACK) & (to + radius >= f["near"] - SLACK) & (to - mine <= 2 * radius + SLACK)
            if c:  # vectors of one core need no comparison
                may &= ~((home == pivot) & core)
            rows = np.flatnonzero(may)
            for k in range(f["first"], f["first"] + f["parts"]):
                # of two chunks the one that is visited alternates, so that none is visited by all
                ahead = (own[rows] < k) == ((own[rows] + k) % 2 == 0)
                visit = rows[(own[rows] != k) & ahead]
                rows_out.append(visit)
                chunks_out.append(np.full(len(visit), k))
        return own, np.concatenate(rows_out or [np.empty(0, int)]), np.concatenate(chunks_out or [np.empty(0, int)])


PLACED = "chunk int, visitor boolean, vertex string, w bigint, v array<double>"
FOUND = "vertex string, n bigint, other string"


def _placed(classes: DataFrame, chunks: Chunks) -> DataFrame:
    def place(batches):
        for batch in batches:
            for _, rows, x in _by_dimension(_vectors(batch.column(2))):
                vertices, weights = batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows))
                salt = np.array([int(s[-12:], 16) for s in vertices.to_pylist()])
                own, visits, where = chunks.place(normalised(x), salt)
                take = np.concatenate([np.arange(len(rows)), visits])
                number = np.concatenate([own, where])
                for a in range(0, len(take), 4096):
                    part = take[a : a + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(number[a : a + 4096], pa.int32()),
                            pa.array(np.arange(a, a + len(part)) >= len(rows)),
                            vertices.take(pa.array(part)),
                            weights.take(pa.array(part)),
                            pa.ListArray.from_arrays(np.arange(len(part) + 1, dtype=np.int32) * x.shape[1], x[part].ravel()),
                        ],
                        names=["chunk", "visitor", "vertex", "w", "v"],
                    )

    return classes.select("vertex", "w", "v").mapInArrow(place, PLACED)


class ChunkJoin:
    """The links of one chunk: its own vectors, then visitors in batches."""

    STEP = 1024

    def __init__(self, core: dict | None, threshold: float) -> None:
        self.core, self.threshold = core, threshold
        self.vertices, self.weights, self.raw = [], [], []
        self.ready = False

    def home(self, vertices: list, weights: np.ndarray, raw: np.ndarray) -> None:
        self.vertices += vertices
        self.weights.append(weights)
        self.raw.append(raw)

    def start(self) -> None:
        self.ready = True
        self.raw = np.concatenate(self.raw) if self.raw else np.empty((0, 1))
        self.weights = np.concatenate(self.weights) if self.weights else np.empty(0, np.int64)
        n = len(self.vertices)
        self.unit = normalised(self.raw) if n else self.raw
        self.n = np.zeros(n, dtype=np.int64)
        self.sets = Union(n)
        if self.core is not None:
            self.n += self.core["w"] - self.weights
            return
        for a in range(0, n, self.STEP):
            for b in range(a, n, self.STEP):
                s, t = slice(a, a + self.STEP), slice(b, b + self.STEP)
                hit = linked(self.unit[s], self.unit[t], self.raw[s], self.raw[t], self.threshold)
                if a == b:
                    np.fill_diagonal(hit, False)
                    self.n[s] += hit @ self.weights[t]
                else:
                    self.n[s] += hit @ self.weights[t]
                    self.n[t] += hit.T @ self.weights[s]
                i, j = np.nonzero(hit)
                self.sets.join(i + a, j + b)

    def visit(self, vertices: list, weights: np.ndarray, raw: np.ndarray):
        """(vertex, links, one linked vector of the chunk) of each visitor
        that has a link."""
        if not self.ready:
            self.start()
        if not len(self.vertices) or self.raw.shape[1] != raw.shape[1]:
            return [], [], []
        unit = normalised(raw)
        n, first = np.zeros(len(raw), dtype=np.int64), np.full(len(raw), -1)
        for b in range(0, len(self.vertices), self.STEP):
            t = slice(b, b + self.STEP)
            hit = linked(unit, self.unit[t], raw, self.raw[t], self.threshold)
            n += hit @ self.weights[t]
            self.n[t] += hit.T @ weights
            i, j = np.nonzero(hit)
            fresh = np.unique(i, return_index=True)
            new = first[fresh[0]] < 0
            first[fresh[0][new]] = j[fresh[1][new]] + b
            self.sets.join(first[i], j + b)
        rows = np.flatnonzero(n)
        return [vertices[i] for i in rows], n[rows].tolist(), [self.vertices[first[i]] for i in rows]

    def finish(self):
        """(vertex, links, another linked vector or null) of the chunk."""
        if not self.ready:
            self.start()
        rows = np.flatnonzero((self.n > 0))
        if self.core is not None:
            other = [self.core["least"]] * len(rows)
        else:
            other = [self.vertices[i] for i in self.sets.root(rows)]
        return [self.vertices[i] for i in rows], self.n[rows].tolist(), other


def _links(placed: DataFrame, chunks: Chunks) -> DataFrame:
    cores = {}
    for (_, _, core), f in chunks.cells.items():
        for k in range(f["first"], f["first"] + f["parts"]):
            cores[k] = {"w": f["w"], "least": f["least"]} if core else None
    threshold = chunks.layout.threshold

    def rows(found):
        vertices, counts, others = found
        if vertices:
            yield pa.RecordBatch.from_arrays(
                [pa.array(vertices, pa.string()), pa.array(counts, pa.int64()), pa.array(others, pa.string())], names=["vertex", "n", "other"]
            )

    def join(batches):
        now = number = None
        for batch in batches:
            chunk, visitor = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            edges = np.flatnonzero((chunk[1:] != chunk[:-1]) | (visitor[1:] != visitor[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(chunk)], strict=True):
                if not b:
                    continue
                if chunk[a] != number:
                    if now is not None:
                        yield from rows(now.finish())
                    number = int(chunk[a])
                    now = ChunkJoin(cores[number], threshold)
                part = batch.slice(a, b - a)
                for lo in range(0, b - a, ChunkJoin.STEP):
                    own = part.slice(lo, ChunkJoin.STEP)
                    given = own.column(2).to_pylist(), np.asarray(own.column(3)), np.array(_vectors(own.column(4)))
                    if visitor[a]:
                        yield from rows(now.visit(*given))
                    else:
                        now.home(*given)
        if now is not None:
            yield from rows(now.finish())

    dealt = placed.repartition(max(1, chunks.total), "chunk").sortWithinPartitions("chunk", "visitor")
    return dealt.mapInArrow(join, FOUND)


def embedding_components(
    vectors: DataFrame,
    threshold: float = 0.9,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample_rows: int = 2048,
    cell_rows: int = 50_000,
    max_cells: int = 256,
) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links (other rows whose vector has a
    cosine of at least ``threshold``), component_id (smallest id reachable by
    links) and kept (it is the row's own id).

    Pivots come from the ``sample_rows`` vectors of smallest digest (a bounded
    sample; all vectors are indexed): the centres of dense groups, and one
    further pivot per ``cell_rows`` vectors, ``max_cells`` at most.  Cells
    beyond a chunk's size are dealt over chunks, so none of these numbers
    changes the result.

    Defined cases: vectors that are null, empty, zero or hold a null or
    non-finite component link with nothing and are their own component;
    vectors of different lengths never link; equal vectors are linked; a null
    id takes part, and names no component unless all ids of it are null
    (then component_id is null and kept false); rows of one id are rows of
    their own with the same name; an empty table gives no rows; other
    columns are ignored."""
    marked = _marked(vectors, id_col, vector_col)
    classes = (
        marked.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("w"), F.first("v").alias("v"))
        .select("digest", _vertex().alias("vertex"), "w", "v")
    )
    classes = cut(classes, "vectors")
    total = classes.count()
    sample: dict[int, list] = {}
    for row in classes.orderBy("digest").limit(sample_rows).select("v").collect():
        sample.setdefault(len(row["v"]), []).append(row["v"])
    cells = min(max_cells, math.ceil(total / cell_rows))
    pivots = {d: choose_pivots(normalised(np.array(v)), threshold, cells) for d, v in sample.items()}
    layout = Layout(pivots, threshold)
    chunk = min(65_536, max(4096, 32 * math.isqrt(total)))
    chunks = Chunks(_cell_figures(classes, layout), layout, chunk)
    found = cut(_links(_placed(classes, chunks), chunks), "found")
    counts = found.groupBy("vertex").agg(F.sum("n").alias("n"))
    edges = found.where("other is not null").select(F.col("vertex").alias("u"), F.col("other").alias("v"))
    components = connected_components(edges).select(F.col("id").alias("vertex"), "component")
    name = F.coalesce("component", "vertex")
    smallest = (F.try_to_number(F.substring(name, 1, 20), F.lit("9" * 20)) - F.lit(SHIFT)).cast("long")
    told = (
        classes.select("digest", "vertex", "w")
        .join(counts, "vertex", "left")
        .join(components, "vertex", "left")
        .select(
            "digest",
            (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"),
            F.when(~name.startswith("~"), smallest).alias("component_id"),
        )
    )
    rows = marked.select("digest", "vec_id").join(told, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
