"""Best-fit packing by a grouping genetic algorithm (operator 10).

Pieces of at most ``capacity`` tokens go into as few sequences as possible.
A solution is a set of bins, and the operators work on whole bins: crossover
injects the well-filled bins of one parent into the other, drops the bins
that now hold a piece twice, and puts the displaced pieces back by best fit,
longest first.

The pieces are dealt by a hash of their row into shards of about
``shard_pieces``; a task holds one shard.  Every shard is worked on by
several islands (own populations, own random streams).  After an epoch the
best solution of an island migrates to the next one in the ring, as a join.
Bins that end up slack are dissolved, and their pieces are pooled over all
shards and dealt again, until one shard holds the rest; so what is lost at
shard borders does not grow with the number of shards.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.piece_cache import encoder
from quillstream.llm.scratch import cut

PIECE_SCHEMA = "row_id bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
STATE_SCHEMA = "shard bigint, island int, rows array<bigint>, lengths array<int>, population array<binary>, bins int, fitness double"
PLACE_SCHEMA = "row_id bigint, sequence_id bigint, offset bigint, free bigint"


def document_pieces(docs: DataFrame, vocab: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Token pieces of every row: a text longer than ``capacity`` is cut so
    that only the first piece may be shorter."""

    def pieces(batches):
        from pyspark import TaskContext

        row_id = TaskContext.get().partitionId() << 40
        coder, end = encoder(vocab), np.array([end_id], dtype="<u4")
        for batch in batches:
            doc = batch.column(0).to_pylist()
            for row, ids, bounds in coder.chunks(batch.column(1)):
                out = []
                for i in range(len(bounds) - 1):
                    own = np.concatenate((ids[bounds[i] : bounds[i + 1]].astype("<u4"), end))
                    first = len(own) % capacity or capacity
                    for k, stop in enumerate(range(first, len(own) + 1, capacity)):
                        start = max(0, stop - capacity) if k else 0
                        out.append((row_id, doc[row + i], k, start, stop - start, zlib.crc32(own[start:stop].tobytes())))
                        row_id += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), PIECE_TYPES, strict=True)],
                    names=["row_id", "doc_id", "piece", "start", "length", "ids_crc32"],
                )

    own = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return own.mapInArrow(pieces, PIECE_SCHEMA)


PIECE_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())


class Bins:
    """Open bins by free space.  A bit mask of the free sizes in use gives
    the tightest bin for a piece in one step."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0
        self.items: list[list[int]] = []

    def add_bin(self, items: list[int], free: int) -> None:
        self._file(len(self.items), free)
        self.items.append(items)

    def _file(self, bin_: int, free: int) -> None:
        self.by_free[free].append(bin_)
        self.mask |= 1 << free

    def put(self, item: int, size: int) -> None:
        fits = self.mask >> size
        if not fits:
            self.add_bin([item], self.capacity - size)
            return
        free = size + (fits & -fits).bit_length() - 1
        own = self.by_free[free]
        bin_ = own.pop()
        if not own:
            self.mask &= ~(1 << free)
        self.items[bin_].append(item)
        self._file(bin_, free - size)

    def assignment(self, n: int) -> np.ndarray:
        out = np.empty(n, dtype=np.int32)
        for bin_, items in enumerate(self.items):
            out[items] = bin_
        return out


def best_fit(sizes: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    bins = Bins(capacity)
    for item, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        bins.put(item, size)
    return bins.assignment(len(sizes))


def cross(sizes: np.ndarray, giver: np.ndarray, taker: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Child of two solutions: the giver's best bins stay whole."""
    fill = np.bincount(giver, weights=sizes).astype(np.int64)
    wanted = fill >= np.quantile(fill, rng.uniform(0.3, 0.9))
    wanted &= rng.random(len(fill)) < 0.9
    injected = wanted[giver]
    broken = np.zeros(int(taker.max()) + 1, dtype=bool)
    broken[taker[injected]] = True
    kept = ~injected & ~broken[taker]
    bins = Bins(capacity)
    for source, chosen in ((giver, injected), (taker, kept)):
        items = np.flatnonzero(chosen)
        items = items[np.argsort(source[items], kind="stable")]
        if not len(items):
            continue
        edges = np.flatnonzero(np.diff(source[items])) + 1
        for group in np.split(items, edges):
            bins.add_bin(group.tolist(), capacity - int(sizes[group].sum()))
    rest = np.flatnonzero(~injected & ~kept)
    rest = rest[np.argsort(-sizes[rest], kind="stable")]
    for item, size in zip(rest.tolist(), sizes[rest].tolist(), strict=True):
        bins.put(item, size)
    return bins.assignment(len(sizes))


def fitness(sizes: np.ndarray, solution: np.ndarray, capacity: int) -> tuple[int, float]:
    """(bins, mean squared fill): fewer bins first, then uneven fill, which
    leaves room to empty a bin."""
    fill = np.bincount(solution, weights=sizes) / capacity
    return len(fill), float(np.mean(fill * fill))


def evolve(
    sizes: np.ndarray, population: list[np.ndarray], capacity: int, rng: np.random.Generator, size: int, generations: int
) -> list[np.ndarray]:
    """Population after some generations, best first.  Ends at once when the
    best solution has as few bins as the sum of sizes allows."""
    bound = math.ceil(int(sizes.sum()) / capacity)
    population = list(population)
    while len(population) < size:
        noise = rng.uniform(0.9, 1.1, len(sizes)) if population else 1.0
        population.append(best_fit(sizes, np.argsort(-(sizes * noise), kind="stable"), capacity))
        if fitness(sizes, population[-1], capacity)[0] == bound:
            break
    rank = lambda s: (lambda b, f: (b, -f))(*fitness(sizes, s, capacity))
    population.sort(key=rank)
    for _ in range(generations):
        if rank(population[0])[0] == bound or len(population) < 2:
            break
        children = []
        for _ in range(max(1, size // 2)):
            a, b = rng.choice(len(population), 2, replace=False)
            children.append(cross(sizes, population[min(a, b)], population[max(a, b)], capacity, rng))
        population = sorted(population + children, key=rank)[:size]
    return population


def _epoch(state: DataFrame, capacity: int, epoch: int, size: int, generations: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["lengths"], dtype=np.int64)
                rng = np.random.default_rng([row["shard"], row["island"], epoch])
                start = [np.frombuffer(x, dtype="<i4") for x in row["population"] or []]
                found = evolve(sizes, start, capacity, rng, size, generations)
                bins, fit = fitness(sizes, found[0], capacity)
                row |= {"population": [x.astype("<i4").tobytes() for x in found], "bins": bins, "fitness": fit}
                yield pa.RecordBatch.from_pylist([row], schema=batch.schema)

    return state.mapInArrow(work, STATE_SCHEMA)


def _migrated(state: DataFrame, islands: int) -> DataFrame:
    """Every island takes in the best solution of its neighbour."""
    elite = state.select("shard", ((F.col("island") + 1) % islands).alias("island"), F.slice("population", 1, 1).alias("elite"))
    joined = state.join(elite, ["shard", "island"])
    return joined.withColumn("population", F.concat("elite", "population")).drop("elite").select(*state.columns)


def _places(best: DataFrame, capacity: int) -> DataFrame:
    """Sequence (the smallest row id in it), offset and the sequence's free
    space of every row of solved shards."""

    def place(batches):
        for batch in batches:
            for rows, lengths, solution in zip(*batch.columns, strict=True):
                rows, sizes = np.array(rows.as_py(), dtype=np.int64), np.array(lengths.as_py(), dtype=np.int64)
                bins = np.frombuffer(solution.as_py(), dtype="<i4")
                order = np.lexsort((rows, bins))
                rows, ends = rows[order], np.cumsum(sizes[order])
                head = np.flatnonzero(np.concatenate(([True], np.diff(bins[order]) != 0)))
                many = np.diff(np.append(head, len(order)))
                begin = ends - sizes[order]
                total = np.add.reduceat(sizes[order], head)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rows),
                        pa.array(np.repeat(rows[head], many)),
                        pa.array(begin - np.repeat(begin[head], many)),
                        pa.array(np.repeat(capacity - total, many)),
                    ],
                    names=["row_id", "sequence_id", "offset", "free"],
                )

    return best.mapInArrow(place, PLACE_SCHEMA)


def pack(
    pieces: DataFrame,
    capacity: int = 2048,
    shard_pieces: int = 4096,
    islands: int = 2,
    population: int = 4,
    generations: int = 4,
    epochs: int = 2,
    slack: int = 16,
    max_levels: int = 6,
) -> DataFrame:
    """(row_id, length <= capacity) -> (row_id, sequence_id, offset).

    Bins with more than ``slack`` free tokens are dissolved and dealt again,
    ``max_levels`` times at most.  Row ids must be distinct.  An empty table
    gives no rows; equal lengths are ordered by row id."""
    zero = F.lit(0).cast("long").alias("offset")
    done = pieces.where(F.col("length") >= capacity).select("row_id", F.col("row_id").alias("sequence_id"), zero)
    left = pieces.where(F.col("length") < capacity).select("row_id", "length")
    for level in range(max_levels):
        count = left.count()
        if not count:
            break
        shards = math.ceil(count / shard_pieces)
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("row_id", F.lit(level)), F.lit(shards)))
        own = dealt.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("row_id", "length"))).alias("own"))
        state = own.select(
            "shard",
            F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
            F.col("own.row_id").alias("rows"),
            F.col("own.length").cast("array<int>").alias("lengths"),
            F.array().cast("array<binary>").alias("population"),
            F.lit(0).alias("bins"),
            F.lit(0.0).alias("fitness"),
        )
        for epoch in range(epochs):
            state = cut(_epoch(state.repartition("shard", "island"), capacity, epoch, population, generations), "islands")
            if epoch + 1 < epochs:
                state = _migrated(state, islands)
        ranked = F.struct((-F.col("bins")).alias("bins"), "fitness", (-F.col("island")).alias("island"))
        solved = F.struct("rows", "lengths", F.element_at("population", 1).alias("solution"))
        best = state.groupBy("shard").agg(F.max_by(solved, ranked).alias("b")).select("b.*")
        placed = cut(_places(best, capacity), "placed")
        last = shards == 1 or level + 1 == max_levels
        firm = placed if last else placed.where(F.col("free") <= slack)
        done = done.unionByName(firm.select("row_id", "sequence_id", "offset"))
        if last:
            break
        left = cut(placed.where(F.col("free") > slack).select("row_id").join(left, "row_id"), "loose")
    return done


def pack_documents(
    docs: DataFrame, vocab: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", **search
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Defined cases: a null or empty text is its end id alone; null ids stay
    null; repeated rows are packed as often as they come; a text of exactly
    ``capacity`` tokens is one full sequence; an empty table gives no rows;
    other columns are ignored."""
    pieces = cut(document_pieces(docs, vocab, capacity, end_id, id_col, text_col), "pieces")
    places = pack(pieces.select("row_id", "length"), capacity, **search)
    return pieces.join(places, "row_id").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
