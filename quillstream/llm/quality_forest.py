"""Quality rules with an isolation forest (operator 8).

Per document the rule statistics are counted over the whole text in one
vectorised pass.  A fixed base rule rejects short or heavily repeating
texts.  Everything else is judged by an isolation forest: random
axis-parallel splits over the statistics of a bounded sample of labelled
rows, where a short average path marks an anomaly.  The score above which a
document is rejected is calibrated on the labels of the same bounded sample.

The forest is small and of fixed size (``trees`` x ``subsample``), so it
travels with the task; documents are never shuffled.

Defined cases: a null or empty text has all counts 0 and fails the base
rule; null ids stay as they are; repeated rows are judged one by one and
alike; without labels of both classes no threshold exists and the base rule
alone decides; columns of the input other than the id and the text are
carried through untouched by ``filter_quality`` and ignored by
``score_quality``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.arrow_text import SpanHasher, Words, is_space_table, text_chunks, window_hashes

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"
STATS_SCHEMA = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in (*BASE, "n_lines"))


def rule_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts of every text of an Arrow string column (null: empty)."""
    out = {c: np.zeros(len(column), dtype=np.int64) for c in (*BASE, "n_lines")}
    symbol, space, hasher = np.zeros(256, dtype=bool), is_space_table(), SpanHasher(seed=8)
    symbol[list(SYMBOLS)] = True
    for row, data, offsets in text_chunks(column):
        n = len(offsets) - 1
        part = slice(row, row + n)

        def per_text(flags: np.ndarray, offsets: np.ndarray = offsets) -> np.ndarray:
            running = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
            return np.diff(running[offsets])

        words = Words(data, offsets)
        out["n_words"][part] = np.diff(words.bounds)
        out["word_chars"][part] = per_text(((data & 0xC0) != 0x80) & ~space[data])
        out["n_symbols"][part] = per_text(symbol[data])
        prefix = hasher.prefix(data)
        hashes = hasher.spans(prefix, words.start, words.end)
        triples = window_hashes(hashes, 3)
        covered = np.zeros(len(hashes) + 3, dtype=bool)
        for i in range(n):
            lo, hi = words.bounds[i], words.bounds[i + 1]
            if hi - lo >= 4:
                own = triples[lo : hi - 2]
                order = np.argsort(own, kind="stable")
                same = own[order[1:]] == own[order[:-1]]
                if same.any():
                    again = lo + np.unique(np.concatenate((order[1:][same], order[:-1][same])))
                    for k in range(3):
                        covered[again + k] = True
            text = data[offsets[i] : offsets[i + 1]].tobytes()
            lines = [x for x in text.split(b"\n") if not (x == b"" or x.isspace())]
            out["n_lines"][row + i] = len(lines)
            out["n_dup_lines"][row + i] = len(lines) - len(set(lines))
        running = np.concatenate(([0], np.cumsum(covered[: len(hashes)], dtype=np.int64)))
        out["n_repeat_words"][part] = np.diff(running[words.bounds])
    return out


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Forest inputs: rates, so the length of a text alone is no anomaly.
    Repeated lines enter through the words they repeat: one repeated short
    line is common in good texts and, as an input of its own, isolates them."""
    words = np.maximum(stats["n_words"], 1)
    return np.stack(
        [
            stats["word_chars"] / words,
            stats["n_symbols"] / words,
            stats["n_repeat_words"] / words,
        ],
        axis=1,
    ).astype(np.float64)


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    return (stats["n_words"] < 50) | (100 * stats["n_repeat_words"] > 50 * stats["n_words"])


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


@dataclass
class IsolationForest:
    """Trees as flat arrays: feature (-1 at a leaf), cut, left child (right
    is left + 1) and the path length credited at the node."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    credit: np.ndarray
    subsample: int
    threshold: float | None = None

    @classmethod
    def grow(cls, points: np.ndarray, trees: int = 128, subsample: int = 256, seed: int = 8) -> IsolationForest:
        rng = np.random.default_rng(seed)
        size = min(subsample, len(points))
        depth_limit = max(1, int(np.ceil(np.log2(max(size, 2)))))
        width = 2 ** (depth_limit + 1)
        feature = np.full((trees, width), -1, dtype=np.int32)
        cut, left = np.zeros((trees, width)), np.zeros((trees, width), dtype=np.int32)
        credit = np.zeros((trees, width))
        for t in range(trees):
            todo, used = [(0, points[rng.choice(len(points), size, replace=False)], 0)], 1
            while todo:
                node, own, depth = todo.pop()
                low, high = own.min(axis=0), own.max(axis=0)
                open_ = np.flatnonzero(high > low)
                if depth == depth_limit or len(own) <= 1 or not len(open_):
                    credit[t, node] = depth + mean_path(len(own))
                    continue
                f = int(rng.choice(open_))
                at = rng.uniform(low[f], high[f])
                feature[t, node], cut[t, node], left[t, node] = f, at, used
                below = own[:, f] <= at
                todo += [(used, own[below], depth + 1), (used + 1, own[~below], depth + 1)]
                used += 2
        return cls(feature, cut, left, credit, size)

    def score(self, points: np.ndarray) -> np.ndarray:
        """2 ** (-mean path / expected path): near 1 is anomalous."""
        total = np.zeros(len(points))
        rows = np.arange(len(points))
        for feature, cut, left, credit in zip(self.feature, self.cut, self.left, self.credit, strict=True):
            node = np.zeros(len(points), dtype=np.int32)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = points[rows, np.maximum(f, 0)] > cut[node]
                node = np.where(inner, left[node] + right, node)
            total += credit[node]
        return 2.0 ** (-(total / len(self.feature)) / max(mean_path(self.subsample), 1e-9))

    def calibrate(self, points: np.ndarray, good: np.ndarray, good_weight: float) -> None:
        """Set the score above which rows are rejected: the cut between two
        labelled scores that maximises the share of bad rows rejected minus
        ``good_weight`` x the share of good rows rejected."""
        if good.all() or not good.any():
            return
        scores = self.score(points)
        order = np.argsort(-scores, kind="stable")
        ranked, is_good = scores[order], good[order]
        gain = np.cumsum(~is_good) / (~good).sum() - good_weight * np.cumsum(is_good) / good.sum()
        last = np.append(ranked[1:] < ranked[:-1], True)  # ties fall on one side
        best = int(np.argmax(np.where(last, gain, -np.inf)))
        below = ranked[best + 1] if best + 1 < len(ranked) else ranked[best] - 1.0
        self.threshold = float((ranked[best] + below) / 2) if gain[best] > 0 else float(ranked[0] + 1.0)

    def rejects(self, points: np.ndarray) -> np.ndarray:
        if self.threshold is None:
            return np.zeros(len(points), dtype=bool)
        return self.score(points) > self.threshold


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rule statistics per row."""

    def count(batches):
        for batch in batches:
            stats = rule_statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, stats.values())], names=["doc_id", *stats])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(count, STATS_SCHEMA)


def fit_forest(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = 4000,
    trees: int = 128,
    subsample: int = 256,
    good_weight: float = 20.0,
) -> IsolationForest | None:
    """Grow and calibrate a forest on at most ``max_labelled`` labelled rows
    (the first in a hash order of their ids, so the choice is stable)."""
    chosen = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("doc_id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # at most max_labelled (id, label) pairs: a proven size
    texts = own.join(F.broadcast(chosen), "doc_id")
    rows = (
        statistics(texts.select("doc_id", "text"))
        .join(F.broadcast(chosen), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", *BASE)
        .limit(max_labelled)
        .toPandas()
    )
    if rows.empty:
        return None
    points = features({c: rows[c].to_numpy() for c in (*BASE, "n_lines")})
    good = rows["good"].to_numpy() > 0
    forest = IsolationForest.grow(points, trees, subsample)
    # the base rule decides first, so the threshold is set on what it leaves
    left = ~base_failed({c: rows[c].to_numpy() for c in BASE})
    forest.calibrate(points[left], good[left], good_weight)
    return forest


def score_quality(docs: DataFrame, forest: IsolationForest | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, base verdict, anomaly score and final verdict per row."""

    def judge(batches):
        for batch in batches:
            stats = rule_statistics(batch.column(1))
            points, failed = features(stats), base_failed(stats)
            score = forest.score(points) if forest else np.zeros(len(failed))
            kept = ~failed & ~forest.rejects(points) if forest else ~failed
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(stats[c]) for c in BASE), pa.array(failed), pa.array(kept), pa.array(score)],
                names=["doc_id", *BASE, "base_failed", "kept", "anomaly"],
            )

    schema = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, kept boolean, anomaly double"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(judge, schema)


def filter_quality(docs: DataFrame, forest: IsolationForest | None, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` (all columns) that pass the base rule and the forest."""
    at = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            stats = rule_statistics(batch.column(at))
            good = ~base_failed(stats)
            if forest:
                good &= ~forest.rejects(features(stats))
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
