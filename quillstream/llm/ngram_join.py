"""N-gram Jaccard join by prefix filters under several token orders
(operator 1).

The set of a document is its distinct word 5-grams as 64-bit hashes.  Equal
sets form a class, carried by its smallest id.  Two classes link when
overlap / union >= ``threshold``.

A prefix of length n - ceil(t n) + l under any global token order holds at
least the l first common tokens of every linked pair.  Three orders are
used, and a pair must pass all of them before its sets are compared:

1. by token hash.  Its (longer) prefixes come straight from the text pass,
   before any token statistics exist.  A class survives only if enough of
   its prefix tokens occur in another class.
2. by (number of surviving classes with the token, token): rare first.
   Classes meet in the buckets of these prefix tokens.
3. by (that number, second token hash).

What meets in a bucket is cut down three times before pairs are made:

* By position.  At the first common token of a pair under order 2 neither
  text has more tokens in common than stand from there on, so both must
  have at least t/(1+t) of both sizes together left.  A template whose copies
  differ by more than t lets through leaves no pair.
* By a star.  The bucket's most central text (tokens of many classes) is
  compared with all others; verified links make components.
* By components.  Texts of the bucket's main component need no comparison
  with each other: pairs are made of the *others* and all.  In wide buckets
  the key has the size band as well, and a text probes only the bands that
  the position leaves to its partners.

No pair of different texts that may link is left out, so the components are
exact.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.arrow_text import SpanHasher, Words, lower_table, mix64, text_chunks, window_hashes
from quillstream.llm.components import connected_components
from quillstream.llm.scratch import cut, drop

SET_SCHEMA = "doc_id bigint, n_shingles bigint, digest binary, prefix array<bigint>"


def shingle_sets(column: pa.Array, width: int):
    """Yield the sorted distinct shingle hashes (int64) of each text; a text
    of fewer than ``width`` words is one shingle, one without words none."""
    lower, hasher = lower_table(), SpanHasher(seed=1)
    for _, data, offsets in text_chunks(column):
        data = lower[data]
        words = Words(data, offsets)
        hashes = hasher.spans(hasher.prefix(data), words.start, words.end)
        grams = window_hashes(hashes, width).view(np.int64)
        for lo, hi in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            if hi - lo >= width:
                yield np.unique(grams[lo : hi - width + 1])
            elif hi > lo:
                whole = window_hashes(hashes[lo:hi], int(hi - lo)) ^ np.uint64(hi - lo)
                yield mix64(whole).view(np.int64)
            else:
                yield np.empty(0, dtype=np.int64)


def shared_needed(n: int, threshold: float, extra: float) -> int:
    """Prefix tokens (order 1) that a linked partner must share: the partner
    may be as small as t n, with the shorter extension."""
    return 1 + math.floor(extra * math.ceil(threshold * n - 1e-9))


def hash_prefix_length(n: int, threshold: float, extra: float) -> int:
    return min(n, n - math.ceil(threshold * n - 1e-9) + 1 + math.floor(extra * n))


def document_sets(docs: DataFrame, width: int, threshold: float, extra: float, id_col: str, text_col: str) -> DataFrame:
    """Per row: set size, set digest and the hash-order prefix (only on the
    first copy of a set within an Arrow batch)."""

    def sets(batches):
        for batch in batches:
            sizes, digests, prefixes, seen = [], [], [], set()
            for own in shingle_sets(batch.column(1), width):
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                sizes.append(len(own))
                digests.append(digest if len(own) else None)
                fresh = len(own) and digest not in seen
                seen.add(digest)
                prefixes.append(own[: hash_prefix_length(len(own), threshold, extra)] if fresh else None)
            lengths = np.cumsum([0, *(0 if p is None else len(p) for p in prefixes)])
            flat = np.concatenate([p for p in prefixes if p is not None] or [np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat)),
                ],
                names=["doc_id", "n_shingles", "digest", "prefix"],
            )

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(sets, SET_SCHEMA)


def _full_sets(texts: DataFrame, width: int) -> DataFrame:
    def sets(batches):
        for batch in batches:
            own = list(shingle_sets(batch.column(1), width))
            flat = np.concatenate(own or [np.empty(0, np.int64)])
            offsets = np.cumsum([0, *map(len, own)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                names=["id", "tokens"],
            )

    return texts.mapInArrow(sets, "id bigint, tokens array<bigint>")


def _survivors(sets: DataFrame, threshold: float, extra: float) -> DataFrame:
    """Class digests (low 64 bits as ``cid``) that pass the hash-order filter,
    as a written table."""
    cid = F.xxhash64("digest").alias("cid")
    # dealt by token once: the shared tokens and the join read the same exchange
    postings = sets.where("size(prefix) > 0").select(cid, F.explode("prefix").alias("tok")).repartition("tok")
    # copies of a class post the same cid, so they never make a token shared
    shared = postings.groupBy("tok").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo != hi").select("tok")
    # one row a token and partition: the build side of each partition is bounded
    hits = postings.join(shared.hint("shuffle_hash"), "tok").groupBy("cid").count()
    sizes = sets.where("digest is not null").select(cid, "n_shingles").distinct()
    need = 1 + F.floor(F.lit(extra) * F.ceil(F.col("n_shingles") * threshold - 1e-9))
    return cut(hits.join(sizes, "cid").where(F.col("count") >= need).select("cid").distinct(), "alive")


def _orders(full: DataFrame, threshold: float) -> DataFrame:
    """Set and prefix tokens of every surviving class under the three orders;
    ``shared`` counts its tokens that other classes have, ``central`` is the
    mean logarithm of their classes."""
    n = F.size("tokens")
    length = n - F.ceil(n * threshold - 1e-9).cast("int") + 1
    base = full.select("id", "tokens", n.alias("n"), length.alias("p"), F.slice("tokens", 1, length).alias("p1"))
    postings = full.select("id", F.explode("tokens").alias("tok"))
    df = postings.groupBy("tok").agg(F.count("*").alias("df")).where("df > 1")
    # tokens of one class only come first in orders 2 and 3; they use up
    # prefix places and meet nobody
    ranked = postings.join(df.hint("shuffle_hash"), "tok").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("df", "tok"))).alias("a"), F.sum(F.log2("df")).alias("logs")
    )
    again = F.transform("a", lambda x: F.struct(x["df"].alias("df"), F.xxhash64(x["tok"]).alias("h"), x["tok"].alias("tok")))
    ranked = ranked.withColumn("b", F.sort_array(again))
    shared = F.size("a")
    room = F.col("p") - (F.col("n") - shared)
    return (
        base.join(ranked, "id")
        .where(room > 0)
        .select(
            "id", "n", "tokens", "p1", F.slice("a.tok", 1, room).alias("p2"), F.slice("b.tok", 1, room).alias("p3"),
            shared.alias("shared"), (F.col("logs") / F.col("n")).alias("central"),
        )
    )


def _verified(pairs: DataFrame, orders: DataFrame, threshold: float) -> DataFrame:
    """Links (u, v) among candidate pairs that met under order 2: the sets of
    pairs that also share prefix tokens under orders 1 and 3 are compared."""

    def side(end: str) -> DataFrame:
        return orders.select(F.col("id").alias(end), *(F.col(c).alias(f"{c}_{end}") for c in ("p1", "p3", "tokens")))

    met = pairs.join(side("u"), "u").join(side("v"), "v")
    passed = met.where(F.arrays_overlap("p3_u", "p3_v") & F.arrays_overlap("p1_u", "p1_v"))
    common = F.size(F.array_intersect("tokens_u", "tokens_v"))
    union = F.size("tokens_u") + F.size("tokens_v") - common
    return passed.where(100 * common >= round(100 * threshold) * union).select("u", "v")


#: Buckets of more classes are dealt by size band as well; ratio of two bands.
WIDE, BAND = 64, 1.03


def _band(size: Column) -> Column:
    return F.floor(F.log(size) / math.log(BAND)).cast("int")


def ngram_links(orders: DataFrame, threshold: float, wide: int = WIDE) -> DataFrame:
    """Verified links among classes that connect all truly linked classes
    (see the module's text)."""
    part = threshold / (1 + threshold)
    # rest: shared tokens from this place of order 2 on
    placed = orders.select("id", "n", "central", "shared", F.posexplode("p2").alias("pos", "tok"))
    buckets = cut(placed.select("tok", "id", "n", "central", (F.col("shared") - F.col("pos")).alias("rest")), "buckets")
    fits = (F.least("u_rest", "v_rest") >= (F.col("u_n") + F.col("v_n")) * part - 1e-9) & (F.col("u") != F.col("v"))
    ends = [F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")]

    def side(rows: DataFrame, end: str, *more) -> DataFrame:
        return rows.select("tok", F.col("id").alias(end), F.col("n").alias(f"{end}_n"), F.col("rest").alias(f"{end}_rest"), *more)

    top = F.max(F.struct("central", (-F.col("id")).alias("first"), "id", "n", "rest")).alias("top")
    heads = cut(buckets.groupBy("tok").agg(top, F.count("*").alias("size")).where("size > 1"), "heads")
    stars = side(buckets, "u").join(side(heads.select("tok", "top.*"), "v"), "tok").where(fits)
    stars = cut(stars.select(*ends).distinct(), "stars")
    found = cut(_verified(stars, orders, threshold), "star_links")

    own = connected_components(found)
    told = buckets.join(own, "id", "left").join(heads.select("tok", (F.col("size") > wide).alias("is_wide")), "tok")
    label = F.coalesce("component", "id").alias("label")
    labelled = cut(told.select("tok", "id", "n", "rest", "is_wide", label), "labelled")
    counts = labelled.groupBy("tok", "label").agg(F.count("*").alias("c"))
    main = counts.groupBy("tok").agg(F.max(F.struct("c", "label"))["label"].alias("main"), F.count("*").alias("labels"))
    main = main.where("labels > 1").select("tok", "main")
    others = labelled.join(main.hint("shuffle_hash"), "tok").where("label != main")
    least = F.ceil(F.col("n") * threshold - 1e-9)
    most = F.least(F.floor(F.col("n") / threshold + 1e-9), F.floor(F.col("rest") / part + 1e-9) - F.col("n"))
    bands = F.when(F.col("is_wide"), F.sequence(_band(least), _band(F.greatest(most, least)))).otherwise(F.array(F.lit(-1)))
    probes = side(others.where(most >= least), "u", F.col("label").alias("u_label"), F.explode(bands).alias("band"))
    band = F.when(F.col("is_wide"), _band(F.col("n"))).otherwise(F.lit(-1)).alias("band")
    pairs = probes.join(side(labelled, "v", F.col("label").alias("v_label"), band), ["tok", "band"])
    pairs = pairs.where("u_label != v_label").where(fits).select(*ends).distinct().join(stars, ["u", "v"], "left_anti")
    rest = cut(_verified(cut(pairs, "pairs"), orders, threshold), "rest_links")
    links = cut(found.union(rest), "links")
    drop(buckets, heads, stars, labelled)
    return links


def ngram_jaccard_components(
    docs: DataFrame,
    threshold: float = 0.75,
    width: int = 5,
    extra: float = 0.15,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, class_id (smallest id with the
    same set) and component_id (smallest id reachable by links).

    Defined cases: a null or empty text, or one without words, has an empty
    set, links with nothing and is its own component; repeated rows share
    class and component; a null id takes part only as a copy of a class
    (its component is null if no row of its class has an id); rows with one
    id and different texts are joined by that id; an empty table gives no
    rows; other columns are ignored."""
    sets = cut(document_sets(docs, width, threshold, extra, id_col, text_col), "sets")
    alive = _survivors(sets, threshold, extra)
    heads = cut(sets.select("doc_id", "n_shingles", "digest"), "heads")
    drop(sets)
    classes = cut(
        heads.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes"
    )
    chosen = cut(
        classes.where("class_id is not null")
        .withColumn("cid", F.xxhash64("digest"))
        .join(alive, "cid", "left_semi")
        .select(F.col("class_id").alias("id"))
        .distinct(),
        "chosen",
    )
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    full = cut(
        _full_sets(texts.join(chosen, "id", "left_semi").dropDuplicates(["id", "text"]), width).where("size(tokens) > 0"),
        "full",
    )
    orders = cut(_orders(full, threshold), "orders")
    drop(alive, chosen, full)
    components = cut(connected_components(ngram_links(orders, threshold)), "components")
    drop(orders)
    merged = classes.join(components.withColumnRenamed("id", "class_id"), "class_id", "left").select(
        "digest", "class_id", F.coalesce("component", "class_id").alias("component_id")
    )
    return (
        heads.join(merged, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
            F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
    )
