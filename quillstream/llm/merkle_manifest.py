"""Merkle manifest of a document table (operator 12).

Every row is a leaf digest.  Leaves of one source, ascending by id, form a
tree in which every 16 consecutive nodes become their digest until one, the
source's subroot, is left; the subroots form a tree of the same shape up to
the root.

A *block* of 4096 consecutive leaves keeps each of its levels as one string
of concatenated hex digests.  Fixed-width substrings of a level are hashed
into the next level; the substrings on both sides of a node within its run
of 16 are its siblings.  The digests that blocks end with are the nodes of
the next, 4096 times smaller table, until every source has one block.  The
siblings found there come back to the block by one join on (source, block),
so the cost of a row does not depend on the size of its source, and a
source of any size is dealt over blocks of equal length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.scratch import cut
from quillstream.operators.ids import rank_within

# Digits of a hex sha256, nodes of a run, levels inside a block
DIGEST = 64
RUN = 16
BLOCK_LEVELS = 3
BLOCK = RUN**BLOCK_LEVELS

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(values: list[Column]) -> Column:
    """sha256 over ``<utf8 bytes>:<value>`` of each value, ``-`` for null."""
    parts = [
        F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
        for v in (c.cast("string") for c in values)
    ]
    return F.sha2(F.concat(*parts), 256)


def _parents(level: Column) -> Column:
    """The digests of every run of a level, again as one string."""
    last = F.floor((F.octet_length(level) - 1) / (RUN * DIGEST)).cast("int")
    runs = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.sha2(F.substring(level, i * (RUN * DIGEST) + 1, F.lit(RUN * DIGEST)), 256)
    )
    return F.array_join(runs, "").cast("binary")


def _siblings(level: Column, at: Column) -> Column:
    """(left, right): the other nodes of the run of node ``at``."""
    first = F.floor(at / RUN).cast("int") * RUN
    left = F.substring(level, first * DIGEST + 1, (at - first) * DIGEST)
    right = F.substring(level, (at + 1) * DIGEST + 1, (first + RUN - 1 - at) * DIGEST)
    return F.struct(left.alias("left"), right.alias("right"))


def _path(at: Column) -> Column:
    """Siblings of the node ``at`` of a block on the block's levels, then on
    the levels above the block."""
    own = [_siblings(F.col(f"l{k}"), F.floor(at / RUN**k).cast("int")) for k in range(BLOCK_LEVELS)]
    return F.concat(F.slice(F.array(*own), 1, F.col("levels")), F.col("above"))


def _fold(path: Column, start: Column) -> Column:
    """The root that ``start`` and its siblings give."""
    step = lambda low, s: F.sha2(F.concat(s["left"], low.cast("binary"), s["right"]), 256)
    return F.aggregate(path, start, step)


def _climb(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """``nodes`` (tree, pos from 0, node, payload) -> one row per block:
    tree, block, entries in order, level strings, ``levels`` hashed inside
    the block, siblings ``above`` it and ``top``, the tree's last node."""
    sizes = nodes.groupBy("tree").agg((F.max("pos") + 1).alias("size"))
    entry = F.struct("pos", "node", *payload)
    blocks = (
        nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))
        .groupBy("tree", "block")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .join(sizes, "tree")
    )
    # a tree of one block ends as soon as one node is left
    levels = F.when(F.col("size") > BLOCK, F.lit(BLOCK_LEVELS))
    for k in range(BLOCK_LEVELS):
        levels = levels.when(F.col("size") <= RUN**k, F.lit(k))
    blocks = blocks.withColumn("levels", levels.otherwise(F.lit(BLOCK_LEVELS)))
    blocks = blocks.withColumn("l0", F.array_join(F.col("entries.node"), "").cast("binary"))
    for k in range(BLOCK_LEVELS):
        below = F.col(f"l{k}")
        blocks = blocks.withColumn(f"l{k + 1}", F.when(F.col("levels") > k, _parents(below)).otherwise(below))
    blocks = cut(blocks, "blocks")
    end = F.col(f"l{BLOCK_LEVELS}").cast("string")
    largest = sizes.agg(F.max("size")).first()[0] or 0
    if largest <= BLOCK:
        none = F.array().cast("array<struct<left:binary,right:binary>>")
        return blocks.withColumn("above", none).withColumn("top", end)
    upper = _climb(blocks.select("tree", F.col("block").alias("pos"), end.alias("node")), [])
    paths = F.transform("entries", lambda e: F.struct(e["pos"].alias("block"), _path((e["pos"] % BLOCK).cast("int")).alias("above")))
    found = upper.select("tree", "top", F.explode(paths).alias("p")).select("tree", "top", "p.block", "p.above")
    return blocks.join(found, ["tree", "block"])


def merkle_manifest(docs: DataFrame, tampered: Column | None = None, columns: tuple[str, ...] = LEAF_COLUMNS) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256 (digest
    over all siblings from the leaf up to the root, left to right),
    folded_root (the root that the row as found now gives with those
    siblings) and verified.

    ``tampered`` is a digest of the row as found now; without it the leaf
    itself is verified.  ``columns`` are the id, the source and the other
    columns of a leaf, in order.

    Defined cases: a null is ``-`` in its leaf; a null source is a source of
    its own, before all others; a null id comes before all others of its
    source; rows with one id of one source stand in the order of their
    digests (equal rows are interchangeable); a tree of one leaf has it as
    its root and no siblings; an empty table gives no rows; further columns
    are ignored; a text of any length is hashed where it is read."""
    id_col, source = columns[:2]
    tree = F.when(F.col(source).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(source).cast("string")))
    leaf = leaf_digest([F.col(c) for c in columns])
    now = leaf if tampered is None else tampered
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), tree.alias("tree"), leaf.alias("node"), now.alias("now"))
    rows = cut(rows, "leaves")
    placed = rank_within(rows, ["doc_id", "node"], "tree", rank_col="rank")
    placed = placed.select("tree", (F.col("rank") - 1).alias("pos"), "node", "doc_id", "now")
    blocks = _climb(placed, ["doc_id", "now"])

    trees = blocks.where("block = 0").select("tree", "top")
    ranked = rank_within(trees, ["tree"], rank_col="rank")
    tops = _climb(ranked.select(F.lit("").alias("tree"), (F.col("rank") - 1).alias("pos"), F.col("top").alias("node"), F.col("tree").alias("own")), ["own"])
    paths = F.transform("entries", lambda e: F.struct(e["own"].alias("tree"), _path((e["pos"] % BLOCK).cast("int")).alias("over")))
    tops = tops.select(F.col("top").alias("root"), F.explode(paths).alias("p")).select("root", "p.tree", "p.over")

    def row(e: Column) -> Column:
        path = F.concat(_path((e["pos"] % BLOCK).cast("int")), F.col("over"))
        siblings = F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"]).cast("string")), "")
        return F.struct(
            e["doc_id"].alias("doc_id"),
            e["node"].alias("leaf"),
            F.sha2(siblings, 256).alias("proof_sha256"),
            _fold(path, e["now"]).alias("folded_root"),
        )

    proofs = blocks.join(tops, "tree").select(F.col("top").alias("subroot"), "root", F.explode(F.transform("entries", row)).alias("r"))
    return proofs.select(
        "r.doc_id", "r.leaf", "subroot", "root", "r.proof_sha256", "r.folded_root", (F.col("r.folded_root") == F.col("root")).alias("verified")
    )


def lowered_leaf(columns: tuple[str, ...] = LEAF_COLUMNS, divisor: int = 5) -> Column:
    """The leaf of a row whose text lost its capital letters A-Z, for every
    row whose crc32 of the decimal id is divisible by ``divisor``; the
    untouched leaf for all others and for null ids."""
    id_col, text = F.col(columns[0]), F.col(columns[-1])
    hit = F.crc32(id_col.cast("string").cast("binary")) % divisor == 0
    changed = F.when(hit, F.translate(text.cast("string"), UPPER, LOWER)).otherwise(text.cast("string"))
    return leaf_digest([*(F.col(c) for c in columns[:-1]), changed])
