"""Conversation structure repair (operator 11).

A conversation is a row of turns.  Its role initials must read
``(s?(ua)+)?``; cheapest edits (keep, delete, rerole, insert) bring it
there.  The states of that pattern are: nothing yet, after s, after u,
after a.  A *node* is (rows done, state); an edit is an arc between nodes,
and a letter leads from a node to one other node at most.

1. Cost DP, from the end: the cost of every node to the end.
2. Path ranking by prefix doubling: the arcs on cheapest paths stay.  A node
   is ranked by the least audit (edit initials) of 1 letter that leaves it,
   then of 2, 4, 8, ... letters: the rank of twice the length is that of
   the pair (rank of the node, rank of the node its pointer leads to), and
   the pointer is doubled.
3. Ranks select each node's arc; doubled pointers of the selected arcs give
   the node after any number of letters, so the least path of every
   conversation is read off without a walk.

All three run as array operations over the nodes of many conversations.

Spark's part: rows are dealt by *ranges* of (conversation, turn), so a
conversation of any length is cut into pieces that other tasks hold.  A
piece that a range's ends do not touch is a whole conversation and is solved
where it is.  The at most two others of each range give a 4 x 4 matrix of
their costs; these are chained per conversation, which tells every piece
its costs to the end, and then its entry state.  A row is one byte in all
this.  Texts are read once more at the end, streamed in order behind their
conversation's audit into the digest of the repaired conversation (a
sequential digest: one task for one conversation, without holding it).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.scratch import cut
from quillstream.operators.ids import partitions_for

SPACES = " \t\n\x0b\x0c\r"
# states of the pattern and the state after an inserted or reroled turn
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FORCED = np.array([USER, USER, ASSISTANT, USER])
# state after a kept turn by role initial (s, u, a, other); -1: not allowed
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
INITIALS = "sua"
# letters in ASCII order and their costs
LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
COST = np.array([3, 2, 0, 2])
# what ends a conversation from each state: cost and letters
END_COST = np.array([0, 4, 2, 0])
END_LETTERS = ["", "II", "I", ""]
FAR = 1 << 60

# bits of a row's byte: role initial in the lowest two
BLANK, DUPLICATE, TRUNCATED, DROPPED = 4, 8, 16, 32

#: Rows that a range of the narrow rows aims at, and a batch that is solved at once.
PIECE_ROWS, SOLVE_ROWS = 200_000, 20_000


class Solved:
    """Cost DP and path ranking over a batch of conversations.

    ``codes`` holds their rows' bytes one after the other, ``sizes`` the
    rows of each and ``ends`` (batch x 4) the cost behind the last row by
    state.  Node (row i, state x) of conversation c is
    4 * (first[c] + i) + x; the last row is followed by its end nodes."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> None:
        self.sizes = np.asarray(sizes, dtype=np.int64)
        self.first = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        total = int((self.sizes + 1).sum())
        last = self.first + self.sizes
        self.row = np.zeros(total, dtype=np.int64)
        is_row = np.ones(total, dtype=bool)
        is_row[last] = False
        self.row[is_row] = codes
        self.is_row = is_row
        self.cost = np.zeros((total, 4), dtype=np.int64)
        self.cost[last] = ends
        self._costs(last)

    def _arcs(self, rows: np.ndarray):
        """(cost, target row, target state) of the four letters at each node
        of ``rows``; FAR where a letter is not allowed."""
        byte = self.row[rows]
        gone = ((byte & (BLANK | DUPLICATE)) != 0)[:, None]
        extra = ((byte & TRUNCATED) != 0).astype(np.int64)[:, None]
        kept = KEPT[:, byte & 3].T
        state = np.broadcast_to(np.arange(4), kept.shape)
        forced = np.broadcast_to(FORCED, kept.shape)
        whole = np.ones(kept.shape, dtype=np.int64)
        keep = np.where(gone | (kept < 0), FAR, COST[KEEP] + extra)
        rerole = np.where(gone, FAR, COST[REROLE] + extra) * whole
        return [
            (COST[DELETE] * whole, rows + 1, state),
            (COST[INSERT] * whole, rows, forced),
            (keep, rows + 1, np.maximum(kept, 0)),
            (rerole, rows + 1, forced),
        ]

    def _costs(self, last: np.ndarray) -> None:
        order = np.argsort(-self.sizes, kind="stable")
        length = self.sizes[order]
        for step in range(1, int(length[0]) + 1 if len(length) else 0):
            rows = last[order[: np.searchsorted(-length, -step, side="right")]] - step
            best = np.full((len(rows), 4), FAR)
            for letter, (cost, target, state) in enumerate(self._arcs(rows)):
                if letter != INSERT:
                    best = np.minimum(best, cost + self.cost[target[:, None], state])
            # inserts stay at the row: at most two in a run are ever cheapest
            for _ in range(2):
                best = np.minimum(best, COST[INSERT] + best[:, FORCED])
            self.cost[rows] = np.minimum(best, FAR)

    def _rank(self) -> None:
        nodes = self.cost.size
        rows = np.flatnonzero(self.is_row)
        cost, at = self.cost.ravel(), (4 * rows[:, None] + np.arange(4)).ravel()
        open_ = cost[at] < FAR
        arcs = []  # (letter, nodes, targets) on cheapest paths
        for letter, (price, target, state) in enumerate(self._arcs(rows)):
            to = (4 * target[:, None] + state).ravel()
            cheap = open_ & (price.ravel() < FAR) & (price.ravel() + cost[to] == cost[at])
            arcs.append((letter, at[cheap], to[cheap]))
        rank, pointer = np.zeros(nodes, dtype=np.int64), np.arange(nodes)
        for letter, source, to in reversed(arcs):  # the least letter is written last
            rank[source], pointer[source] = letter + 1, to
        moved = (rank > 0).astype(np.int64)
        letters = int(self.sizes.max(initial=0)) * 3 + 1
        for _ in range(max(1, letters.bit_length())):
            pair = rank * (int(rank.max(initial=0)) + 1) + rank[pointer]
            rank = np.unique(pair, return_inverse=True)[1]
            pointer = pointer[pointer]
        # the selected arc of a node: least letter, then least rank behind it
        select, self.letter = np.arange(nodes), np.full(nodes, -1)
        best = np.full(nodes, FAR)
        for letter, source, to in arcs:
            value = letter * (int(rank.max(initial=0)) + 1) + rank[to]
            better = value < best[source]
            hit = source[better]
            best[hit], select[hit], self.letter[hit] = value[better], to[better], letter
        self.doubled, self.moved = [select], moved
        for _ in range(max(1, letters.bit_length())):
            step = self.doubled[-1]
            self.moved = self.moved + self.moved[step]
            self.doubled.append(step[step])

    def paths(self, entry: int):
        """Per conversation, entered in state ``entry``: the least audit as
        text and the state behind the last row."""
        if not hasattr(self, "doubled"):
            self._rank()
        start = 4 * self.first + entry
        count = self.moved[start]
        bounds = np.concatenate([[0], np.cumsum(count)])
        place = np.arange(bounds[-1]) - np.repeat(bounds[:-1], count)
        node = np.repeat(start, count)
        for k, pointer in enumerate(self.doubled):
            hit = (place >> k) & 1 == 1
            node[hit] = pointer[node[hit]]
        text = np.frombuffer(LETTERS.encode(), dtype=np.uint8)[self.letter[node]].tobytes().decode()
        exits = self.doubled[-1][start] % 4
        return [text[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)], exits


def transfer(codes: np.ndarray) -> list[int]:
    """Costs of a piece by (state before, state behind), row by row."""
    ends = np.where(np.eye(4, dtype=bool), 0, FAR)
    sizes = np.full(4, len(codes))
    solved = Solved(np.tile(codes, 4), sizes, ends)
    return solved.cost[solved.first].T.ravel().tolist()


def chain_costs(matrices: list[list[int]]) -> list[list[int]]:
    """Costs behind each piece of a conversation, given all its matrices."""
    after, out = END_COST.copy(), []
    for matrix in reversed(matrices):
        out.append(after.tolist())
        after = np.minimum((np.array(matrix).reshape(4, 4) + after).min(axis=1), FAR)
    return out[::-1]


class Piece:
    """What a range holds of one conversation, filled in row order."""

    FIELDS = ("rows", "blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self, conv, opens: bool) -> None:
        self.conv, self.open = conv, opens
        self.codes: list[np.ndarray] = []
        self.rows = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, byte: np.ndarray, turn: np.ndarray, known: np.ndarray) -> None:
        live = (byte & DROPPED) == 0
        byte, turn, known = byte[live], turn[live], known[live]
        if not len(byte):
            return
        self.rows += len(byte)
        self.blank += int(((byte & BLANK) != 0).sum())
        self.duplicate += int(((byte & DUPLICATE) != 0).sum())
        self.truncated += int(((byte & TRUNCATED) != 0).sum())
        initial = byte & 3
        if self.last is not None:
            self.illegal += not _legal(self.last, int(initial[0]))
        pairs = initial[:-1] * 4 + initial[1:]
        self.illegal += int((~np.isin(pairs, LEGAL_PAIRS)).sum())
        self.first = int(initial[0]) if self.first is None else self.first
        self.last = int(initial[-1])
        turn = turn[known]
        if len(turn):
            self.turns += int((np.diff(turn) != 0).sum()) + (self.high is None or self.high != turn[0])
            self.low = int(turn[0]) if self.low is None else self.low
            self.high = int(turn[-1])
        self.codes.append(byte.astype(np.uint8))

    def bytes(self) -> np.ndarray:
        return np.concatenate(self.codes or [np.empty(0, np.uint8)])


LEGAL_PAIRS = [INITIALS.index(a) * 4 + INITIALS.index(b) for a, b in ("su", "ua", "au")]


def _legal(a: int, b: int) -> bool:
    return a * 4 + b in LEGAL_PAIRS


PIECES = (
    "conv_id bigint, part int, open boolean, rows bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "turns bigint, first int, last int, low bigint, high bigint, cost bigint, audit string, codes binary, matrix array<bigint>"
)


def _pieces(rows: DataFrame) -> DataFrame:
    """Pieces of the conversations of each range; whole ones are solved."""
    names = [f.split()[0] for f in PIECES.split(", ")]

    def read(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def table(pieces: list[Piece]):
            whole = [p for p in pieces if not p.open]
            audits, costs = iter(()), iter(())
            if whole:
                sizes = np.array([p.rows for p in whole])
                solved = Solved(np.concatenate([p.bytes() for p in whole]), sizes, np.tile(END_COST, (len(whole), 1)))
                texts, ends = solved.paths(NOTHING)
                audits = iter([t + END_LETTERS[e] for t, e in zip(texts, ends, strict=True)])
                costs = iter(solved.cost[solved.first, NOTHING].tolist())
            out = []
            for p in pieces:
                codes = p.bytes() if p.open else None
                out.append(
                    (p.conv, part, p.open, p.rows, p.blank, p.duplicate, p.truncated, p.illegal, p.turns, p.first, p.last, p.low, p.high)
                    + ((None, None, codes.tobytes(), transfer(codes)) if p.open else (next(costs), next(audits), None, None))
                )
            types = [pa.int64(), pa.int32(), pa.bool_(), *[pa.int64()] * 6, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64())]
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        done, held, now = [], 0, None
        for batch in batches:
            conv = batch.column(0)
            n = len(conv)
            if not n:
                continue
            valid = np.asarray(conv.is_valid())
            ids = np.asarray(conv.fill_null(0))
            known = np.asarray(batch.column(1).is_valid())
            turn = np.asarray(batch.column(1).fill_null(0))
            byte = np.asarray(batch.column(2)).astype(np.int64)
            cuts = np.flatnonzero((ids[1:] != ids[:-1]) | (valid[1:] != valid[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, n], strict=True):
                own = int(ids[a]) if valid[a] else None
                if now is None or own != now.conv:
                    if now is not None:
                        done.append(now)
                        held += now.rows
                    now = Piece(own, opens=now is None)
                now.add(byte[a:b], turn[a:b], known[a:b])
            if held >= SOLVE_ROWS or len(done) >= SOLVE_ROWS:
                yield table(done)
                done, held = [], 0
        if now is not None:
            now.open = True
            yield table([*done, now])

    return rows.mapInArrow(read, PIECES)


def _joined(pieces: DataFrame) -> DataFrame:
    """One row per conversation that ranges cut, with its audit.  There are
    at most two such pieces for each range; only their matrices, exits and
    audits are gathered by conversation, not their rows."""

    def behind(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("part")
        ends = chain_costs([list(m) for m in own["matrix"]])
        return pd.DataFrame({"conv_id": own["conv_id"], "part": own["part"], "ends": ends})

    key = F.struct(F.col("conv_id").isNull().alias("none"), "conv_id").alias("key")
    ends = cut(
        pieces.select(key, "conv_id", "part", "matrix").groupBy("key").applyInPandas(behind, "conv_id bigint, part int, ends array<bigint>"),
        "piece_ends",
    )

    def solve(batches):
        for batch in batches:
            texts, exits, costs = [], [], []
            for codes, end in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                solved = Solved(np.frombuffer(codes, dtype=np.uint8), np.array([len(codes)]), np.array([end]))
                found = [solved.paths(x) for x in range(4)]
                texts.append([t[0] for t, _ in found])
                exits.append([int(e[0]) for _, e in found])
                costs.append(solved.cost[0].tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32())), pa.array(costs, pa.list_(pa.int64()))],
                names=["conv_id", "part", "texts", "exits", "costs"],
            )

    same = F.col("p.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("p.part") == F.col("e.part"))
    solved = cut(
        pieces.alias("p")
        .join(ends.alias("e"), same)
        .select("p.conv_id", "p.part", "p.codes", "e.ends")
        .mapInArrow(solve, "conv_id bigint, part int, texts array<string>, exits array<int>, costs array<bigint>"),
        "piece_paths",
    )

    def pick(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("part")
        state, audit, first, total = NOTHING, [], None, dict.fromkeys(Piece.FIELDS, 0)
        last = low = high = None
        for p in own.itertuples():
            first = p.costs[NOTHING] if first is None else first
            audit.append(p.texts[state])
            state = p.exits[state]
            for name in Piece.FIELDS:
                total[name] += getattr(p, name)
            if p.rows:
                total["illegal"] += last is not None and not _legal(last, int(p.first))
                last = int(p.last)
            if p.turns:
                total["turns"] -= high is not None and high == p.low
                low, high = p.low if low is None else low, p.high
        audit.append(END_LETTERS[state])
        # turns go as text: pandas would make a nullable integer a float
        row = {"conv_id": own["conv_id"].iloc[0], **total, "low": low, "high": high, "cost": first, "audit": "".join(audit)}
        return pd.DataFrame({k: [v] for k, v in row.items()}).astype({"conv_id": object, "low": object, "high": object})

    told = pieces.select(key, "conv_id", "part", *Piece.FIELDS, "first", "last", "low", "high")
    both = told.alias("p").join(solved.alias("e"), same).select("p.*", "e.texts", "e.exits", "e.costs")
    text = [F.col(c).cast("string").alias(c) for c in ("conv_id", "low", "high")]
    schema = "conv_id string, " + ", ".join(f"{c} bigint" for c in Piece.FIELDS) + ", low string, high string, cost bigint, audit string"
    return (
        both.select("key", "part", *Piece.FIELDS, "first", "last", "texts", "exits", "costs", *text)
        .groupBy("key")
        .applyInPandas(pick, schema)
        .select(F.col("conv_id").cast("long"), *Piece.FIELDS, F.col("low").cast("long"), F.col("high").cast("long"), "cost", "audit")
    )


RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string"
)


def _digests(lines: DataFrame) -> DataFrame:
    """Streams (header, then rows in order) of whole conversations, sorted,
    into result rows.  Nothing but the audit is held."""
    names = [f.split()[0] for f in RESULT.split(", ")]
    types = [*[pa.int64()] * 7, pa.string(), pa.string()]

    def read(batches):
        head, out = None, []

        def write(line: str) -> None:
            nonlocal empty
            digest.update(line.encode() if empty else b"\n" + line.encode())
            empty = False

        def inserted(upto: bool = False) -> None:
            """Inserts before the next edit of a row."""
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                state = int(FORCED[state])
                write(f"{NEW_ROLE[state]}:")
                at += 1

        def close() -> None:
            inserted()
            out.append((*head, digest.hexdigest()))

        for batch in batches:
            rows = batch.to_pydict()
            for i, audit_here in enumerate(rows["audit"]):
                if audit_here is not None:
                    if head is not None:
                        close()
                    head = tuple(rows[c][i] for c in names[:-1])
                    audit, at, state, empty, digest = audit_here, 0, NOTHING, True, hashlib.sha256()
                    continue
                inserted()
                letter, role, text = audit[at], rows["role"][i], rows["text"][i]
                at += 1
                if letter == "D":
                    continue
                if letter == "R":
                    state = int(FORCED[state])
                    role = NEW_ROLE[state]
                else:
                    state = int(KEPT[state, INITIALS.index(role[:1])])
                write(f"{role}:{text}")
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out = []
        if head is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return lines.mapInArrow(read, RESULT)


NEW_ROLE = {USER: "user", ASSISTANT: "assistant"}


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, and optional
    ``copy`` and ``dropped``): gaps, blank, duplicate, truncated, illegal,
    cost, audit (initials of the cheapest edits, ASCII-least among equals)
    and repaired_sha256 (``role:text`` of the repaired turns, newline-joined).

    Rows with ``dropped`` only make their conversation appear.  ``copy`` 0 and
    1 are a row and its repetition, which stand next to each other.

    Defined cases: a null role or text is one space; null turns come first
    and count neither for gaps nor as turns; rows of one turn are ordered by
    the md5 of ``role:text`` (``tie`` when given), copies last, so equal rows
    are interchangeable; a null conversation id is a conversation of its own;
    a conversation without rows has zeros, an empty audit and the digest of
    no bytes; an empty table gives no rows; further columns are ignored; a
    conversation may be longer than any task's share of the rows."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    tie = F.col("tie") if "tie" in rows.columns else F.unhex(F.md5(F.concat(role, F.lit(":"), text)))
    copy = F.col("copy") if "copy" in rows.columns else F.lit(0)
    dropped = F.col("dropped") if "dropped" in rows.columns else F.lit(False)
    turns = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text,
        tie.alias("tie"), copy.cast("int").alias("copy"), dropped.alias("dropped"),
    )
    solid = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1)) - 1
    initial = F.when((F.col("role") == "") | (initial < 0), 3).otherwise(initial)
    narrow = turns.select(
        "conv_id", "turn", "tie", "copy", "dropped", initial.alias("initial"),
        (solid == "").alias("blank"), (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))).alias("same"),
        F.monotonically_increasing_id().alias("rid"),
    )
    narrow = cut(narrow, "turns")
    order = ["conv_id", "turn", "tie", "copy", "rid"]
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "tie", "copy", "rid")
    first = (
        narrow.where(~F.col("dropped") & ~F.col("blank"))
        .groupBy("conv_id", "same")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
    )
    met = F.col("r.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("r.same") == F.col("f.same"))
    again = F.col("f.first").isNotNull() & (place != F.col("f.first")) & ~F.col("blank")
    byte = (
        F.col("initial")
        + F.when(F.col("blank"), BLANK).when(again, DUPLICATE).when(F.col("cut"), TRUNCATED).otherwise(0)
        + F.when(F.col("dropped"), DROPPED).otherwise(0)
    )
    marked = narrow.alias("r").join(first.alias("f"), met, "left")
    marked = marked.select("r.conv_id", "turn", "tie", "copy", "rid", byte.cast("int").alias("byte"))
    ranges = max(1, -(-narrow.count() // PIECE_ROWS), partitions_for(narrow))
    dealt = marked.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    pieces = cut(_pieces(dealt.select("conv_id", "turn", "byte")), "pieces")
    figures = ["conv_id", *Piece.FIELDS, "low", "high", "cost", "audit"]
    solved = pieces.where(~F.col("open")).select(figures).unionByName(_joined(pieces.where("open")).select(figures))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    counts = [F.col(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    heads = solved.select(
        "conv_id", gaps.cast("long").alias("gaps"), *counts, "audit",
        F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("tie"), F.lit(0).alias("copy"),
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"),
    )
    lines = heads.unionByName(turns.where(~F.col("dropped")).drop("dropped"), allowMissingColumns=True)
    header = F.col("audit").isNull()
    sorted_ = lines.repartition("conv_id").sortWithinPartitions("conv_id", header, "turn", "tie", "copy")
    return _digests(sorted_)


def damage_conversations(rows: DataFrame) -> DataFrame:
    """Faults planted by crc32(``conv_id:turn``) % 20: 0 drops the row, 1
    empties its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes its role
    user.  Nulls are one space."""

    def value(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(value("conv_id"), F.lit(":"), value("turn")).cast("binary")) % 20
    role, text = value("role"), value("text")
    faulty = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.unhex(F.md5(F.concat(role, F.lit(":"), text))).alias("tie"),
    )
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return faulty.select("conv_id", "turn", "role", "text", "tie", (F.col("kind") == 0).alias("dropped"), F.explode(copies).alias("copy"))
