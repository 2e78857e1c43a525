import random

import duckdb
import numpy as np

from quillstream.llm import conversation_repair as cr
from quillstream.llm.catalog import ORACLES, QUERIES
from tests.conftest import MEDIUM

NAME = "op11_conversation_repair"
SCHEMA = "conv_id long, turn long, role string, text string"


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    if rows:
        con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(ORACLES[NAME]).fetchall(), key=repr)


def by_spark(spark, rows, partitions=3, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(partitions)
    return sorted((tuple(r) for r in cr.repair_conversations(cr.damage_conversations(df)).collect()), key=repr)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{MEDIUM}/conversations.parquet')")
    cursor = con.execute(ORACLES[NAME])
    df = QUERIES[NAME](spark, MEDIUM)
    assert df.columns == [d[0] for d in cursor.description]
    assert sorted(tuple(r) for r in df.collect()) == sorted(cursor.fetchall())


def test_edge_rows(spark):
    """Null keys, roles and texts, ties, repeated rows, odd roles, long texts."""
    rows = [
        (None, 0, "user", "Hi."), (None, None, None, None), (None, 1, "assistant", "Yes."),
        (1, None, "user", "A."), (1, None, "user", "B."), (1, 3, "assistant", None), (1, 3, "", ""),
        (2, 0, "tool", "x."), (2, 0, "User", "x."), (2, 5, "system", "late."), (2, 5, "system", "late."),
        (3, 0, "user", "\t \n"), (3, 1, "assistant", "no end"), (3, 2, "user", "ok! \n"),
        (4, -5, "assistant", "x" * 200_000 + "."), (4, 10**12, "user", "é。"), (4, 7, "assistant", "日本."),
        (5, 0, "system", "s."), (6, 0, "assistant", "a."), (7, 0, "user", "u."), (8, 1, "user", " "),
    ]
    rows += [(100 + i, t, "user" if t % 2 == 0 else "assistant", f"t{t}.") for i in range(60) for t in range(3)]
    rows += [(9, 4, "user", "same.")] * 12
    found = by_spark(spark, rows)
    assert found == by_sql(rows)
    assert len(found) == len({r[0] for r in rows})


def test_empty_table_and_clashing_columns(spark):
    assert by_spark(spark, []) == []
    rows = [(1, 0, "user", "Hi.", "x", True, 1, "m"), (1, 1, "assistant", "Yes.", "y", None, 2, None)]
    schema = SCHEMA + ", audit string, kind boolean, rid int, byte string"
    assert by_spark(spark, rows, schema=schema) == by_sql([r[:4] for r in rows])


def test_conversations_cut_by_ranges(spark):
    """One conversation with most of the rows spans several ranges."""
    rng = random.Random(5)
    role = lambda: rng.choice(["user", "user", "assistant", "assistant", "system", "tool"])
    rows = [(7, t // 2, role(), f"{rng.choice('abcdefgh')} text {rng.randrange(300)}{rng.choice(['.', '!', '', ' '])}") for t in range(900)]
    rows += [(c, t, role(), f"line {c} {t}.") for c in range(20) for t in range(rng.randrange(6)) if c != 7]
    expected = by_sql(rows)
    assert by_spark(spark, rows) == expected
    dealt = spark.createDataFrame(rows, SCHEMA)
    assert dealt.repartitionByRange(8, "conv_id", "turn").where("conv_id = 7").selectExpr("spark_partition_id() p").distinct().count() > 2


def best_edit(codes):
    """(cost, audit) by trying all edits in breadth."""
    layer = {cr.NOTHING: (0, "")}

    def inserts(found):
        for _ in range(3):
            for state, (cost, audit) in list(found.items()):
                to, new = int(cr.FORCED[state]), (cost + 2, audit + "I")
                found[to] = min(found.get(to, new), new)
        return found

    layer = inserts(layer)
    for byte in codes:
        after, extra = {}, 1 if byte & cr.TRUNCATED else 0
        for state, (cost, audit) in layer.items():
            options = [(state, cost + 3, "D")]
            if not byte & (cr.BLANK | cr.DUPLICATE):
                options.append((int(cr.FORCED[state]), cost + 2 + extra, "R"))
                if cr.KEPT[state, byte & 3] >= 0:
                    options.append((int(cr.KEPT[state, byte & 3]), cost + extra, "K"))
            for to, price, letter in options:
                after[to] = min(after.get(to, (price, audit + letter)), (price, audit + letter))
        layer = inserts(after)
    return min(layer[s] for s in (cr.NOTHING, cr.ASSISTANT) if s in layer)


def test_ranked_paths_are_cheapest_and_least():
    rng = random.Random(8)
    batch = [[rng.choice([0, 1, 1, 2, 2, 3]) + rng.choice([0, 0, 0, 4, 8, 16]) for _ in range(rng.choice([0, 1, 2, 5, 9, 30]))] for _ in range(400)]
    sizes = np.array([len(c) for c in batch])
    solved = cr.Solved(np.array([b for c in batch for b in c]), sizes, np.tile(cr.END_COST, (len(batch), 1)))
    texts, exits = solved.paths(cr.NOTHING)
    costs = solved.cost[solved.first, cr.NOTHING]
    for codes, text, end, cost in zip(batch, texts, exits, costs, strict=True):
        assert (int(cost), text + cr.END_LETTERS[end]) == best_edit(codes)


def test_pieces_chain_to_the_whole():
    rng = random.Random(9)
    for _ in range(60):
        codes = np.array([rng.choice([0, 1, 2, 3]) + rng.choice([0, 0, 4, 16]) for _ in range(rng.randrange(1, 25))])
        cuts = sorted(rng.randrange(len(codes) + 1) for _ in range(3))
        parts = np.split(codes, cuts)
        ends = cr.chain_costs([cr.transfer(p) for p in parts])
        state, audit = cr.NOTHING, ""
        for part, end in zip(parts, ends, strict=True):
            texts, exits = cr.Solved(part, np.array([len(part)]), np.array([end])).paths(state)
            audit, state = audit + texts[0], int(exits[0])
        assert audit + cr.END_LETTERS[state] == best_edit(codes)[1]
