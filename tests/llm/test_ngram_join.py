import random
import re
import string

import duckdb

from quillstream.llm import ngram_join
from quillstream.llm.catalog import ORACLES, QUERIES
from quillstream.llm.components import connected_components
from tests.conftest import SMALL
from tests.llm.cases import edge_frame, edge_rows, empty_frame, prose

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    """{doc_id: (set size, component)} by comparing all pairs; null ids are
    left out."""
    sets = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        grams = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
        sets.append((i, grams))
    group = {i: i for i, _ in sets if i is not None}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if None not in (i, j) and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(i), root(j)))
                group[high] = low
    return {i: (len(x), root(i)) for i, x in sets if i is not None}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect() if r["doc_id"] is not None}


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    df = QUERIES["op1_ngram_join"](spark, SMALL)
    assert df.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(tuple(r) for r in df.collect()) == sorted(con.execute(ORACLES["op1_ngram_join"]).fetchall())


def test_edge_rows(spark):
    df = ngram_join.ngram_jaccard_components(edge_frame(spark))
    rows = df.collect()
    assert len(rows) == len(edge_rows())
    assert found(df) == brute(edge_rows())
    nameless = [r for r in rows if r["doc_id"] is None]
    assert [(r["class_id"], r["component_id"]) for r in nameless] == [(None, None)]


def test_empty_table(spark):
    assert ngram_join.ngram_jaccard_components(empty_frame(spark)).count() == 0


def test_chains_of_near_copies_and_a_common_passage(spark):
    """A chain links its ends although they are not similar; texts that share
    a frequent passage only stay apart; a large group needs star rounds."""
    rng = random.Random(3)
    rows, passage = [], prose(50, 30)
    words = prose(51, 120).split()
    for i in range(60):  # each step changes one more word
        words[(7 * i) % 120] = f"w{i}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, prose(100 + i, 60) + " " + passage) for i in range(40)]
    base = prose(52, 100).split()
    for i in range(80):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(100)] = rng.choice(base)
        rows.append((3000 + i, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    assert len({c for _, c in expected.values()}) < len(rows) - 60
    assert found(ngram_join.ngram_jaccard_components(df)) == expected


def test_prefix_filter_keeps_every_pair_at_the_threshold():
    """Property of the lengths used: at the least overlap allowed, order-1
    prefixes share as many tokens as are asked for."""
    rng = random.Random(1)
    for _ in range(3000):
        n = rng.randint(1, 60)
        x = set(rng.sample(range(200), n))
        y = {t for t in x if rng.random() > 0.12} | set(rng.sample(range(200, 260), rng.randint(0, 6)))
        if y and 100 * len(x & y) >= 75 * len(x | y):
            for extra in (0.05, 0.15):
                cut = lambda s: set(sorted(s)[: ngram_join.hash_prefix_length(len(s), 0.75, extra)])  # noqa: B023, E731
                shared = len(cut(x) & cut(y))
                assert shared >= ngram_join.shared_needed(len(x), 0.75, extra)
                assert shared >= ngram_join.shared_needed(len(y), 0.75, extra)


def test_components_of_paths_stars_and_self_links(spark):
    links = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2), (2, 3)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(links, "u long, v long")).distinct().collect())
    assert got == {**{i: 10 for i in range(10, 41)}, **{i: 100 for i in range(100, 160)}, 2: 2, 3: 2}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def template_rows(n, seed=4):
    """Texts of one template that share about 0.68 and link with nothing."""
    rng = random.Random(seed)
    base = prose(90, 200).split()
    rows = []
    for i in range(n):
        own = list(base)
        for k in rng.sample(range(0, 200, 5), 8):
            own[k] = f"x{i}y{k}"
        rows.append((i, " ".join(own)))
    return rows


def test_a_template_group_makes_no_square_of_pairs(spark, monkeypatch):
    """The pairs that are compared grow with the group, not with its square."""
    made = []
    verified = ngram_join._verified

    def counted(pairs, orders, threshold):
        made.append(pairs.count())
        return verified(pairs, orders, threshold)

    monkeypatch.setattr(ngram_join, "_verified", counted)
    sums = []
    for n in (200, 400, 800):
        made.clear()
        df = spark.createDataFrame(template_rows(n), "doc_id long, text string")
        got = ngram_join.ngram_jaccard_components(df).where("component_id != doc_id").count()
        assert got == 0
        sums.append(sum(made))
    assert sums[2] <= 5 * max(sums[0], 100) and sums[2] < 800 * 8


def test_wide_buckets_by_size_bands(spark, monkeypatch):
    """Near copies of one text, with edits and other lengths, in buckets
    that are all wide: the result of comparing all pairs."""
    rng = random.Random(12)
    base = prose(53, 120).split()
    rows = []
    for i in range(140):
        own = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6])):
            k = rng.randrange(len(own))
            own[k : k + rng.choice([0, 1, 2])] = [f"e{rng.randrange(40)}"] * rng.choice([0, 1, 1, 3])
        rows.append((i, " ".join(own)))
    rows += template_rows(60)
    rows = [(k, text) for k, (_, text) in enumerate(rows)]
    monkeypatch.setattr(ngram_join.ngram_links, "__defaults__", (3,))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(ngram_join.ngram_jaccard_components(df)) == brute(rows)


def test_prefixes_are_dealt_by_token_once(spark, monkeypatch):
    from collections import defaultdict

    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 60))) for _ in range(40)]
    texts += [t.rsplit(" ", 1)[0] for t in texts] + texts[:5] + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = ngram_join.cut(ngram_join.document_sets(docs, 5, 0.75, 0.15, "doc_id", "text"), "sets")
    frames = []
    monkeypatch.setattr(ngram_join, "cut", lambda df, name: frames.append(df) or df)
    got = [r["cid"] for r in ngram_join._survivors(sets, 0.75, 0.15).collect()]
    owners, own = defaultdict(set), {}
    for r in sets.selectExpr("xxhash64(digest) cid", "n_shingles n", "prefix").where("size(prefix) > 0").collect():
        own[r["cid"]] = r
        for tok in r["prefix"]:
            owners[tok].add(r["cid"])
    want = {c for c, r in own.items() if sum(len(owners[t]) > 1 for t in r["prefix"]) >= ngram_join.shared_needed(r["n"], 0.75, 0.15)}
    assert len(got) == len(set(got)) and set(got) == want and 0 < len(want) < len(own)
    frames[0].collect()
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    assert len(frames) == 1 and "ReusedExchange" in plan.split("Initial Plan")[0]
