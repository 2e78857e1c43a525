from pyspark.sql import functions as F

import corpus_pipeline
from quillstream.llm import quality_forest
from quillstream.llm.scratch import cut
from tests.conftest import SMALL
from tests.llm.cases import prose
from tests.llm.test_ngram_join import brute as brute_groups
from tests.llm.test_repeats import brute as brute_repeats


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = cut(stage(spark, docs, SMALL), name)
        if name != "packing":
            assert docs.columns == columns and docs.schema == inputs[name].schema
    texts = {n: [(r["doc_id"], r["text"]) for r in d.collect()] for n, d in inputs.items()}

    forest = quality_forest.fit_forest(inputs["quality_rules"], spark.read.parquet(f"{SMALL}/labels.parquet"))
    kept = quality_forest.score_quality(inputs["quality_rules"], forest).where("kept").collect()
    assert sorted(i for i, _ in texts["near_duplicates"]) == sorted(r["doc_id"] for r in kept)

    groups = brute_groups(texts["near_duplicates"])
    assert sorted(i for i, _ in texts["repeated_passages"]) == sorted({c for _, c in groups.values()})

    report = {r[0]: r for r in brute_repeats(texts["repeated_passages"])}
    before, after = dict(texts["repeated_passages"]), dict(texts["secrets"])
    assert before.keys() == after.keys()
    for i, text in after.items():
        assert (text == before[i]) == (report[i][2] == 0)
    assert inputs["secrets"].where("n_chars != length(text)").count() == 0

    final = docs.collect()
    assert {r["doc_id"] for r in final} == set(after)
    assert sum(r["length"] for r in final) > 0 and all(r["offset"] + r["length"] <= 2048 for r in final)
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()) == sorted(r["doc_id"] for r in final)


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SMALL), name)
        assert docs.count() == 0


def edge_table(spark, docs):
    """Rows with nulls, copies, repeated ids and secrets, in a table whose
    further columns are named like the stages' own."""
    some = docs.limit(40).select("doc_id", "text", "lang", "source", "n_chars")
    long = prose(1, 120)
    rows = [
        (None, long, "en", "s", 1), (None, long, "en", "s", 1), (None, prose(2, 90) + " password = correct-horse7-battery", None, None, None),
        (9001, long, None, "s", None), (9002, long + " and a tail", "en", None, 2), (9003, None, "en", "s", 3), (9004, "", "en", "s", 0),
        (9005, prose(3, 100), "en", "s", 4), (9005, prose(3, 100), "en", "s", 4), (9006, prose(4, 20_000), "en", "s", 5), (None, None, "en", "s", 6),
    ]
    extra = spark.createDataFrame(rows, some.schema)
    clash = {c: F.lit(c) for c in ("marked", "spans", "whole", "found_in", "_secrets", "cls", "key", "label")}
    return some.unionByName(extra).withColumns(clash)


def test_stages_take_edge_rows_and_clashing_names(spark):
    docs = edge_table(spark, spark.read.parquet(f"{SMALL}/documents.parquet"))
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, cut(stage(spark, docs, SMALL), name)
        if name != "packing":
            assert docs.columns == before.columns
            assert docs.where(" or ".join(f"`{c}` != '{c}'" for c in ("marked", "spans", "whole", "found_in", "_secrets", "cls", "key", "label"))).count() == 0
        rows = docs.collect()
        if name == "quality_rules":
            assert {r["doc_id"] for r in rows}.isdisjoint({9003, 9004}) and all(r["text"] for r in rows)
        if name == "near_duplicates":
            ids = [r["doc_id"] for r in rows if r["doc_id"] is not None]
            assert len(ids) == len(set(ids)) and 9001 in ids and 9002 not in ids and 9005 in ids
            assert sum(r["doc_id"] is None for r in rows) == 1  # one is a copy of 9001, one of the other
        if name == "secrets":
            assert not any("correct-horse7-battery" in (r["text"] or "") for r in rows)
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()}
