"""Thin contract queries of the training-data operators.

Each ``opN_<name>`` reads its whole table, applies the operator with its
production parameters and derives the contract's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstream.llm import (
    chunk_prints,
    conversation_repair,
    genetic_packing,
    merkle_manifest,
    ngram_join,
    oracle_sql,
    page_diff,
    piece_models,
    quality_forest,
    repeats,
    secret_forest,
    token_files,
    url_digests,
    vector_cells,
)

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

COMPONENTS_SQL = f"""
    tokens AS MATERIALIZED (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    sets AS MATERIALIZED (
        SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i:i+4] END AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM tokens WHERE len(w) > 0)),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
    links AS MATERIALIZED (
        SELECT a.doc_id AS u, b.doc_id AS v
        FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id != b.doc_id
        JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
        GROUP BY 1, 2, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
    reach AS (
        SELECT doc_id AS v, doc_id AS root FROM documents
        UNION SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.v)"""

ORACLES["op1_ngram_join"] = f"""
WITH RECURSIVE {COMPONENTS_SQL}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT v AS doc_id, min(root) AS component_id FROM reach GROUP BY 1) c ON c.doc_id = d.doc_id"""


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    found = ngram_join.ngram_jaccard_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_piece_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, decoded and held against sentencepiece."""
    return piece_models.check_pieces(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum as read back from token files."""
    folder = token_files.token_folder(spark)
    index = token_files.write_token_files(read(spark, sf_dir, "documents"), vocabulary(), folder, end_id=2)
    return token_files.read_token_files(spark, folder, index)


@query
def op4_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every secret candidate of the documents with the forest's verdict."""
    return secret_forest.scan_secrets(read(spark, sf_dir, "documents"))


@query
def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document loses to 50-byte strings of earlier documents."""
    return repeats.repeat_report(read(spark, sf_dir, "documents"))


@query
def op6_page_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return page_diff.extract_main_text(read(spark, sf_dir, "pages"))


#: The rules of the contract (host, path, verdict).
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

ORACLES["op7_url_digests"] = r"""
WITH parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                          ('com', '/fr/', 'allow'), ('com', '/de/', 'block'))
SELECT page_id, host, path,
       (SELECT arg_max(h || p, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS rule,
       coalesce((SELECT arg_max(v, length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)), 'allow') AS verdict
FROM parts"""


@query
def op7_url_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url under the fixed rules."""
    store = url_digests.write_store(url_digests.rule_table(spark, URL_RULES))
    return url_digests.judge_urls(read(spark, sf_dir, "pages"), store)


@query
def op8_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics and isolation-forest verdict of every document."""
    docs = read(spark, sf_dir, "documents")
    forest = quality_forest.fit_forest(docs, read(spark, sf_dir, "labels"))
    return quality_forest.score_quality(docs, forest)


@query
def op9_chunk_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk fingerprints of every document, its edited form and neighbour."""
    return chunk_prints.fingerprint_documents(read(spark, sf_dir, "documents"))


@query
def op10_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return genetic_packing.pack_documents(read(spark, sf_dir, "documents"), vocabulary(), capacity=2048, end_id=0)


ORACLES["op11_conversation_repair"] = oracle_sql.conversations_sql()


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every damaged conversation's faults, cheapest edits and repaired form."""
    damaged = conversation_repair.damage_conversations(read(spark, sf_dir, "conversations"))
    return conversation_repair.repair_conversations(damaged)


ORACLES["op12_merkle_manifest"] = oracle_sql.merkle_sql()


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest, a fifth of them tampered."""
    return merkle_manifest.merkle_manifest(read(spark, sf_dir, "documents"), tampered=merkle_manifest.lowered_leaf())


ORACLES["op13_vector_cells"] = oracle_sql.embeddings_sql()


@query
def op13_vector_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding."""
    return vector_cells.embedding_components(read(spark, sf_dir, "embeddings"))
