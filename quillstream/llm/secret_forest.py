"""Secret scan with a random forest against false positives (operator 4).

Everything runs as DataFrame and SQL functions.  Candidates are values of six
or more characters that a URL gives as a login's password or that are assigned
to a secret-like name, and long tokens; none needs a digit.  Each one gets
numbers for its length, its character classes and the transitions between
them, the share of it that dictionary words cover, whether it stands in a
path or URL, and the words beside it.  A random forest (Spark ML), trained
on a bounded sample of labelled findings, keeps the true ones.

The dictionary is every word that at least a share of the documents, and at
least two, have, counted over the whole corpus.  Without labelled findings of
the user's own, ``seed_labels`` labels those whose form and neighbours leave
no doubt, and the forest is trained on them.  Every verdict is the forest's:
a seed is a training row, never a result.  The threshold is set on a held-out
part of the labelled findings (``calibrated``), whose precision and recall
``held_out`` reports.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.scratch import cut, drop, free_name

#: Names of variables that hold secrets.
SECRET_NAMES = "password|passwd|pwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer"
#: Names beside numbers and digests that are no secrets.
PLAIN_NAMES = "sha1|sha256|md5|hash|digest|checksum|commit|revision|uuid|guid|order|invoice|card|phone|tel|isbn|version|id"
#: Published prefixes of access tokens.
KNOWN_PREFIX = "^(AKIA|ASIA|ghp_|gho_|ghs_|github_pat_|glpat-|xox[abpr]-|sk_live_|rk_live_|AIza|SG\\.|eyJ)"
TOKEN = "[A-Za-z0-9+/_-]"
#: What may follow a secret-like name: SECRET_KEY, tokens, apiKeyValue, auth.value.
NAME_END = "s?(?:(?:[0-9_.-]|(?<=[a-z])[A-Z])[A-Za-z0-9_.-]{0,48}|)"
#: Characters that end an unquoted value unless more of the value follows them.
STOP = "[,;&.)\\]}\"']"
VALUE = (
    "(?:(?<=\")(?=[^\"\\s][^\"\\n]{5})[^\"\\\\\\n]*+(?:\\\\.[^\"\\\\\\n]*+){0,256}+(?=\")"
    "|(?<=')(?=[^'\\s][^'\\n]{5})[^'\\\\\\n]*+(?:\\\\.[^'\\\\\\n]*+){0,256}+(?=')"
    f"|[^\\s<>,;&.)\\]}}\"']++(?:{STOP}(?![\\s<>]|{STOP}|$|[A-Za-z_][A-Za-z0-9_.-]{{0,40}}[\"']?[ \\t]{{0,3}}[=:])[^\\s<>,;&.)\\]}}\"']++){{0,256}}+)"
)
LOGIN = "(?<=[A-Za-z0-9+.-]://[^\\s/?#:]{0,64}:)"
CANDIDATE = (
    # the short look-behinds spare most places the long ones, which imply them
    f"(?<=:){LOGIN}[^\\s/?#\"'<>]{{6,}}(?=@)"
    "|(?<=[=: \\t\"'])(?<=[=:][ \\t]{0,3}[\"']?)"
    f"(?<=(?i:{SECRET_NAMES}){NAME_END}[\"']?[ \\t]{{0,3}}[=:][ \\t]{{0,3}}[\"']?){VALUE}"
    f"|(?<!{TOKEN}){TOKEN}{{16,}}+"
)
REDACTED = "[SECRET]"

FEATURES = [
    "length", "digits", "uppers", "lowers", "others", "hex", "changes", "distinct", "longest_digits", "covered", "known_prefix",
    "in_path", "slashes", "assigned", "quoted", "named_secret", "named_plain", "given", "one_word",
]


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ordinal, candidate, before, after) of every candidate; before
    and after hold up to 80 and 40 characters of the text beside it."""
    text = F.col("text")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    key = F.when(F.col("doc_id").isNull(), F.md5("text")).alias("row_key")
    searched = own.select("doc_id", key, F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("c"), text)
    found = searched.select("doc_id", "row_key", "c", F.when(F.size("c") > 0, F.split(text, CANDIDATE, -1)).alias("gaps"))
    piece = lambda name, i: F.coalesce(F.get(name, i), F.lit(""))
    beside = F.transform(
        "c",
        lambda c, i: F.struct(
            c.alias("candidate"),
            # a name beside it may be a candidate itself
            F.right(F.concat(piece("gaps", i - 1), piece("c", i - 1), piece("gaps", i)), F.lit(80)).alias("before"),
            F.left(F.concat(piece("gaps", i + 1), piece("c", i + 1), piece("gaps", i + 2)), F.lit(40)).alias("after"),
        ),
    )
    long_enough = F.filter(beside, lambda f: F.length(f["candidate"]) >= 6)
    # outer: a row filter before it would run the search a second time
    rows = found.select("doc_id", "row_key", F.posexplode_outer(long_enough).alias("ordinal", "f")).where("ordinal is not null")
    return rows.select("doc_id", "row_key", "ordinal", "f.*")


def dictionary(docs: DataFrame, share: float = 1e-4, text_col: str = "text") -> DataFrame:
    """The words of three or more letters a-z that at least ``share`` of the
    rows have, and two of them at least: a secret of letters must not make
    itself a word.  Letters beside digits are parts of codes, not words."""
    words = F.array_distinct(F.split(F.lower(F.col(text_col).cast("string")), "[^a-z0-9]+"))
    least = max(2, math.ceil(share * docs.count()))
    counted = docs.select(F.explode(words).alias("word")).where(F.col("word").rlike("^[a-z]{3,}$")).groupBy("word").count()
    return counted.where(F.col("count") >= least).select("word")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("candidate", pattern, "")) / F.length("candidate")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """Adds the numbers of FEATURES to candidates."""
    runs = found.select("candidate").distinct().select(
        "candidate", F.explode(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word")
    )
    # written, so that the join below has a shuffle on both sides and a
    # candidate of very many rows can be split
    covered = cut(runs.join(words, "word").groupBy("candidate").agg(F.sum(F.length("word")).alias("letters")), "covered")
    size = F.length("candidate")
    name = F.regexp_extract("before", r"([A-Za-z0-9_.\-]*)[\"']?\s*[=:]?\s*[\"']?$", 1)
    last_words = F.lower(F.regexp_extract("before", r"((?:\S+\s+){0,2}\S*\s*)$", 1))
    word = F.regexp_extract("before", r"(\S*)$", 1)
    flag = lambda c: c.cast("double")
    login = F.col("before").rlike(LOGIN + "$") & F.col("after").startswith("@")
    quoted = F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")
    assigned = F.col("before").rlike(r"[=:]\s*[\"']?$")
    named = name.rlike(f"(?i:{SECRET_NAMES}){NAME_END}$")
    return (
        found.join(covered, "candidate", "left")
        .withColumn("length", size.cast("double"))
        .withColumn("digits", _share("[^0-9]"))
        .withColumn("uppers", _share("[^A-Z]"))
        .withColumn("lowers", _share("[^a-z]"))
        .withColumn("others", _share("[A-Za-z0-9]"))
        .withColumn("hex", _share("[^0-9a-f]"))
        .withColumn("changes", F.regexp_count("candidate", F.lit("(?=[a-z][^a-z]|[A-Z][^A-Z]|[0-9][^0-9])")) / size)
        .withColumn("distinct", F.size(F.array_distinct(F.split("candidate", ""))) / size)
        .withColumn(
            "longest_digits",
            F.coalesce(F.array_max(F.transform(F.regexp_extract_all("candidate", F.lit("[0-9]+"), F.lit(0)), F.length)), F.lit(0)) / size,
        )
        .withColumn("covered", F.coalesce("letters", F.lit(0)) / size)
        .withColumn("known_prefix", flag(F.col("candidate").rlike(KNOWN_PREFIX)))
        .withColumn("in_path", flag(~login & (word.contains("://") & ~(assigned & named) | word.endswith("/") | F.col("candidate").rlike(r"\.[a-z]{2,4}$"))))
        .withColumn("slashes", F.regexp_count("candidate", F.lit("/")).cast("double"))
        .withColumn("assigned", flag(assigned))
        .withColumn("quoted", flag(quoted))
        .withColumn("named_secret", flag(login | named | last_words.rlike(f"\\b({SECRET_NAMES})\\b")))
        .withColumn("named_plain", flag(last_words.rlike(f"\\b({PLAIN_NAMES})\\b")))
        .withColumn("given", flag(login | (assigned & named)))
        .withColumn("one_word", flag(~login & ~quoted & F.col("candidate").rlike("^([A-Z]?[a-z]+|[A-Z]+)[!?:]*$") & (F.col("covered") >= 0.5)))
        .drop("letters")
    )


def seed_label() -> Column:
    """The label of a finding where form and neighbours agree: 1 for a
    published prefix in full form or a value given to a secret name or login,
    0 for a single dictionary word beside such a name, and for plain numbers,
    path parts, tokens made of dictionary words, and tokens without a digit
    that nothing names and that have few changes of case or name a value."""
    varied = F.col("distinct") > 0.15
    secret = ((F.col("known_prefix") == 1) & (F.col("length") >= 20) & varied & (F.col("digits") < 0.95)) | (
        (F.col("given") == 1) & varied & (F.col("one_word") == 0) & (F.col("digits") < 0.95)
    )
    names_value = F.col("after").rlike(r"^[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?[^\s=]")
    wordlike = (F.col("digits") == 0) & ((F.col("changes") < 0.2) | names_value) & (F.col("known_prefix") == 0) & (F.col("named_secret") == 0)
    other = (F.col("given") == 0) & ((F.col("digits") >= 0.95) | (F.col("covered") >= 0.5) | wordlike | ((F.col("in_path") == 1) & (F.col("named_secret") == 0)))
    plain = other | ((F.col("given") == 1) & (F.col("one_word") == 1))
    return F.when(secret, 1.0).when(plain, 0.0)


def seed_labels(rows: DataFrame) -> DataFrame:
    """Findings that have a ``seed_label``."""
    return rows.withColumn("label", seed_label()).where("label is not null")


def train(
    labelled: DataFrame, max_labelled: int = 20_000, trees: int = 40, depth: int = 6, seed: int = 4
) -> RandomForestClassificationModel | None:
    """Forest on at most ``max_labelled`` findings: distinct feature rows of
    the label, the first in a hash order, half the places for each label.
    Every kind of finding weighs alike in its label, so that a frequent form
    of secret does not outvote a rare one.  None without findings of both
    labels."""
    rows = labelled.select(*FEATURES, "label", F.xxhash64("candidate", "before").alias("h")).distinct()
    parts = [rows.where(F.col("label") == v).orderBy("h", *FEATURES).limit(max_labelled // 2) for v in (0.0, 1.0)]
    sample = cut(parts[0].unionAll(parts[1]), "labelled")
    if sample.select("label").distinct().count() < 2:
        return None
    kind = F.concat_ws(" ", "label", "given", "known_prefix", "one_word", F.col("digits") == 0)
    weights = sample.groupBy(kind.alias("kind")).agg((F.lit(1000.0) / F.count("*")).alias("weight"))
    weighed = sample.withColumn("kind", kind).join(F.broadcast(weights), "kind").orderBy("label", "h", *FEATURES).coalesce(1)
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(weighed)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label", weightCol="weight")
    return forest.fit(ready)


def held_out_part(fifths: int = 1) -> Column:
    """Whether a labelled finding is held out: ``fifths`` of five, by hash of
    the candidate, so that a finding and its repetitions are on one side."""
    return F.pmod(F.xxhash64("candidate", F.lit("held out")), F.lit(5)) < fifths


def held_out(model: RandomForestClassificationModel, labelled: DataFrame, steps: int = 19) -> list[tuple[float, float, float]]:
    """(threshold, precision, recall) on the held-out part of ``labelled`` at
    evenly spaced thresholds."""
    judged = judge(labelled.where(held_out_part()), model)
    hits = [F.count(F.when(F.col("probability") >= k / (steps + 1), 1)).alias(f"t{k}") for k in range(1, steps + 1)]
    by = {r["label"]: r for r in judged.groupBy("label").agg(F.count("*").alias("n"), *hits).collect()}
    if not {0.0, 1.0} <= by.keys():
        return []
    out = []
    for k in range(1, steps + 1):
        right, wrong = by[1.0][f"t{k}"], by[0.0][f"t{k}"]
        out.append((k / (steps + 1), right / max(1, right + wrong), right / by[1.0]["n"]))
    return out


def calibrated(points: list[tuple[float, float, float]], default: float = 0.5) -> float:
    """The middle of the thresholds with the best F1 on the held-out part;
    ``default`` if that has not both labels."""
    if not points:
        return default
    f1 = [2 * p * r / max(1e-9, p + r) for _, p, r in points]
    best = [t for (t, _, _), v in zip(points, f1, strict=True) if v >= max(f1) - 1e-9]
    return best[len(best) // 2] if default not in best else default


def judge(rows: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5) -> DataFrame:
    """Adds probability and is_secret.  Without a model only the published
    prefixes and assigned secret names count."""
    if model is None:
        sure = (F.col("known_prefix") == 1) | (F.col("given") == 1)
        return rows.withColumn("probability", F.when(sure, 1.0).otherwise(0.0)).withColumn("is_secret", sure)
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))
    return scored.withColumn("probability", vector_to_array("probability")[1]).withColumn("is_secret", F.col("probability") >= threshold)


def scan_secrets(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    dictionary_share: float = 1e-4,
    max_labelled: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every candidate of ``docs`` with its verdict: doc_id, ordinal (place
    among the candidates of the row), candidate, before, after, probability,
    is_secret, and row_key (the md5 of the text, for rows without an id).
    ``labelled`` has candidate, before, after and label.

    Defined cases: a null or empty text has no candidate; null ids stay null;
    repeated rows report their candidates once each; an empty table gives no
    rows; without labels of both kinds the published prefixes and assigned
    secret names decide; other columns are ignored."""
    words = cut(dictionary(docs, dictionary_share, text_col), "dictionary")
    found = cut(find_candidates(docs, id_col, text_col), "found")  # read twice below
    rows = cut(with_features(found, words), "candidates")
    known = seed_labels(rows) if labelled is None else with_features(labelled, words)
    known = cut(known.select("candidate", "before", *FEATURES, "label"), "labelled")
    model = train(known.where(~held_out_part()), max_labelled)
    threshold = calibrated(held_out(model, known)) if model is not None else 0.5
    judged = judge(rows, model, threshold)
    drop(words, found, known)
    return judged.select("doc_id", "ordinal", "candidate", "before", "after", "probability", "is_secret", "row_key")


def redact_secrets(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every reported secret replaced by ``REDACTED`` in the
    rows that have its id, or without an id its text; other columns and rows
    stay as they are, whatever the names of the columns."""
    row, key, secrets = F.col("doc_id").cast("string"), free_name("found_in", docs.columns), free_name("secrets", docs.columns)
    per_doc = found.where("is_secret").groupBy(F.coalesce(row, "row_key").alias(key)).agg(F.collect_set("candidate").alias(secrets))
    longest_first = F.reverse(F.array_sort(F.transform(secrets, lambda s: F.struct(F.length(s).alias("n"), s.alias("s")))))
    hidden = F.aggregate(longest_first, F.col(text_col).cast("string"), lambda t, s: F.replace(t, s["s"], F.lit(REDACTED)))
    own = F.coalesce(F.col(id_col).cast("long").cast("string"), F.md5(F.col(text_col).cast("string")))
    joined = docs.join(per_doc, own == F.col(key), "left")
    text = F.when(F.col(secrets).isNull(), F.col(text_col)).otherwise(hidden)
    return joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns))
