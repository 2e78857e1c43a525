"""DuckDB SQL of operators 11 to 13, built from the contracts alone: a
level-by-level tree, a forward search that carries whole audits, and a
comparison of all pairs."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII string, one bit at a time."""
    digits = f"flatten(list_transform(string_split({text}, ''), lambda d: [ascii(d), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295, {digits})::BIGINT[], lambda c, x: {step}), 4294967295)"


def _tree(rows: str, levels: int, name: str) -> tuple[str, str, str]:
    """CTEs over ``rows`` (tree, idx, h and carried: row, cur, proof) and the
    names of the last node table and of the last carried table."""
    out = [
        f"{name}_lvl0 AS MATERIALIZED (SELECT tree, idx, h, count(*) OVER (PARTITION BY tree) AS c FROM {rows})",
        f"{name}_p0 AS MATERIALIZED (SELECT row, tree, idx, cur, proof FROM {rows})",
    ]
    for i in range(levels):
        a, b, p, q = f"{name}_lvl{i}", f"{name}_lvl{i + 1}", f"{name}_p{i}", f"{name}_p{i + 1}"
        left, right = "substr(s, 1, (idx % 16) * 64)", "substr(s, (idx % 16 + 1) * 64 + 1)"
        out += [
            f"{name}_run{i} AS MATERIALIZED (SELECT tree, idx // 16 AS r, string_agg(h, '' ORDER BY idx) AS s FROM {a} WHERE c > 1 GROUP BY 1, 2)",
            f"{b} AS MATERIALIZED (SELECT tree, idx, h, count(*) OVER (PARTITION BY tree) AS c FROM ("
            f"SELECT tree, r AS idx, sha256(s) AS h FROM {name}_run{i} UNION ALL SELECT tree, idx, h FROM {a} WHERE c = 1))",
            f"{q} AS MATERIALIZED (SELECT row, p.tree, CASE WHEN s IS NULL THEN idx ELSE idx // 16 END AS idx, "
            f"CASE WHEN s IS NULL THEN cur ELSE sha256({left} || cur || {right}) END AS cur, "
            f"CASE WHEN s IS NULL THEN proof ELSE proof || {left} || {right} END AS proof "
            f"FROM {p} p LEFT JOIN {name}_run{i} r ON p.tree IS NOT DISTINCT FROM r.tree AND r.r = p.idx // 16)",
        ]
    return ",\n".join(out), f"{name}_lvl{levels}", f"{name}_p{levels}"


def merkle_sql(levels: int = 6) -> str:
    """Trees of up to 16 ** levels leaves."""

    def leaf(text: str) -> str:
        value = lambda v: f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')"
        return "sha256(" + " || ".join(value(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lowered = (
        f"CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0 "
        "THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
    )
    own, own_nodes, own_paths = _tree("leaves", levels, "s")
    top, top_nodes, top_paths = _tree("subroots", levels, "t")
    return f"""
WITH marked AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, source AS tree, {leaf("text")} AS h, {leaf(lowered)} AS cur FROM documents),
leaves AS MATERIALIZED (
    SELECT row, tree, h, cur, '' AS proof, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM marked),
{own},
subroots AS MATERIALIZED (
    SELECT n.tree AS row, '' AS tree, n.h, n.h AS cur, '' AS proof,
           row_number() OVER (ORDER BY n.tree NULLS FIRST) - 1 AS idx
    FROM {own_nodes} n),
{top},
paths AS (
    SELECT m.doc_id, m.h AS leaf, n.h AS subroot, p.tree, p.cur, p.proof
    FROM marked m JOIN {own_paths} p ON p.row = m.row JOIN {own_nodes} n ON n.tree IS NOT DISTINCT FROM p.tree),
-- the siblings above a subroot are folded level by level in the same way
over AS ({_over("t", levels)})
SELECT doc_id, leaf, subroot, (SELECT h FROM {top_nodes}) AS root, sha256(proof || over_proof) AS proof_sha256,
       {_fold_sql("cur", levels)} AS folded_root, folded_root = (SELECT h FROM {top_nodes}) AS verified
FROM paths JOIN over ON over.tree IS NOT DISTINCT FROM paths.tree"""


def _over(name: str, levels: int) -> str:
    """Per source: the text of all siblings above its subroot, and the left
    and right ones of every level (null where there is none)."""
    joins, cols = [], []
    for i in range(levels):
        joins.append(f"LEFT JOIN {name}_run{i} r{i} ON r{i}.r = p{i}.idx // 16 JOIN {name}_p{i + 1} p{i + 1} ON p{i + 1}.row IS NOT DISTINCT FROM p0.row")
        cols.append(f"substr(r{i}.s, 1, (p{i}.idx % 16) * 64) AS l{i}, substr(r{i}.s, (p{i}.idx % 16 + 1) * 64 + 1) AS r{i}")
    return f"SELECT p0.row AS tree, p{levels}.proof AS over_proof, {', '.join(cols)} FROM {name}_p0 p0 {' '.join(joins)}"


def _fold_sql(start: str, levels: int) -> str:
    pairs = ", ".join(f"{{'l': l{i}, 'r': r{i}}}" for i in range(levels))
    steps = f"list_transform(list_filter([{pairs}], lambda q: q.l IS NOT NULL), lambda q: [q.l, q.r])"
    return f"list_reduce(list_prepend([{start}, ''], {steps}), lambda a, q: [sha256(q[1] || a[1] || q[2]), ''])[1]"


SPACES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def conversations_sql() -> str:
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

    def move(cost: str, letter: str, line: str | None, state: str) -> str:
        text = "{0}.t".format(state) if line is None else f"{state}.t || chr(10) || {line}"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END"

    def best(*options: str) -> str:
        return f"list_sort(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))[1]"

    user, assistant = "'user:'", "'assistant:'"

    def kept(initial: str, *states: str) -> list[str]:
        own, line = "tr", "role || ':' || text"
        keep = [f"CASE WHEN NOT del AND role[1] = '{initial}' THEN {move(own, 'K', line, s)} END" for s in states]
        if initial == "s":
            return keep
        line = ("'user'" if initial == "u" else "'assistant'") + " || ':' || text"
        return keep + [f"CASE WHEN NOT del THEN {move(own + ' + 2', 'R', line, s)} END" for s in states]

    deleted = lambda s: move("3", "D", None, s)
    none = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR))"
    return f"""
WITH RECURSIVE
base AS MATERIALIZED (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(key)} % 20 AS k FROM conversations),
damaged AS MATERIALIZED (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           md5(role || ':' || text) AS tie, unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM base WHERE k != 0),
placed AS MATERIALIZED (
    SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie, copy) AS i FROM damaged),
marked AS MATERIALIZED (
    SELECT *, rtrim(text, {SPACES_SQL}) = '' AS blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AND NOT blank AS dup,
           NOT blank AND NOT dup AND right(rtrim(text, {SPACES_SQL}), 1) NOT IN ('.', '!', '?') AS cut,
           blank OR dup AS del, cut::BIGINT AS tr,
           lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS two
    FROM placed),
counts AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
           count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
           count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id),
raw(conv_id, i, x0, xs, xu, xa) AS (
    SELECT conv_id, CAST(0 AS BIGINT), {{'c': 0::BIGINT, 'a': '', 't': ''}}, {none}, {none}, {none} FROM counts
    UNION ALL
    SELECT o.conv_id, m.i, {deleted("o.x0")}, {best(deleted("o.xs"), *kept("s", "o.x0"))},
           {best(deleted("o.u"), *kept("u", "o.x0", "o.xs", "o.a"))}, {best(deleted("o.a"), *kept("a", "o.u"))}
    FROM (SELECT *, {best("v", *(move("2", "I", user, s) for s in ("x0", "xs", "w")))} AS u,
                 {best("w", move("2", "I", assistant, best("v", *(move("2", "I", user, s) for s in ("x0", "xs", "w")))))} AS a
          FROM (SELECT *, xu AS v, xa AS w FROM raw)) o
    JOIN marked m ON m.conv_id IS NOT DISTINCT FROM o.conv_id AND m.i = o.i + 1),
ends AS (
    SELECT r.conv_id, {best("x0", "xa", move("2", "I", assistant, best("xu", move("2", "I", user, "xs"))))} AS e
    FROM raw r JOIN counts c ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND c.n = r.i)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.a, '') AS audit,
       sha256(coalesce(substr(e.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM o.conv_id"""


def embeddings_sql() -> str:
    return """
WITH RECURSIVE rows AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
fit AS MATERIALIZED (
    SELECT r, v FROM rows
    WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x != 0)) > 0),
links AS MATERIALIZED (
    SELECT a.r AS u, b.r AS w FROM fit a JOIN fit b ON a.r != b.r AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
    SELECT r AS w, vec_id AS root FROM rows
    UNION SELECT l.w, reach.root FROM reach JOIN links l ON l.u = reach.w)
SELECT vec_id, coalesce(n, 0) AS n_links, c.component_id, vec_id = c.component_id AS kept
FROM rows JOIN (SELECT w, min(root) AS component_id FROM reach GROUP BY 1) c ON c.w = rows.r
LEFT JOIN (SELECT u, count(*) AS n FROM links GROUP BY 1) k ON k.u = rows.r"""
