"""DuckDB SQL fragments of the oracle side.  They read the driver's pages by
their literal markup and share no pattern with the Spark side, so a fault
there shows; odd markup is covered by literal pages with literal results
(``sources.fixtures.page_cases``)."""

from __future__ import annotations


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def clean_words(expr: str) -> str:
    spaces = lit(r"[\t-\r \x{85}\p{Z}]+")
    cond = "strlen(w) > 1 AND NOT starts_with(w, 'function') AND NOT starts_with(w, 'var')"
    return f"array_to_string(list_filter(regexp_split_to_array({expr}, {spaces}), lambda w: {cond}), ' ')"


# references in the driver pages, "&amp;" last (one pass on the Spark side)
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\u00a0"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def decode_entities(expr: str) -> str:
    for ent, ch in ENTITIES:
        expr = f"replace({expr}, {lit(ent)}, {lit(ch)})"
    return expr


def between(expr: str, start: str, end: str) -> str:
    """Text from the first ``start`` to the next ``end`` or the end."""
    return f"split_part(split_part({expr}, {lit(start)}, 2), {lit(end)}, 1)"


def untagged(expr: str) -> str:
    """Tags become spaces; the driver's tags hold no quoted ``>``."""
    return decode_entities(f"regexp_replace({expr}, '<[^>]*>', ' ', 'g')")


def page_title(expr: str) -> str:
    return decode_entities(between(expr, "<title>", "</title>"))


def main_content(expr: str) -> str:
    """Title, then what stands between the menu and the footer; the driver
    writes <!-- ad N --> there, and script and style in the head only."""
    inner = f"regexp_replace({between(expr, '</nav>', '<footer>')}, '<!-- ad [0-9]+ -->', ' ', 'g')"
    return clean_words(f"{page_title(expr)} || ' ' || {untagged(inner)}")


def page_body(expr: str) -> str:
    end = f"CASE WHEN contains({expr}, '</body>') THEN '</body>' ELSE '' END"
    return f"'<body>' || {between(expr, '<body>', '</body>')} || {end}"


def compose_scoring_text(title: str, content: str) -> str:
    return f"CASE WHEN {content} IS NULL THEN {title} ELSE 'Title:' || coalesce({title}, '') || chr(10) || 'Content:' || {content} END"


def article_text(expr: str) -> str:
    """The driver's pages have their text in one <article>."""
    return clean_words(untagged(between(expr, "<article>", "</article>")))


def has_complete_body(expr: str) -> str:
    return f"contains({expr}, '</body>')"
