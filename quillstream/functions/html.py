"""HTML scalars as column functions (H1-H5).

Titles, visible text, metadata and articles need the nesting of a page, so
each is one Arrow-batched pass over the element tree of ``functions.markup``
(a scan with a tag stack).  Pages are independent rows: a page table of any
size is processed map-side, without a shuffle.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstream.functions import columns, markup
from quillstream.functions.links import url_host
from quillstream.functions.text import clean_words

# Fixed values (must match the source system's behaviour):
#   subtrees dropped from main content: script, style, nav, header, footer
SKIPPED_ELEMENTS = ("script", "style", "nav", "header", "footer")


def _per_page(function, kind: str = "string"):
    """Arrow-batched column function of one page text; null stays null."""

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda page: None if page is None else function(page), na_action="ignore")

    return F.pandas_udf(run, kind)


@columns(1)
def page_title(html: Column) -> Column:
    """H1: text of the first <title> element, references decoded; '' if none."""
    return _per_page(markup.title)(html)


@columns(1)
def visible_text(html: Column) -> Column:
    """Text nodes outside the skipped subtrees, trimmed, one space between
    them, references decoded."""
    skipped = frozenset(SKIPPED_ELEMENTS)
    return _per_page(lambda page: markup.visible_text(page, skipped))(html)


@columns(1)
def main_content(html: Column) -> Column:
    """H2: visible text of the page with X1 applied."""
    return clean_words(visible_text(html))


@columns(1)
def page_body(html: Column) -> Column:
    """H3: outer HTML of <body> (to the end of input when unclosed)."""
    return _per_page(markup.body)(html)


META_FIELDS = {
    "site_name": ("og:site_name",),
    "title": ("og:title", "<title>"),
    "description": ("og:description", "description"),
    "keywords": ("keywords",),
    "image_url": ("og:image",),
    "image_width": ("og:image:width",),
    "image_height": ("og:image:height",),
}


def _field(found: dict[str, str], field: str) -> str | None:
    return next((found[k] for k in META_FIELDS[field] if k in found), None)


def _metadata(pages: pd.Series) -> pd.DataFrame:
    found = [markup.metadata(page) if isinstance(page, str) else {} for page in pages]
    return pd.DataFrame({field: [_field(m, field) for m in found] for field in META_FIELDS}, dtype=object)


@columns(1)
def page_metadata(html: Column) -> Column:
    """Struct of the page's own metadata, null where a tag is missing; the
    title falls back to <title>, the description to the plain meta tag."""
    return F.pandas_udf(_metadata, ", ".join(f"{field} string" for field in META_FIELDS))(html)


@columns(2)
def page_metadata_cols(html: Column, url: Column) -> list[Column]:
    """H4: site name, title, description, keywords, image url/size.  The site
    name falls back to the host."""
    own = page_metadata(html)
    site = F.coalesce(own["site_name"], url_host(url)).alias("site_name")
    return [site, *(own[field].alias(field) for field in META_FIELDS if field != "site_name")]


@columns(1)
def article_text(html: Column) -> Column:
    """H5: main article text of a page (the rule is ``markup.article``), with
    X1 applied."""
    return clean_words(_per_page(markup.article)(html))


def _parts(pages: pd.Series) -> pd.DataFrame:
    found = [markup.article_and_metadata(page) if isinstance(page, str) else (None, {}) for page in pages]
    return pd.DataFrame([(text, _field(meta, "site_name")) for text, meta in found], columns=["article", "site_name"], dtype=object)


@columns(1)
def page_parts(html: Column) -> Column:
    """What a tick takes from a page, in one pass: struct(article before X1,
    site_name as the page states it)."""
    return F.pandas_udf(_parts, "article string, site_name string")(html)


@columns(1)
def has_complete_body(html: Column) -> Column:
    """A fetched page is complete when its </body> arrived."""
    return html.rlike(r"(?i)</body\s*>")
