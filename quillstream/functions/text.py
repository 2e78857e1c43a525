"""Text scalars as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstream.functions import columns

# Fixed values (must match the source system's behaviour):
#   word separators = Unicode white space: TAB, LF, VT, FF, CR, SPACE, U+0085
#                     and every character of category Z (Zs, Zl, Zp)
#   dropped words   = byte length <= 1, or starting with "function" or "var"
#   scoring text    = "Title:" + title + "\n" + "Content:" + content
WHITESPACE_RUN = r"[\t-\r \x{85}\p{Z}]+"
DROPPED_PREFIXES = ("function", "var")
TITLE_LABEL = "Title:"
CONTENT_LABEL = "\nContent:"


# A dropped word after white space was normalised to single spaces: one
# byte (an ASCII character other than space) or a dropped prefix, followed
# by the next separator (look-ahead, so consecutive dropped words all match).
DROPPED_WORD_RE = (
    r" (?:[\x00-\x1F\x21-\x7F]|" + "|".join(rf"{p}[^ ]*" for p in DROPPED_PREFIXES) + r")(?= )"
)


@columns(1)
def clean_words(text: Column) -> Column:
    """Split on white space, keep words longer than one byte that do
    not start with a dropped prefix, join with single spaces.

    Three string passes instead of split/filter/join: white-space runs
    become one space (padded at both ends), dropped words are deleted with
    one regex, the padding is trimmed.  Equal to the split/filter/join
    formulation (the DuckDB oracle uses that one; property-tested)."""
    spaced = F.concat(F.lit(" "), F.regexp_replace(text, WHITESPACE_RUN, " "), F.lit(" "))
    kept = F.regexp_replace(spaced, DROPPED_WORD_RE, "")
    return F.btrim(kept, F.lit(" "))


@columns(1)
def clean_words_listwise(text: Column) -> Column:
    """X1 as split / filter / join (reference formulation, used in tests)."""
    words = F.split(text, WHITESPACE_RUN)

    def keep(w: Column) -> Column:
        cond = F.octet_length(w) > 1
        for p in DROPPED_PREFIXES:
            cond = cond & ~w.startswith(p)
        return cond

    return F.array_join(F.filter(words, keep), " ")


@columns(2)
def compose_scoring_text(title: Column, content: Column) -> Column:
    """X2 + P9: labelled title and content; the title alone when the page
    could not be obtained (``content`` is NULL)."""
    composed = F.concat(F.lit(TITLE_LABEL), F.coalesce(title, F.lit("")), F.lit(CONTENT_LABEL), content)
    return F.when(content.isNull(), title).otherwise(composed)


# Fixed value: report block layout (80 '=' then labelled fields).
REPORT_RULE = "=" * 80
REPORT_FORMAT = "ID: %s\nTitle: %s\nDate: %s\nLink: %s\nSource: %s\nScore: %s\nContent: %s\n\n"


@columns(7)
def report_line(ident: Column, title: Column, date: Column, link: Column, source: Column, score: Column,
                content: Column) -> Column:
    """One report block per item; missing fields print empty."""
    def s(c: Column) -> Column:
        return F.coalesce(c, F.lit(""))

    return F.concat(
        F.lit(REPORT_RULE + "\n"),
        F.format_string(
            REPORT_FORMAT, s(ident), s(title), s(F.date_format(date, "yyyy-MM-dd HH:mm:ss")), s(link), s(source),
            s(score), s(content),
        ),
    )
