"""Queries for link handling: URL parts, aggregator-link unwrapping, URL
cleaning, substring offsets, resolver staging/parsing and final URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstream.functions import links as L
from quillstream.plans.catalog import register
from quillstream.plans.sqlfrag import lit
from quillstream.sources import fixtures as FX
from quillstream.sources.tables import read_table

_LINKS = FX.link_cases()
_CLEAN = FX.clean_url_cases()

# --------------------------------------------------------------------- U7

_URL_HOST_SQL = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)"
_URL_PATH_SQL = r"url_decode(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1))"


@register(
    "url_parts",
    f"SELECT page_id, {_URL_HOST_SQL} AS host, {_URL_PATH_SQL} AS path, "
    f"string_split({_URL_PATH_SQL}, '/') AS segments FROM pages",
)
def url_parts(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        L.url_host(F.col("url")).alias("host"),
        L.url_path(F.col("url")).alias("path"),
        L.path_segments(F.col("url")).alias("segments"),
    )


# --------------------------------------------------------------------- U1 / P8


def _wrapped_pages(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    derived = pages.select("page_id", L.wrap_link(F.col("url")).alias("link"))
    inline = spark.createDataFrame([(c[0], c[1]) for c in _LINKS], "page_id long, link string")
    return derived.unionByName(inline)


def _inline_sql(idx: int) -> str:
    rows = [(c[0], c[idx]) for c in _LINKS]
    return f"SELECT page_id, link FROM {FX.sql_values(rows, ['page_id', 'link'])}"


@register("unwrap_links", f"SELECT page_id, url AS link FROM pages UNION ALL {_inline_sql(2)}")
def unwrap_links(spark, sf_dir):
    u = L.unwrap_links_df(_wrapped_pages(spark, sf_dir), "link", "u")
    return u.select("page_id", F.col("u.link").alias("link"))


_MIXED_ROWS = [(c[0], c[2] if c[2] is not None else c[1]) for c in _LINKS]


@register(
    "unwrap_links_mixed",
    f"SELECT page_id, url AS link FROM pages UNION ALL "
    f"SELECT page_id, link FROM {FX.sql_values(_MIXED_ROWS, ['page_id', 'link'])}",
)
def unwrap_links_mixed(spark, sf_dir):
    return L.source_links_df(_wrapped_pages(spark, sf_dir), "link").select("page_id", "link")


@register("unwrap_links_legacy", f"SELECT page_id, url AS link FROM pages UNION ALL {_inline_sql(4)}")
def unwrap_links_legacy(spark, sf_dir):
    return _wrapped_pages(spark, sf_dir).select("page_id", L.unwrap_link_legacy(F.col("link")).alias("link"))


# --------------------------------------------------------------------- U3


def _dirty(url):
    # a pasted link: label, control char, the URL, tab, zero-width space, two U+FFFD
    return F.concat(F.lit("amp "), F.lit("\x07"), url, F.lit("\t\u200b\ufffd\ufffd"))


_DIRTY_SQL = "('amp ' || chr(7) || url || chr(9) || chr(8203) || chr(65533) || chr(65533))"


def _clean_url_sql(s: str) -> str:
    return (
        f"CASE WHEN strpos({s}, 'http') = 0 THEN '' ELSE regexp_replace(regexp_replace("
        f"substring({s}, strpos({s}, 'http')), '[^\\pL\\pM\\pN\\pP\\pS]', '', 'g'), chr(65533) || '$', '') END"
    )


@register(
    "clean_urls",
    f"SELECT page_id, {_clean_url_sql(_DIRTY_SQL)} AS link FROM pages UNION ALL "
    f"SELECT page_id, link FROM {FX.sql_values([(c[0], c[2]) for c in _CLEAN], ['page_id', 'link'])}",
)
def clean_urls(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    derived = pages.select("page_id", _dirty(F.col("url")).alias("raw"))
    inline = spark.createDataFrame([(c[0], c[1]) for c in _CLEAN], "page_id long, raw string")
    return derived.unionByName(inline).select("page_id", L.clean_url(F.col("raw")).alias("link"))


# --------------------------------------------------------------------- U6

NEEDLE = "<li"


@register(
    "substring_offsets",
    f"SELECT page_id, strlen(substring(html, 1, i - 1))::BIGINT AS \"offset\" FROM "
    f"(SELECT page_id, html, unnest(range(1, length(html) + 1)) AS i FROM pages) "
    f"WHERE substring(html, i, {len(NEEDLE)}) = {lit(NEEDLE)}",
)
def substring_offsets(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return L.substring_offset_rows(pages, "page_id", "html", NEEDLE)


# --------------------------------------------------------------------- U4 / P11


def unresolved_link(url):
    # an aggregator link whose id whose payload is an unresolved marker + digest of the page URL
    inner = F.concat(F.lit(L.UNRESOLVED_MARKER), F.md5(url))
    framed = F.concat(
        F.unhex(F.lit(L.PAYLOAD_PREFIX_HEX)),
        F.unhex(F.lpad(F.hex(F.octet_length(inner)), 2, "0")),
        F.encode(inner, "UTF-8"),
        F.unhex(F.lit(L.PAYLOAD_SUFFIX_HEX)),
    )
    return L.wrap_bytes_link(framed)


_FRAMED_SQL = (
    "('\\x08\\x13\\x22'::BLOB || unhex(printf('%02x', strlen('AU_yqL' || md5(url)))) || "
    "encode('AU_yqL' || md5(url)) || '\\xD2\\x01\\x00'::BLOB)"
)
_ID_SQL = f"translate(to_base64({_FRAMED_SQL}), '+/', '-_')"


@register(
    "stage_unresolved_links",
    f"SELECT page_id, 'f.req=' || url_encode({lit(L.RESOLVER_REQ_HEAD)} || {_ID_SQL} || "
    f"{lit(L.RESOLVER_REQ_TAIL)}) AS payload FROM pages",
)
def stage_unresolved_links(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    u = pages.select("page_id", L.unwrap_link(unresolved_link(F.col("url"))).alias("u"))
    return u.filter(F.col("u.reason") == "unresolved").select(
        "page_id", L.resolver_request(F.col("u.resolver_id")).alias("payload")
    )


# --------------------------------------------------------------------- U5 / P10

_RESP_HEAD = ")]}'\n\n[[\"wrb.fr\",\"Fbv4je\",\"" + L.RESOLVER_HEADER
_RESP_TAIL = L.RESOLVER_FOOTER + '1]",null,null,null,"generic"]]'


def resolver_body(url):
    return F.concat(F.lit(_RESP_HEAD), url, F.lit(_RESP_TAIL))


_RESOLVER_INLINE = [
    (-1, 500, _RESP_HEAD + "https://x.example/a" + _RESP_TAIL, None, "status"),
    (-2, 200, "[[\"wrb.fr\",\"Fbv4je\",null]]", None, "no_header"),
    (-3, 200, _RESP_HEAD + "https://x.example/unterminated", None, "no_footer"),
    (-4, 200, _RESP_HEAD + "https://x.example/twice" + _RESP_TAIL + _RESP_HEAD + "https://y/" + _RESP_TAIL,
     "https://x.example/twice", None),
]


@register(
    "resolver_parse",
    f"SELECT page_id, url AS link, NULL::VARCHAR AS reason FROM pages UNION ALL "
    f"SELECT page_id, link, reason FROM "
    f"{FX.sql_values([(c[0], c[3], c[4]) for c in _RESOLVER_INLINE], ['page_id', 'link', 'reason'])}",
)
def resolver_parse(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    derived = pages.select("page_id", F.lit(200).alias("status"), resolver_body(F.col("url")).alias("body"))
    inline = spark.createDataFrame([c[:3] for c in _RESOLVER_INLINE], "page_id long, status int, body string")
    r = derived.unionByName(inline).select("page_id", L.resolver_parse(F.col("status"), F.col("body")).alias("r"))
    return r.select("page_id", F.col("r.link").alias("link"), F.col("r.reason").alias("reason"))


# --------------------------------------------------------------------- J3


@register(
    "final_url",
    "SELECT p.page_id, f.final_url FROM pages p LEFT JOIN ("
    "SELECT url, 'https://' || substring(url, 8) AS final_url FROM pages WHERE starts_with(url, 'http://')"
    ") f ON p.url = f.url",
)
def final_url(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    # fetch log: plain-http pages were redirected to https
    fetch_log = pages.filter(F.col("url").startswith("http://")).select(
        "url", F.concat(F.lit("https://"), F.substring("url", 8, 1 << 30)).alias("final_url")
    )
    return pages.join(fetch_log, "url", "left").select("page_id", "final_url")
