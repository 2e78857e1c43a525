import base64

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillstream.functions import links as L
from quillstream.sources import fixtures as FX


def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("r")).first()["r"]


urls = st.text(alphabet=st.characters(min_codepoint=33, max_codepoint=126, exclude_characters="?#"),
               min_size=1, max_size=300).map(lambda s: "https://example.org/" + s)


@settings(max_examples=25, deadline=None)
@given(st.lists(urls, min_size=1, max_size=8))
def test_wrap_unwrap_round_trip(spark, us):
    df = spark.createDataFrame([(u,) for u in us], "url string")
    out = df.select("url", L.unwrap_link(L.wrap_link(F.col("url")))["link"].alias("back")).collect()
    for r in out:
        assert r["back"] == r["url"]


def test_compat_mode_drops_last_byte_of_long_urls(spark):
    u = FX.url_of_len(160)
    link = FX.wrapped(FX.framed(u))
    got = _one(spark, lambda c: L.unwrap_link(c, compat=True)["link"], link)
    assert got == u[:159]
    assert _one(spark, lambda c: L.unwrap_link(c)["link"], link) == u


def test_unwrap_reasons(spark):
    rows = FX.link_cases()
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "id long, link string")
    got = {r["id"]: (r["l"], r["why"]) for r in df.select(
        "id", L.unwrap_link(F.col("link"))["link"].alias("l"), L.unwrap_link(F.col("link"))["reason"].alias("why")
    ).collect()}
    for r in rows:
        assert got[r[0]] == (r[2], r[3]), r


def test_unresolved_id_is_padded(spark):
    link = FX.wrapped(FX.framed("AU_yqLabc"))
    rid = _one(spark, lambda c: L.unwrap_link(c)["resolver_id"], link)
    assert len(rid) % 4 == 0 and rid.rstrip("=") == link.split("/")[-1].split("?")[0]
    assert base64.urlsafe_b64decode(rid).endswith(b"AU_yqLabc\xd2\x01\x00")


def test_substring_offsets_overlapping(spark):
    df = spark.createDataFrame([("aaaa",), ("baab",), ("",), (None,)], "s string")
    got = [r["o"] for r in df.select(L.substring_offsets(F.col("s"), "aa").alias("o")).collect()]
    assert got == [[0, 1, 2], [1], [], None]


def test_substring_offsets_are_byte_offsets(spark):
    got = _one(spark, lambda c: L.substring_offsets(c, "x"), "éxéx")
    assert got == [2, 5]


def test_clean_url_cases(spark):
    rows = FX.clean_url_cases()
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "id long, s string")
    got = {r["id"]: r["c"] for r in df.select("id", L.clean_url(F.col("s")).alias("c")).collect()}
    for r in rows:
        assert got[r[0]] == r[2], r


def test_resolver_parse(spark):
    body = 'x[\\"garturlres\\",\\"https://a.example/p\\",1]'
    df = spark.createDataFrame([(200, body), (500, body), (200, "nothing")], "status int, body string")
    got = [tuple(r["r"]) for r in df.select(L.resolver_parse(F.col("status"), F.col("body")).alias("r")).collect()]
    assert got == [("https://a.example/p", None), (None, "status"), (None, "no_header")]


def test_staged_unwrap_equals_column_form(spark):
    rows = FX.link_cases() + [(1, FX.wrapped(FX.framed("https://example.org/ok")), None, None, None)]
    df = spark.createDataFrame([(r[0], r[1]) for r in rows], "id long, link string")
    a = {r["id"]: tuple(r["u"]) if r["u"] else None for r in df.select("id", L.unwrap_link(F.col("link")).alias("u")).collect()}
    b = {r["id"]: tuple(r["u"]) if r["u"] else None for r in L.unwrap_links_df(df, "link", "u").collect()}
    assert a == b


def _go_decode(b: bytes) -> str:
    """Per-byte replacement model: a well-formed sequence decodes, any
    other byte becomes one U+FFFD."""
    out, i = [], 0
    while i < len(b):
        for n in (1, 2, 3, 4):
            chunk = b[i:i + n]
            try:
                ch = chunk.decode("utf-8", errors="strict")
            except UnicodeDecodeError:
                continue
            if len(ch) == 1:
                out.append(ch)
                i += n
                break
        else:
            out.append("�")
            i += 1
    return "".join(out)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.binary(max_size=24) | st.text(max_size=8).map(lambda t: t.encode()), min_size=1, max_size=10))
def test_utf8_per_byte_matches_model(spark, blobs):
    df = spark.createDataFrame([(bytearray(b),) for b in blobs], "b binary")
    got = [r["s"] for r in df.select(L.utf8_per_byte(F.col("b")).alias("s")).collect()]
    assert got == [_go_decode(b) for b in blobs]


def test_hosts_of_urls_that_a_strict_parser_refuses(spark):
    cases = {
        "https://example.com/a|b": "example.com",
        "https://my_site.example.com/x": "my_site.example.com",
        "https://example.com/a b": "example.com",
        "https://example.com/?q={x}": "example.com",
        "https://user:pw@host.example:8080/a|b": "host.example",
        "http://bad host/x": None,
        "no url": None,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r["u"]: r["h"] for r in df.select("u", L.url_host(F.col("u")).alias("h")).collect()} == cases


def test_offset_rows_equal_the_column_function_and_scale_linearly(spark):
    rows = [(1, "aaa"), (2, "éxéx"), (3, None), (4, ""), (5, "ab" * 40_000)]
    df = spark.createDataFrame(rows, "k long, s string")
    got = {}
    for r in L.substring_offset_rows(df, "k", "s", "a").collect():
        got.setdefault(r["k"], []).append(r["offset"])
    assert got == {1: [0, 1, 2], 5: list(range(0, 80_000, 2))}
    assert [r["offset"] for r in L.substring_offset_rows(df.where("k = 2"), "k", "s", "x").collect()] == [2, 5]


def test_length_prefixes_of_any_size(spark):
    """Lengths on both sides of every further byte, up to three megabytes;
    padded, endless and missing prefixes."""
    sizes = [20, 127, 128, 16_383, 16_384, 40_000, 2_097_151, 2_097_152, 3_000_000]
    df = spark.createDataFrame([(n, FX.wrapped(FX.framed(FX.url_of_len(n)))) for n in sizes], "n long, link string")
    for form in (lambda d: d.select("n", L.unwrap_link("link").alias("u")), lambda d: L.unwrap_links_df(d, "link", "u")):
        got = {r["n"]: (len(r["u"]["link"]), r["u"]["reason"]) for r in form(df).select("n", "u").collect()}
        assert got == {n: (n, None) for n in sizes}
    url = "https://example.org/padded"
    raw = [
        (1, FX.PREFIX + bytes([len(url) | 128, 128, 128, 0]) + url.encode(), url, None),
        (2, FX.PREFIX + b"\xff" * 20, None, "bad_length"),
        (3, FX.PREFIX + b"\xff\xff", None, "too_short"),
        (4, FX.PREFIX + b"\xff" * 8 + b"\x7f" + b"x" * 30, None, "out_of_range"),
    ]
    df = spark.createDataFrame([(i, FX.wrapped(b)) for i, b, *_ in raw], "i long, link string")
    got = {r["i"]: (r["u"]["link"], r["u"]["reason"]) for r in df.select("i", L.unwrap_link("link").alias("u")).collect()}
    assert got == {i: (link, why) for i, _, link, why in raw}
    sizes = spark.createDataFrame([(FX.url_of_len(n),) for n in sizes], "u string")
    assert sizes.select(L.unwrap_link(L.wrap_link("u"))["link"].alias("l"), "u").filter("l = u").count() == 9
