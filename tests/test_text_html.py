from html.parser import HTMLParser

from pyspark.sql import functions as F

from quillstream.functions import html as H
from quillstream.functions import text as T
from tests.conftest import MEDIUM


def _py_clean(s):
    words = s.split()
    return " ".join(w for w in words if len(w.encode()) > 1 and not w.startswith(("function", "var")))


class _Text(HTMLParser):
    """Independent implementation: text nodes outside the skipped subtrees."""

    SKIP = {"script", "style", "nav", "header", "footer"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth = 0
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag in self.SKIP:
            self.depth += 1

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth and data.strip():
            self.parts.append(data.strip())


def test_clean_words_edge_cases(spark):
    cases = ["a b  cc dd\u0085ee　ff", "variable functional various fun", "é x ab", "", None]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    got = [r["c"] for r in df.select(T.clean_words(F.col("t")).alias("c")).collect()]
    assert got == ["cc dd ee ff", "fun", "é ab", "", None]


def test_main_content_matches_python_html_parser(spark):
    pages = spark.read.parquet(f"{MEDIUM}/pages.parquet")
    rows = pages.select("html", H.main_content(F.col("html")).alias("c")).collect()
    bad = 0
    for r in rows:
        p = _Text()
        p.feed(r["html"])
        p.close()
        if _py_clean(" ".join(p.parts)) != r["c"]:
            bad += 1
    assert bad == 0


def test_title_and_entities(spark):
    df = spark.createDataFrame(
        [("<html><head><TITLE>A &amp;lt; B &amp; C</TITLE></head></html>",), ("<p>no title</p>",),
         ("<!-- <title>x</title> --><title></title>",)], "h string")
    got = [r["t"] for r in df.select(H.page_title(F.col("h")).alias("t")).collect()]
    assert got == ["A &lt; B & C", "", ""]


def test_body_without_closing_tag(spark):
    df = spark.createDataFrame([("<html><body><p>x</p>",)], "h string")
    assert df.select(H.page_body(F.col("h")).alias("b")).first()["b"] == "<body><p>x</p>"


def test_compose_falls_back_to_title(spark):
    df = spark.createDataFrame([("T", "c"), ("T", None)], "t string, c string")
    got = [r["s"] for r in df.select(T.compose_scoring_text(F.col("t"), F.col("c")).alias("s")).collect()]
    assert got == ["Title:T\nContent:c", "T"]


# White space of the source system's field splitter: TAB..CR, SPACE, U+0085,
# U+00A0 and the Unicode space separators / line / paragraph separators.
_GO_SPACE = set("\t\n\v\f\r \u0085      　") | {chr(c) for c in range(0x2000, 0x200B)}


def _go_fields_clean(s):
    words, cur = [], ""
    for ch in s:
        if ch in _GO_SPACE:
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += ch
    if cur:
        words.append(cur)
    return " ".join(w for w in words if len(w.encode()) > 1 and not w.startswith(("function", "var")))


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_alphabet = st.sampled_from(list("ab é€​") + sorted(_GO_SPACE) + ["var", "function", "x", " "])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(_alphabet, max_size=40).map("".join), min_size=1, max_size=20))
def test_clean_words_matches_field_splitter(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["c"] for r in df.select(T.clean_words(F.col("t")).alias("c")).collect()]
    assert got == [_go_fields_clean(t) for t in texts]


def test_html_edge_cases(spark):
    pages = [
        "<html><head><title></title></head><body><p>alpha beta</p></body></html>",
        "<HTML><BODY><SCRIPT>var x = 1;</SCRIPT><P>Upper Case</P></BODY></HTML>",
        "<body><!-- <p>hidden words</p> --><p>shown words</p></body>",
        "<body><nav><a>menu items never closed <p>still nav",
        "<body><p>aa &amp;lt; bb &lt;cc</p></body>",
    ]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, h string")
    got = {r["i"]: (r["t"], r["c"]) for r in df.select(
        "i", H.page_title(F.col("h")).alias("t"), H.main_content(F.col("h")).alias("c")).collect()}
    assert got[0] == ("", "alpha beta")
    assert got[1] == ("", "Upper Case")
    assert got[2] == ("", "shown words")
    assert got[3] == ("", "")
    assert got[4] == ("", "aa &lt; bb <cc")


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(_alphabet, max_size=60).map("".join), min_size=1, max_size=20))
def test_regex_word_filter_equals_listwise(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(T.clean_words(F.col("t")).alias("a"), T.clean_words_listwise(F.col("t")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)


def test_functions_accept_column_names(spark):
    df = spark.createDataFrame([("<html><title>t</title><body><p>hello world</p></body></html>", "aa bb")], "html string, t string")
    a = df.select(H.page_title("html").alias("x"), H.main_content("html").alias("y"), T.clean_words("t").alias("z")).first()
    b = df.select(H.page_title(F.col("html")).alias("x"), H.main_content(F.col("html")).alias("y"),
                  T.clean_words(F.col("t")).alias("z")).first()
    assert a == b == ("t", "hello world", "aa bb")


def test_tag_names_match_whole_and_references_decode(spark):
    cases = [
        ("<nav-bar>menu</nav-bar><p>hello world</p>", "menu hello world"),
        ("<nav class=x>menu</nav><p>hello world</p>", "hello world"),
        ("<header-x>top</header-x><header>gone</header><p>it&#8217;s here &mdash; now</p>", "top it’s here now"),
        ("<p>caf&eacute; &#x27;x&#x27; &amp;lt; &unknown; a&b &#0; &#xD800;!</p>", "café 'x' &lt; &unknown; a&b �!"),
        ("<p>no references</p>", "no references"),
    ]
    df = spark.createDataFrame([(h,) for h, _ in cases], "h string")
    got = [r["t"] for r in df.select(H.visible_text(F.col("h")).alias("t")).collect()]
    # words of one byte are kept here: only the markup pass is under test
    assert [" ".join(t.split()) for t in got] == [
        "menu hello world",
        "hello world",
        "top it’s here — now",
        "café 'x' &lt; &unknown; a&b � �!",
        "no references",
    ]
    assert [r["t"] for r in df.select(H.main_content(F.col("h")).alias("t")).limit(2).collect()] == [c for _, c in cases[:2]]


def test_literal_pages_and_metadata(spark):
    from quillstream.sources import fixtures as FX

    df = spark.createDataFrame([c[:2] for c in FX.page_cases()], "id long, h string")
    got = {tuple(r) for r in df.select("id", H.page_title("h"), H.page_body("h"), H.main_content("h"), H.article_text("h")).collect()}
    assert got == {(c[0], *c[2:]) for c in FX.page_cases()}
    meta = spark.createDataFrame([c[:3] for c in FX.meta_cases()], "id long, u string, h string")
    assert {tuple(r) for r in meta.select("id", *H.page_metadata_cols("h", "u")).collect()} == {(c[0], *c[3:]) for c in FX.meta_cases()}


def test_null_and_long_pages(spark):
    long = "<div>" * 20_000 + "<p>" + "word, " * 20_000 + "<!--" * 20_000
    df = spark.createDataFrame([(1, None), (2, long)], "id long, h string")
    rows = df.select("id", H.page_title("h").alias("t"), H.page_body("h").alias("b"), H.article_text("h").alias("a"), H.page_parts("h").alias("p")).collect()
    got = {r["id"]: r for r in rows}
    assert (got[1]["t"], got[1]["b"], got[1]["a"], got[1]["p"]["article"]) == (None,) * 4
    assert got[2]["a"] == " ".join(["word,"] * 20_000)


def test_articles_score_by_their_paragraphs():
    from quillstream.functions import markup

    prose = "Some words of a story, which has commas, and goes on. "
    links = "".join(f"<li><a href=/{i}>Another headline, with a comma {i}</a></li>" for i in range(20))
    page = f"<body><div id=a><ul>{links}</ul></div><div id=b><p>{prose * 3}</p><p>Yes.</p><p>{prose * 2}</p></div></body>"
    assert markup.article(page).split() == (prose * 3 + "Yes. " + prose * 2).split()
    comments = f"<body><div class='comments'><p>{prose * 9}</p></div><div><p>{prose}</p></div></body>"
    assert markup.article(comments).split() == prose.split()
    assert markup.article(f"<article>{prose}<br>{prose}</article><div>{prose}</div>").split() == (prose * 3).split()
    table = f"<table><tr><td>{prose}<td><a href=x>link</a></table>"
    assert markup.article(table).split() == prose.split()
