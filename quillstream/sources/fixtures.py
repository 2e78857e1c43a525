"""Inline edge-case rows added to the driver tables inside queries.

The driver tables carry no aggregator links, score answers or feed items,
so queries derive those from ``pages``/``events``/``labels`` with Spark;
the rows here only add the edge cases the derived data cannot produce
(FIXTURES.md section 4).  Each case lists its input and the expected value
"""

from __future__ import annotations

import base64

PREFIX = bytes.fromhex("081322")
SUFFIX = bytes.fromhex("D20100")


def _b64url(b: bytes) -> str:
    return base64.urlsafe_b64encode(b).decode().rstrip("=")


def varint(n: int) -> bytes:
    """Seven bits a byte, the lowest first; the last byte is below 128."""
    return bytes([n]) if n < 128 else bytes([n % 128 + 128]) + varint(n // 128)


def wrapped(payload: bytes, host: str = "news.google.com") -> str:
    return f"https://{host}/rss/articles/{_b64url(payload)}?oc=5"


def framed(url: str, prefix: bool = True, suffix: bool = True, length: int | None = None) -> bytes:
    u = url.encode()
    n = len(u) if length is None else length
    return (PREFIX if prefix else b"") + varint(n) + u + (SUFFIX if suffix else b"")


def url_of_len(n: int) -> str:
    base = "https://example.org/"
    return base + "a" * (n - len(base))


# (page_id, link, expected U1 link, expected U1 reason, expected U2 legacy link)
def link_cases() -> list[tuple[int, str, str | None, str | None, str]]:
    cases = []
    pid = -1
    for n in (127, 128, 255, 256, 16_383, 16_384, 40_000):
        u = url_of_len(n)
        cases.append((pid, wrapped(framed(u)), u, None, u))
        pid -= 1
    u = "https://example.org/no-suffix"
    cases.append((pid, wrapped(framed(u, suffix=False)), u, None, u))
    pid -= 1
    cases.append((pid, "https://news.google.com/rss/articles/abc$def", None, "bad_base64", ""))
    pid -= 1
    cases.append((pid, "https://news.google.com/rss/articles/abcde", None, "bad_base64", ""))
    pid -= 1
    u = "https://example.org/short"
    cases.append((pid, wrapped(framed(u, length=len(u) + 10)), None, "out_of_range", u))
    pid -= 1
    foreign = "https://example.com/rss/articles/" + _b64url(framed("https://example.org/x"))
    cases.append((pid, foreign, foreign, None, "https://example.org/x"))
    pid -= 1
    u = "https://example.org/port"
    cases.append((pid, wrapped(framed(u), host="news.google.com:443"), u, None, u))
    pid -= 1
    au = "AU_yqLxyz-unresolved"
    cases.append((pid, wrapped(framed(au)), None, "unresolved", ""))
    pid -= 1
    cases.append((pid, "http://bad host/x", None, "invalid_url", ""))
    pid -= 1
    # truncated multi-byte sequence (E2 82) at the end of the URL bytes: each
    # invalid byte becomes its own U+FFFD (two here); on the legacy path the
    # suffix byte D2 adds a third, and one trailing U+FFFD is trimmed
    u = b"http://x.example/a\xe2\x82"
    payload = PREFIX + varint(len(u)) + u + SUFFIX
    cases.append((pid, wrapped(payload), "http://x.example/a\ufffd\ufffd", None, "http://x.example/a\ufffd\ufffd"))
    return cases


# (case_id, raw text, expected U3 clean_url)
def clean_url_cases() -> list[tuple[int, str, str]]:
    return [
        (-1, "no link here", ""),
        (-2, "amp http://a.example/x then http://b.example/y", "http://a.example/xthenhttp://b.example/y"),
        (-3, "\x07\x1bhttp://c.example/\x01z\x7f", "http://c.example/z"),
        (-4, "http://d.example/\u200bzw", "http://d.example/zw"),
        (-5, "http://e.example/\ufffd", "http://e.example/"),
        (-6, "http://f.example/\ufffd\ufffd", "http://f.example/\ufffd"),
        (-7, "http://g.example/\u00a0nb\u3000sp", "http://g.example/nbsp"),
    ]


STORY = "A long first paragraph of the story, with commas, and with enough words to count as prose."
MORE = "A second paragraph of the same story, again with commas, which goes on for quite a few words."
SIBLING = "Behind the block stands one more paragraph of the story, long enough to be read as a part of it."


def page_cases() -> list[tuple[int, str, str, str, str, str]]:
    """(page_id, html, H1 title, H3 body, H2 main content, H5 article)."""
    rows = [
        # nested elements of a skipped name
        ("<body><nav><nav>aa</nav>menu</nav><p>bb cc</p></body>", "", None, "bb cc", "bb cc"),
        # ">" in quoted values, either quote, and unquoted values with slashes
        ("<title>Tt &amp;lt; x</title><body class='a>b'><a title=\"x>y\" href=/a/b>text</a> <img alt='<p>'>here</body>tail",
         "Tt &lt; x", "<body class='a>b'><a title=\"x>y\" href=/a/b>text</a> <img alt='<p>'>here</body>", "Tt &lt; text here tail", "text here tail"),
        # references without a semicolon, unknown ones, numbers
        ("<body><p>caf&eacute done &unknown; &#8217;tis &#x27;ok&#x27 &amp;amp;</p></body>", "", None,
         "caf\u00e9 done &unknown; \u2019tis 'ok' &amp;", "caf\u00e9 done &unknown; \u2019tis 'ok' &amp;"),
        # raw text, comments in it, comments of odd form
        ("<body><script>if (a < b) { x = '<!--'; }</script>one<!--> two --><style><p></style>three<!-- four", "",
         None, "one two --> three", "one two --> three"),
        # open ends, ignored end tags, paragraphs that end each other
        ("<body>fo</b>o bar<p>one<p>two<div>three</div>four</nav> five<footer>six", "", None,
         "foo bar one two three four five", "foo bar one two three four five"),
        # short paragraphs and quotes between kept ones stay; lists of links,
        # furniture and menus go
        (f"<body><div class=top><a href=/>Home page</a> <a href=/n>News today</a></div><div id=col><h1>Head line</h1><p>{STORY}</p>"
         f"<p>Short one.</p><blockquote>\"So it is.\"</blockquote><p>{MORE}</p><ul><li><a href=1>Another story</a><li><a href=2>And another</a></ul></div>"
         f"<div class='box sidebar'>Buy things now, they are cheap, good, and nothing but great for all of you.</div><p>{SIBLING}</p></body>", "", None,
         f"Home page News today Head line {STORY} Short one. \"So it is.\" {MORE} Another story And another "
         f"Buy things now, they are cheap, good, and nothing but great for all of you. {SIBLING}",
         f"Head line {STORY} Short one. \"So it is.\" {MORE} {SIBLING}"),
        # the text of a whole name counts, not of a part of it
        (f"<body><section class='related-work'><p>{STORY}</p></section><section><p>{MORE}</p></section></body>", "", None,
         f"{STORY} {MORE}", f"{STORY} {MORE}"),
        # nothing of a paragraph's size
        ("<body><nav>menu items</nav><main><p>Tiny text.</p></main><p>Other.</p></body>", "", None, "Tiny text. Other.", "Tiny text."),
        ("", "", "", "", ""),
    ]
    words = lambda s: " ".join(w for w in s.split() if len(w.encode()) > 1)
    return [(-1 - i, h, t, h if b is None else b, words(m), words(a)) for i, (h, t, b, m, a) in enumerate(rows)]


def meta_cases() -> list[tuple]:
    """(page_id, url, html, site_name, title, description, keywords,
    image_url, image_width, image_height)."""
    url = "https://www.site.example/a"
    rows = [
        ("<head><meta property=\"og:title\" content=\"It's good news\"><meta name='description' content='The \"Daily\"'></head>",
         "www.site.example", "It's good news", 'The "Daily"', None, None, None, None),
        ("<head><title>Plain</title><META CONTENT=short NAME=Description><meta content=\"a, b\" data-x='>' name=keywords></head>",
         "www.site.example", "Plain", "short", "a, b", None, None, None),
        ("<head><meta property=og:site_name content='A &amp; B'><meta property=og:image content=\"https://i.example/p?a=1&copy=2&amp;c=3\">"
         "<meta property='og:image:width' content=640><meta property='og:image:height' content=\"480\" /></head>",
         "A & B", "", None, None, "https://i.example/p?a=1&copy=2&c=3", "640", "480"),
        ("<head><meta property=\"og:title\" content=\"\"><meta property=\"og:title\" content=\"x > y\"><!-- <meta name=keywords content=no> -->"
         "</head><body><meta name=description content=late></body>", "www.site.example", "x > y", None, None, None, None, None),
    ]
    return [(-1 - i, url, *row) for i, row in enumerate(rows)]


def sql_values(rows: list[tuple], cols: list[str]) -> str:
    """DuckDB VALUES list for inline rows (strings via chr() for control chars)."""

    def q(v):
        if v is None:
            return "NULL"
        if isinstance(v, int):
            return str(v)
        parts, buf = [], ""
        tail = len(v) - len(v.rstrip(v[-1:]))
        if tail > 50:
            return f"({q(v[:-tail])} || repeat({q(v[-1])}, {tail}))"
        for ch in v:
            if ord(ch) < 32 or ord(ch) == 127 or ord(ch) > 126:
                if buf:
                    parts.append("'" + buf.replace("'", "''") + "'")
                    buf = ""
                parts.append(f"chr({ord(ch)})")
            else:
                buf += ch
        if buf or not parts:
            parts.append("'" + buf.replace("'", "''") + "'")
        return "(" + " || ".join(parts) + ")"

    body = ", ".join("(" + ", ".join(q(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(chr(34) + c + chr(34) for c in cols)})"
