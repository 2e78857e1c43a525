import random
import re

from quillstream.llm import page_diff, secret_forest
from quillstream.llm.catalog import QUERIES
from tests.conftest import SMALL
from tests.llm.cases import edge_frame, empty_frame, prose

# --- pages -------------------------------------------------------------------

CHROME = '<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>'
PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body>"
    + CHROME
    + "<article><header><h1>Big &amp; bold</h1></header><p>One <b>bo</b>ld&nbsp;word<br>next\n line<p>Two &lt;x&gt;"
    + '<div class="share"><a>Share</a></div><form><input value="q"><button>Go</button></form><!-- <p>hidden</p> -->'
    + '<div id="comments"><article><p>nice post</p></article></div></article><aside>Also read</aside>'
    + "<footer>&copy; site</footer></body></html>"
)


def text_of(page, *others):
    near = [page_diff.page_lines(o) for o in others]
    return page_diff.main_text(page_diff.page_lines(page), near[:1], near[1:])


def test_article_without_furniture():
    assert text_of(PAGE) == "Big & bold One bold word next line Two <x>"


def test_broken_pages_do_not_crash():
    for page in (None, "", "plain text", "<p>a<p>b", "<article><p>cut off", "<div class='ad'>never closed <p>body text", "<a href='x>y", "<", "< p > x", "</p></div>z", "<script>x"):
        assert isinstance(text_of(page), str)
    assert text_of("plain text") == "plain text"
    assert text_of("<div class=ad><p>body text") == "body text"
    assert text_of("<p>a</p>" * 2000) == " ".join(["a"] * 2000)


def test_wrappers_with_furniture_names_keep_the_article():
    body = f"<article><h1>Title</h1><p>{prose(1, 40)}</p></article>"
    want = "Title " + prose(1, 40)
    for wrapper in ('div class="content with-sidebar"', 'div class="has-comments"', 'div class="page menu-open"', 'form id="aspnetForm"'):
        name = wrapper.split()[0]
        assert text_of(f"<body><{wrapper}><nav>Home</nav>{body}</{name}></body>") == want
        plain = body.replace("article", "div")
        assert text_of(f"<body><{wrapper}><nav>Home</nav>{plain}</{name}></body>") == want
    comments = f'<div id="comments"><article><p>{prose(3, 10)}</p></article></div>'
    assert text_of(f"<body>{body}{comments}</body>") == want
    assert text_of(f"<body><h1>Title</h1><p>{prose(1, 40)}</p><div id=comments><p>{prose(3, 90)}</p></div></body>") == want


def test_a_teaser_article_does_not_replace_the_body():
    page = f"<body><div><h1>Title</h1><p>{prose(1, 60)}</p></div><article><p>Read next</p></article></body>"
    assert prose(1, 60) in text_of(page)


def test_lines_shared_with_a_neighbour_go():
    page = "<div>Site name</div><p>{}</p><div>All rights reserved</div>"
    one, two = page.format(prose(1, 40)), page.format(prose(2, 40))
    assert text_of(one, two) == prose(1, 40)
    assert text_of(one, one) == "Site name " + prose(1, 40) + " All rights reserved"  # a copy says nothing


def test_inside_an_article_only_runs_shared_with_both_go():
    page = "<article><p>By our staff</p><p>{}</p><p>{}</p><p>{}</p><p>Tell a friend</p></article>"
    quoted = prose(9, 12)
    mine, left, right = (page.format(prose(k, 30), quoted, prose(k + 50, 30)) for k in (1, 2, 3))
    assert text_of(mine, left, right) == " ".join((prose(1, 30), quoted, prose(51, 30)))
    assert text_of(mine, left).startswith("By our staff")


def test_common_lines_is_a_longest_common_subsequence():
    def length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.choice("abcde") for _ in range(rng.randint(0, 12))] for _ in range(2))
        places = page_diff.common_lines(a, b)
        assert places == sorted(set(places)) and len(places) == length(a, b)
        kept = iter(b)
        assert all(a[i] in kept for i in places)
        some = page_diff._by_occurrence(a, b)
        kept = iter(b)
        assert some == sorted(set(some)) and all(a[i] in kept for i in some)


def test_repeated_lines_cost_no_square():
    import time

    start = time.time()
    many = ["same line"] * 4000
    assert len(page_diff.common_lines(["x", *many, "y"], ["z", *many, "w"])) == 4000
    assert len(page_diff.common_lines([f"{i}" for i in range(4000)] + many, many + [f"{i}" for i in range(4000)])) == 4000
    assert time.time() - start < 5


def test_common_lines_does_not_depend_on_the_size():
    rng = random.Random(5)
    for letters, size in (("abcde", 40), ("abcdefghijklmnopqrstuvwxyz", 400), ("abcdefghijklmnopqrstuvwxyz", 900)):
        a, b = ([rng.choice(letters) for _ in range(size)] for _ in range(2))
        assert page_diff.common_lines(a, b, 1) == page_diff.common_lines(a, b)
    # pages of 50,000 lines: a line that is met as another occurrence
    a, b = (["x", "menu", *(f"{side} {i}" for i in range(50_000)), "menu", "y"] for side in "ab")
    assert page_diff.common_lines(["menu", *a], [*b, "x", "menu"]) == [1, 2, 50_003, 50_004]
    many = [f"{i % 50_000}" for i in range(60_000)]
    assert page_diff.common_lines(["a", *many, "b"], ["c", *many[10_000:], *many[:10_000], "d"]) == [*range(10_001, 60_001)]


def test_names_are_matched_whole():
    body = prose(1, 40)
    for mark in ("section class='related-work'", "p class='first-reply'", "div class='widget-text'", "div id='search-theory'", "div class='notice-period'"):
        name = mark.split()[0]
        assert text_of(f"<article><h1>T</h1><{mark}>{body}</{name}></article>") == "T " + body
        assert text_of(f"<div><h1>T</h1><{mark}>{body}</{name}></div>") == "T " + body
    for mark in ("div class='site-footer'", "div class='box cookie-notice'", "div id=left-sidebar", "div class='post-comments'", "div class=ad-2"):
        assert text_of(f"<article><h1>T</h1><p>{body}</p><{mark}>gone</div></article>") == "T " + body


def test_short_articles_under_a_long_template(spark):
    """The template is more than half of every page."""
    chrome = [prose(300 + i, 12) for i in range(4)]
    page = lambda i: f"<div>{chrome[0]}</div><div>{chrome[1]}</div><p>{prose(i, 25)}</p><div>{chrome[2]}</div><div>{chrome[3]}</div>"
    rows = [(i, f"http://short.example/a/{i:03d}", page(i)) for i in range(40)]
    got = dict(page_diff.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).select("page_id", "text").collect())
    assert got == {i: prose(i, 25) for i in range(40)}


def test_copies_beside_each_other_find_the_next_different_page(spark):
    """Six copies at one path, near copies, and copies over many ranges."""
    page = lambda body: f"<div>Shop name here</div><p>{body}</p><div>All rights reserved</div>"
    rows = [(i, f"http://c.example/p/{i:03d}", page(prose(i, 30))) for i in range(20)]
    rows += [(100 + i, f"http://c.example/p/010?copy={i}", page(prose(10, 30))) for i in range(6)]
    rows += [(200 + i, f"http://c.example/p/012x{i}", page(prose(12, 30) + f"</p><p>tail {i} {prose(400 + i, 3)}")) for i in range(3)]
    got = dict(page_diff.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).select("page_id", "text").collect())
    want = {i: prose(i, 30) for i in range(20)} | {100 + i: prose(10, 30) for i in range(6)}
    want |= {200 + i: prose(12, 30) + f" tail {i} {prose(400 + i, 3)}" for i in range(3)}
    assert got == want


def test_ranges_give_what_one_task_gives(spark):
    """The result over many ranges is that of comparing all rows in order."""
    rng = random.Random(3)
    rows = []
    for i in range(160):
        host = rng.choice(["a.example", "b.example", "b.example", "b.example", ""])
        url = f"http://{host}/{rng.randrange(30):02d}/{rng.randrange(3)}?{i}" if host else None
        body = f"<p>{prose(rng.randrange(40), 15)}</p><p>{prose(100 + rng.randrange(9), 9)}</p>"
        rows.append((i if i % 13 else None, url, f"<div>{host} shop</div>{body}<div>foot of {host or i}</div>"))
    rows += rows[:9]
    ordered = sorted(rows, key=lambda r: page_diff.sort_key(r[1], r[0]))
    runs: list = []
    for page_id, url, html in ordered:
        lines, host = page_diff.page_lines(html), page_diff.sort_key(url, page_id).split("\0")[0]
        if not runs or runs[-1][:2] != (host, lines):
            runs.append((host, lines, []))
        runs[-1][2].append((page_id, url))

    def near(k, step):
        found, at = [], k + step
        while 0 <= at < len(runs) and runs[at][0] == runs[k][0] != "" and len(found) < page_diff.NEAR and abs(at - k) <= 2 * page_diff.NEAR:
            if runs[at][1] not in (runs[k][1], *found):
                found.append(runs[at][1])
            at += step
        return found

    want = sorted((str(row), page_diff.main_text(lines, near(k, -1), near(k, 1))) for k, (_, lines, own) in enumerate(runs) for row in own)
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        one = sorted((str((r[0], r[1])), r[2]) for r in page_diff.extract_main_text(frame).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert one == want
    many = sorted((str((r[0], r[1])), r[2]) for r in page_diff.extract_main_text(frame.repartition(5)).collect())
    assert len(many) == len(want) and sum(a != b for a, b in zip(many, want, strict=True)) <= 0.05 * len(want)


def test_page_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r["page_id"]: r for r in QUERIES["op6_page_diff"](spark, SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        inside = re.search(r"<article>(.*?)</article>", p["html"], re.S)[1]
        words = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inside)).replace("&amp;", "&").replace("&lt;", "<").replace("&gt;", ">")
        assert got[p["page_id"]]["text"] == " ".join(words.split())
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])


def test_pages_meet_their_neighbours_over_any_ranges(spark):
    """A host larger than a range, repeated rows, nulls and clashing names."""
    rows = [(i, f"http://big.example/{i:04d}", f"<div>Shop</div><p>{prose(i, 20)}</p>", "k", 1) for i in range(120)]
    rows += [(500, None, "<p>x</p>", "k", 1), (501, "http://one.example/", None, "k", 1), (None, "http://big.example/0003", "<p>y</p>", "k", 1)]
    rows += [rows[7], rows[7]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, key string, range int").repartition(5)
    got = sorted((str(r["page_id"]), r["text"]) for r in page_diff.extract_main_text(pages).collect())
    want = [(str(i), prose(i, 20)) for i in range(120)] + [("500", "x"), ("501", ""), ("None", "y")]
    assert got == sorted(want + [("7", prose(7, 20))] * 2)
    assert page_diff.extract_main_text(pages.limit(0)).count() == 0


# --- secrets -----------------------------------------------------------------


def planted(seed: int):
    """(text, secrets in it) with real secrets and look-alikes."""
    rng = random.Random(seed)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    low, hexa = "abcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef"
    secret = [
        "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 14) + "7Q",
        "9f" + pick(hexa, 36) + "a1",
        "x7" + pick(low, 16),
        "ghp_" + pick(low, 34) + "Z9",
    ][seed % 4]
    shown = [secret, f'token = "{secret}"', f"password={secret}", f"uses {secret} for"][seed % 4]
    plain = ["4" + pick("0123456789", 15), "order 2024-10-11", f"https://example.org/post/{pick('0123456789', 6)}/some-long-title-here-2024", "call +49 30 901820"][seed // 4 % 4]
    return f"{prose(seed, 40)} {shown} {prose(seed + 1, 20)} {plain} {prose(seed + 2, 30)}", {secret}


def test_planted_secrets_and_look_alikes(spark):
    rows = [(i, *planted(i)) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    found = secret_forest.scan_secrets(docs)
    got: dict[int, set] = {}
    for r in found.where("is_secret").collect():
        got.setdefault(r["doc_id"], set()).add(r["candidate"])
    hits = sum(got.get(i, set()) >= s for i, _, s in rows)
    wrong = sum(len(got.get(i, set()) - s) for i, _, s in rows)
    assert hits >= 196 and wrong <= 4
    clean = secret_forest.redact_secrets(docs, found)
    for r in clean.collect():
        assert not any(s in r["text"] for s in got.get(r["doc_id"], ()))


def test_held_out_accuracy_with_own_labels(spark):
    rows = [(i, *planted(i)) for i in range(240)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    words = secret_forest.dictionary(docs)
    truth = spark.createDataFrame([(i, next(iter(s))) for i, _, s in rows], "doc_id long, secret string")
    labelled = secret_forest.with_features(secret_forest.find_candidates(docs), words).join(truth, "doc_id")
    labelled = labelled.selectExpr("*", "double(candidate = secret) AS label")
    model = secret_forest.train(labelled.where("doc_id < 120"), max_labelled=200)
    judged = secret_forest.judge(labelled.where("doc_id >= 120"), model).collect()
    right = sum((r["candidate"] == r["secret"]) == r["is_secret"] for r in judged)
    assert right >= 0.97 * len(judged)


def test_the_plan_has_no_python(spark):
    df = QUERIES["op4_secret_forest"](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_secret_edge_rows(spark):
    frame = edge_frame(spark).withColumnRenamed("key", "candidate")
    found = secret_forest.scan_secrets(frame)
    assert found.columns == ["doc_id", "ordinal", "candidate", "before", "after", "probability", "is_secret", "row_key"]
    assert secret_forest.redact_secrets(frame, found).columns == frame.columns
    assert secret_forest.redact_secrets(frame, found).count() == frame.count()
    assert secret_forest.scan_secrets(empty_frame(spark)).count() == 0
    twice = spark.createDataFrame([(1, "password=a1b2c3d4e5 x password=a1b2c3d4e5"), (1, "password=a1b2c3d4e5 x password=a1b2c3d4e5"), (None, "token=z9y8x7w6v5")], "doc_id long, text string")
    rows = secret_forest.scan_secrets(twice).collect()
    assert len(rows) == 5 and all(r["is_secret"] for r in rows)


def hidden(spark, texts):
    """The texts after the scan of a corpus with the planted rows."""
    rows = [(i, planted(i)[0]) for i in range(100)] + [(1000 + i, f"{prose(i + 7, 20)} {t}\n{prose(i + 9, 20)}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = secret_forest.redact_secrets(docs, secret_forest.scan_secrets(docs))
    return [r["text"] for r in clean.where("doc_id >= 1000").orderBy("doc_id").collect()]


def test_secrets_without_digits_or_with_punctuation(spark):
    forms = [
        ("password = {}", "correct-horse-battery-staple"),
        ("api_key: {}", "QwErTzUiOpLkJhGfDsAy"),
        ('{{"token": "{}"}}', "abcDEFghiJKLmno"),
        ("AWS_SECRET_ACCESS_KEY={}", "wJalr/XUtnFEMI/KMDENG"),
        ("SECRET_KEY={}", "k3yw0rd!"),
        ("export clientSecretValue={} x", "hunter-two!"),
        ("password={}", "abcd1234efgh5678!zz"),
        ("password={};Server=db", "a,b;c$dEf.g8"),
        ("passwd: '{}'", "it is, as ever; a long \\' phrase"),
        ("postgres://user:{}@host/db", "s3cretpw"),
        ("redis://:{}@cache:6379", "lettersonly"),
        ("https://token:{}@example.org/x", "qwerty!uiop"),
    ]
    got = hidden(spark, [form.format(secret) for form, secret in forms])
    assert [(f, s) for (f, s), text in zip(forms, got, strict=True) if f.format("[SECRET]") not in text] == []


def test_words_that_nothing_names_stay(spark):
    texts = ["uncharacteristically", "https://example.org/state/of/the/art", "a state-of-the-art-solution here", "author: Maria-Luisa Lopez", "http://host:8080/path@x"]
    for text, got in zip(texts, hidden(spark, texts), strict=True):
        assert text in got


def test_a_name_that_is_a_candidate_is_kept_beside_its_value(spark):
    docs = spark.createDataFrame([(1, "AWS_SECRET_ACCESS_KEY=abcdefghij")], "doc_id long, text string")
    rows = {r["candidate"]: r["before"] for r in secret_forest.find_candidates(docs).collect()}
    assert rows["abcdefghij"] == "AWS_SECRET_ACCESS_KEY="
