"""Main text of HTML pages by nearest-URL page differencing (operator 6).

A page becomes lines: one per block of visible text, white space folded.
Elements that are page furniture by their tag, or by a class or id name all
of whose words say so, are left out at once, unless a named element or form
wraps the page's body, and lines know whether they stand in the page's
article (or main) element.  What furniture is left is found by differencing:
pages of a host are sorted by URL path, and a page's lines are aligned with
those of its nearest ``NEAR`` different pages on each side by a longest
common subsequence.  Pages in a row with the same lines count as one.

* Lines shared with at least half of them (two at least) are the *core*.
* A neighbour that shares more than half of what the core leaves of the page
  is a copy of the same article, which says nothing about the template; the
  next one on that side is taken.  So a short article under a long template
  is told from a copy.  A core of nearly the whole page is no template.
* Lines shared with the nearest neighbour that is no copy, on either side,
  are template and go.
* Inside an article element a shared line goes only if both neighbours have
  it and it belongs to the run of such lines at the article's start or end;
  a passage quoted in the middle of articles stays.

Neighbours meet by cutting the sorted keys into ranges by the bytes of the
table; a host of any size spans ranges, and one row of each of the ``NEAR``
paths beside a range is sent to it as well.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.url_digests import split_url
from quillstream.operators.ids import partitions_for

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>)",
    re.S,
)
MARKS = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[a-z0-9]+")

#: Elements whose content is never visible text.
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select button title head video audio".split())
#: Elements that hold page furniture.
FURNITURE = frozenset("nav footer aside form menu dialog".split())
#: Words of class, id or role that name page furniture.
FURNITURE_WORDS = frozenset(
    (
        "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
        "notice notices alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments reply replies "
        "respond disqus share sharing social related recommended newsletter subscribe subscription signup login popup modal "
        "overlay toolbar pagination pager widget complementary contentinfo search"
    ).split()
)
#: Words that may stand beside these in a name.
PLACE_WORDS = frozenset(
    "site page main top bottom left right global primary secondary container wrapper box block area list section bar inner outer "
    "links buttons items group panel col column row post entry article user the and".split()
)
#: The same, but only outside an article.
HEADER_WORDS = frozenset("header masthead topbar".split())
#: First words of class names that tell what a wrapper has beside its text.
STATE_WORDS = frozenset("with without has have no not is show hide".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr img".split()
)


class _Tags:
    """Tags of a page in order, with the closing tag of each element found by
    counting elements of its name."""

    def __init__(self, page: str) -> None:
        self.found = [(m.start(), m.end(), (m["name"] or "").lower(), bool(m["close"]), m["rest"] or "") for m in TAG.finditer(page)]
        self.by_name: dict[str, list[int]] = {}
        self.size: list[int] | None = None
        for i, (_, _, name, _, _) in enumerate(self.found):
            if name:
                self.by_name.setdefault(name, []).append(i)

    def closing(self, i: int) -> int | None:
        """Index of the tag that closes element i, if any."""
        name, depth = self.found[i][2], 0
        own = self.by_name[name]
        for j in own[bisect_left(own, i) :]:
            depth += -1 if self.found[j][3] else 1
            if depth == 0:
                return j
        return None


    def sizes(self, page: str) -> list[int]:
        """Characters of visible text before each tag, and in the page."""
        out, size, at, i = [], 0, 0, 0
        while i < len(self.found):
            begin, end, name, closing, rest = self.found[i]
            size += len("".join(page[at:begin].split()))
            j = self.closing(i) if name in RAW and not closing and not rest.endswith("/>") else None
            last = i if j is None else j
            out.extend([size] * (last + 1 - i))
            at, i = self.found[last][1], last + 1
        return [*out, size + len("".join(page[at:].split()))]

    def holds_body(self, page: str, i: int, j: int, in_article: bool) -> bool:
        """Whether element i, closed by tag j, holds what the page is about:
        its main element or longest article, or without these most of its
        text, beside the heading if there is one."""
        if self.size is None:
            self.size = self.sizes(page)
        opened = lambda name: [k for k in self.by_name.get(name, ()) if not self.found[k][3]]
        inside = lambda places: any(i < k < j for k in places)
        if not in_article:
            length = lambda k: self.size[self.closing(k) or -1] - self.size[k]
            if opened("main"):
                return inside(opened("main"))
            if opened("article"):
                return inside([max(opened("article"), key=length)])
        heads = opened("h1")
        return 2 * (self.size[j] - self.size[i]) > self.size[-1] and (inside(heads) or not (heads or in_article))


def _is_furniture(name: str, rest: str, in_article: bool) -> bool:
    if name in FURNITURE or (name == "header" and not in_article):
        return True
    if "=" not in rest or name in ("html", "body", "article", "main"):
        return False
    names = [WORD.findall(x) for m in MARKS.finditer(rest) for x in (m[1] or m[2] or m[3] or "").lower().split()]
    wanted = FURNITURE_WORDS if in_article else FURNITURE_WORDS | HEADER_WORDS

    def says_so(words: list[str]) -> bool:
        known = all(w in wanted or w in PLACE_WORDS or w.isdigit() for w in words)
        return known and any(w in wanted for w in words) and words[0] not in STATE_WORDS

    return any(words and says_so(words) for words in names)


def page_lines(page: str | None) -> list[tuple[str, bool]]:
    """(text, in article) of every visible block outside page furniture."""
    page = page or ""
    tags = _Tags(page)
    lines: list[tuple[str, bool]] = []
    held: list[str] = []
    depth, at, i = 0, 0, 0

    def close_block() -> None:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            lines.append((text, depth > 0))

    while i < len(tags.found):
        begin, end, name, closing, rest = tags.found[i]
        held.append(page[at:begin])
        at = end
        if name and name not in INLINE:
            close_block()
        if name == "article" or name == "main":
            depth = max(0, depth - 1) if closing else depth + 1
        elif name and not closing and name not in VOID and not rest.endswith("/>"):
            if name in RAW:
                j = tags.closing(i) if name not in ("script", "style") else next(
                    (k for k in tags.by_name[name][bisect_right(tags.by_name[name], i) :] if tags.found[k][3]), None
                )
                if j is None and name in ("script", "style", "textarea", "title"):
                    return lines  # never closed: the rest is its raw text
                if j is not None:
                    i, at = j, tags.found[j][1]
            elif _is_furniture(name, rest, depth > 0):
                j = tags.closing(i)
                wrapper = name not in FURNITURE or name == "form"
                # without an end it is a mark only
                if j is not None and not (wrapper and tags.holds_body(page, i, j, depth > 0)):
                    i, at = j, tags.found[j][1]
        i += 1
    held.append(page[at:])
    close_block()
    return lines


#: Bits of the length table, and of the masks of lines, that an alignment keeps at a time.
KEPT_BITS = 1 << 28


def common_lines(one: list[str], two: list[str], kept_bits: int = KEPT_BITS) -> list[int]:
    """Places in ``one`` of a longest common subsequence with ``two``.

    A row of the length table is one integer, a zero bit where the length
    grows (bit-parallel, so a line that is repeated thousands of times costs
    no more than others).  The way back needs the rows from the last to the
    first: of a longer table every n-th is kept, and those in between are
    made again from there.  Equal lines at both ends are matched beforehand.
    ``kept_bits`` bounds the memory and has no effect on the result."""
    head = 0
    while head < min(len(one), len(two)) and one[head] == two[head]:
        head += 1
    tail = 0
    while tail < min(len(one), len(two)) - head and one[-1 - tail] == two[-1 - tail]:
        tail += 1
    ends = [*range(head)], [*range(len(one) - tail, len(one))]
    a, b = one[head : len(one) - tail], two[head : len(two) - tail]
    # lines of one side only are on no way
    shared = set(a) & set(b)
    own = [i for i, line in enumerate(a) if line in shared]
    b = [line for line in b if line in shared]
    places: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        places.setdefault(line, []).append(j)
    full = (1 << len(b)) - 1
    kept = max(64, kept_bits // max(1, len(b)))

    @lru_cache(maxsize=kept)
    def mask(line: str) -> int:
        bits = bytearray(len(b) // 8 + 1)
        for j in places[line]:
            bits[j >> 3] |= 1 << (j & 7)
        return int.from_bytes(bits, "little")

    def rows(lo: int, hi: int, now: int):
        """Rows ``lo`` to ``hi``; ``now`` is the one before."""
        for i in own[lo:hi]:
            met = now & mask(a[i])
            now = ((now + met) | (now - met)) & full
            yield now

    found, j = [], len(b)

    def back(lo: int, hi: int, before: int) -> None:
        nonlocal j
        if hi - lo > kept:
            step = -(-(hi - lo) // kept)
            starts = [before, *islice(rows(lo, hi, before), step - 1, hi - lo - 1, step)]
            for k in range(len(starts) - 1, -1, -1):
                back(lo + k * step, min(hi, lo + (k + 1) * step), starts.pop())
            return
        table, i = [before, *rows(lo, hi, before)], hi - lo
        while i and j:
            if table[i] >> (j - 1) & 1:
                j -= 1
            elif not table[i - 1] >> (j - 1) & 1:
                i -= 1
            else:
                i, j = i - 1, j - 1
                found.append(head + own[lo + i])

    back(0, len(own), full)
    return ends[0] + found[::-1] + ends[1]


def _by_occurrence(one: list[str], two: list[str]) -> list[int]:
    """Longest rise over the places where the n-th occurrence of a line in
    one page meets the n-th in the other: common lines in one pass, not
    always the most.  ``common_lines`` does not use it."""
    count: dict[str, int] = {}
    where: dict[tuple[str, int], int] = {}
    for j, line in enumerate(two):
        count[line] = count.get(line, 0) + 1
        where[line, count[line]] = j
    count.clear()
    tails: list[int] = []  # smallest end of a rise of each length
    nodes: list[tuple[int, tuple | None]] = []
    for i, line in enumerate(one):
        count[line] = count.get(line, 0) + 1
        j = where.get((line, count[line]))
        if j is None:
            continue
        k = bisect_left(tails, j)
        node = (i, nodes[k - 1] if k else None)
        tails[k:], nodes[k:] = ([j, *tails[k + 1 :]], [node, *nodes[k + 1 :]]) if k < len(tails) else ([j], [node])
    out, node = [], nodes[-1] if nodes else None
    while node:
        out.append(node[0])
        node = node[1]
    return out[::-1]


#: Different pages that a page is compared with on each side.
NEAR = 4
#: A core of more than this share of a page is no template but its copies.
MOST_CORE = 0.9

Lines = list[tuple[str, bool]]


def main_text(lines: Lines, before: list[Lines], after: list[Lines]) -> str:
    """Lines of a page that are left after differencing, joined by a blank.
    ``before`` and ``after`` hold its neighbours, the nearest first."""
    texts = [t for t, _ in lines]
    chars = lambda places: sum(len(texts[i]) for i in places)
    near = [[set(common_lines(texts, [t for t, _ in other])) for other in side] for side in (before, after)]
    votes: dict[int, int] = {}
    for shared in (*near[0], *near[1]):
        for i in shared:
            votes[i] = votes.get(i, 0) + 1
    enough = max(2, -(-(len(near[0]) + len(near[1])) // 2))
    core = {i for i, n in votes.items() if n >= enough}
    if chars(core) > MOST_CORE * chars(range(len(texts))):
        core = set()
    rest = chars(range(len(texts))) - chars(core)
    hits = [next((s for s in side if 2 * chars(s - core) <= rest), None) for side in near]
    hits = [s for s in hits if s is not None]
    either, both = set().union(*hits), set.intersection(*hits) if len(hits) == 2 else set()
    inside = [i for i, (_, own) in enumerate(lines) if own]
    gone = {i for i in either if not lines[i][1]}
    for run in (inside, inside[::-1]):
        for i in run:
            if i not in both:
                break
            gone.add(i)
    own = [texts[i] for i in inside if i not in gone]
    if 2 * sum(map(len, own)) > sum(len(t) for i, t in enumerate(texts) if i not in gone):
        return " ".join(own)
    return " ".join(t for i, t in enumerate(texts) if i not in gone)


def sort_key(url: str | None, page_id: int | None) -> str:
    """Host, path, url and id in an order as text; a null id comes first."""
    return "\0".join((*split_url(url), url or "", "" if page_id is None else f"{page_id + (1 << 63):020d}"))


KEY_SCHEMA = "page_id bigint, url string, key string, lines string, marks string"


def _parsed(pages: DataFrame) -> DataFrame:
    """Sort key (host, path, url, id) and lines of every page."""

    def parse(batches):
        for batch in batches:
            ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            found = [page_lines(p) for p in batch.column(2).to_pylist()]
            keys = [sort_key(u, i) for i, u in zip(ids, urls, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(keys, pa.string()),
                    pa.array(["\n".join(t for t, _ in x) for x in found], pa.string()),
                    pa.array(["".join("a" if own else "o" for _, own in x) for x in found], pa.string()),
                ],
                names=["page_id", "url", "key", "lines", "marks"],
            )

    return pages.mapInArrow(parse, KEY_SCHEMA)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    Defined cases: a null or empty page, or one without visible text, has
    the empty text; a null url or one without ``://`` has the empty host,
    whose pages are not compared; null ids sort first among equal urls;
    repeated rows, and pages in a row with the same lines, are one page to
    their neighbours and get the same text; an empty table gives no rows;
    other columns are ignored."""
    own = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    parts = partitions_for(pages)
    ranges = _ranges(own, parts)
    lows = [r["low"] for r in ranges]
    guests: dict[str, set[int]] = {}
    for r in range(len(ranges)):
        for step in (-1, 1):  # one row of each of the NEAR paths beside the range
            found, at = 0, r + step
            while 0 <= at < len(ranges) and found < NEAR:
                for key in ranges[at]["last" if step < 0 else "first"][: NEAR - found]:
                    guests.setdefault(key, set()).add(r)
                    found += 1
                at += step

    def deal(batches):
        for batch in batches:
            places, rows = [], []
            for i, key in enumerate(batch["key"].to_pylist()):
                home = bisect_right(lows, key) - 1
                for place in (home, *sorted(guests.get(key, ()))):
                    places.append(place)
                    rows.append((i, place != home))
            taken = batch.take(pa.array([i for i, _ in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(places, pa.int32()), pa.array([g for _, g in rows], pa.bool_())],
                names=[*batch.schema.names, "range", "guest"],
            )

    def compare(batches):
        now, past, open_, out = None, [], [], []

        def solve(run: Run) -> None:
            text = main_text(run.lines, run.before, run.after) if run.rows else ""
            out.extend((*row, text, len(text)) for row in run.rows)

        def flush():
            types = (pa.int64(), pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["page_id", "url", "text", "n_chars"])

        for batch in batches:
            for page_id, url, key, lines, marks, place, guest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                host = key.split("\0", 1)[0]
                if now is None or (now.place, now.host, now.text, now.marks) != (place, host, lines, marks):
                    now = Run(place, host, lines, marks, past)
                    for run in open_:
                        run.meet(now)
                    for run in [x for x in open_ if x.ready(now)]:
                        solve(run)
                        open_.remove(run)
                    open_.append(now)
                    past = [now, *past][: 2 * NEAR]
                if not guest:
                    now.rows.append((page_id, url))
            if len(out) > 500:
                yield flush()
                out = []
        for run in open_:
            solve(run)
        if out:
            yield flush()

    dealt = _parsed(own).mapInArrow(deal, KEY_SCHEMA + ", range int, guest boolean")
    ordered = dealt.repartition(parts, "range").sortWithinPartitions("range", "key")
    return ordered.mapInArrow(compare, "page_id bigint, url string, text string, n_chars bigint")


class Run:
    """Pages in a row with the same lines, and their different neighbours."""

    def __init__(self, place: int, host: str, text: str, marks: str, past: list[Run]) -> None:
        self.place, self.host, self.text, self.marks = place, host, text, marks
        self.lines = [(t, m == "a") for t, m in zip(text.split("\n"), marks, strict=True)] if marks else []
        self.rows: list[tuple] = []
        self.seen, self.before, self.after = {text}, [], []
        for other in past:
            self._take(other, self.before)
        self.seen = {text}

    def _take(self, other: Run, side: list) -> None:
        if self.host and (other.place, other.host) == (self.place, self.host) and other.text not in self.seen and len(side) < NEAR:
            self.seen.add(other.text)
            side.append(other.lines)

    def meet(self, other: Run) -> None:
        self._take(other, self.after)

    def ready(self, newest: Run) -> bool:
        return len(self.after) == NEAR or (newest.place, newest.host) != (self.place, self.host)


def _ranges(own: DataFrame, parts: int) -> list:
    """Cuts of the sorted keys: the lowest key of each range, and one key of
    each of its first and last ``NEAR`` paths.  A few keys a range reach the
    driver; ranges are cut by the bytes of the table."""

    def keys(batches):
        for batch in batches:
            found = [sort_key(u, i) for i, u in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["key"])

    def ends(batches):
        first, last, low, path = [], [], None, None
        for batch in batches:
            for key in batch.column(0).to_pylist():
                low = key if low is None else low
                here = key.split("\0", 2)[:2]
                if here != path:
                    path = here
                    if len(first) < NEAR:
                        first.append(key)
                    last = [key, *last][:NEAR]
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([first]), pa.array([last])], names=["low", "first", "last"])

    narrow = own.select("page_id", "url").mapInArrow(keys, "key string")
    cut_ = narrow.repartitionByRange(parts, "key").sortWithinPartitions("key")
    found = cut_.mapInArrow(ends, "low string, first array<string>, last array<string>")
    return sorted(found.collect(), key=lambda r: r["low"])
