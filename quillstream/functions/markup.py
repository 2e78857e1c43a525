"""Element trees of HTML texts, for the Arrow-batched column functions of
``functions.html``.

One left-to-right scan makes the tokens (comments, tags whose attributes may
be quoted, raw text) and keeps a stack of open elements, so nesting is
exact, a ``>`` inside an attribute value ends nothing, and cost is linear in
the page.  A page is a small value of a row: nothing here knows of Spark.
"""

from __future__ import annotations

import html as references
import re

# Fixed values of the HTML standard: elements without content, with raw
# content, whose start ends an open paragraph, and that bound the search
# for an element to close.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
DECODED_RAW = frozenset(("title", "textarea"))
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details dd dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table ul".split()
)
SCOPE = frozenset("applet caption html marquee object table td template th".split())
TABLE_PARTS = frozenset("caption table tbody td tfoot th thead tr".split())
# start tag: the open elements it ends, and the elements that stop the search
ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "tr": (frozenset(("tr",)), frozenset(("table", "tbody", "thead", "tfoot"))),
}
# inline elements: text in them belongs to the block around them
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)

_ATTRIBUTES = r"""(?:[^>=]|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)*+"""
_TOKEN = re.compile(
    rf"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<attributes>{_ATTRIBUTES})(?P<close>>|\Z)|[!?/][^>]*+(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>][^\s=/>]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>"'][^\s>]*))?)?""", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}
_OPEN_REFERENCE = re.compile(r"&(?![A-Za-z0-9#]+;)")


class Tree:
    """Elements in document order (index 0 is the document): ``tags``,
    ``raw`` attribute texts, ``parents`` and source positions (``starts``,
    ``ends``), and ``texts`` as (element, text) in document order."""

    __slots__ = ("ends", "parents", "raw", "starts", "tags", "texts")

    def __init__(self, page: str) -> None:
        self.tags, self.raw, self.parents = [""], [""], [-1]
        self.starts, self.ends = [0], [len(page)]
        self.texts: list[tuple[int, str]] = []
        self._scan(page)

    def _scan(self, page: str) -> None:
        tags, stack, open_, at, joined = self.tags, [0], {}, 0, False

        def pop_to(place: int, end: int) -> None:
            for element in stack[place:]:
                open_[tags[element]] -= 1
                self.ends[element] = end
            del stack[place:]

        def find(names, stops) -> int:
            for place in range(len(stack) - 1, 0, -1):
                tag = tags[stack[place]]
                if tag in names:
                    return place
                if tag in stops:
                    return 0
            return 0

        def text(a: int, b: int, decode: bool = True) -> None:
            nonlocal joined
            if a < b:
                piece = page[a:b]
                piece = references.unescape(piece) if decode and "&" in piece else piece
                if joined and self.texts and self.texts[-1][0] == stack[-1]:
                    self.texts[-1] = (stack[-1], self.texts[-1][1] + piece)
                else:
                    self.texts.append((stack[-1], piece))
                joined = False

        end_of_text = len(page)
        while at < end_of_text:
            token = _TOKEN.search(page, at)
            if token is None:
                text(at, end_of_text)
                break
            start, after = token.span()
            text(at, start)
            at = after
            name = token["name"]
            if name is None:
                continue
            if not token["close"]:  # the page ends inside the tag
                break
            name = name.lower()
            if token["end"]:
                # content behind </body> and </html> still belongs to them
                place = 0
                if open_.get(name) and name not in ("body", "html"):
                    place = find((name,), () if name in TABLE_PARTS else SCOPE)
                if place:
                    pop_to(place, after)
                elif name in ("body", "html"):
                    self._mark_end(name, after)
                else:  # an end tag of nothing does not even part a text
                    joined = bool(self.texts)
                continue
            if name in ("html", "body", "head") and open_.get(name):
                continue
            if name in ENDS_PARAGRAPH and open_.get("p"):
                place = find(("p",), SCOPE)
                if place:
                    pop_to(place, start)
            if name in ENDS:
                names, stops = ENDS[name]
                if any(open_.get(n) for n in names):
                    place = find(names, stops)
                    if place:
                        pop_to(place, start)
            element = len(tags)
            tags.append(name)
            self.raw.append(token["attributes"])
            self.parents.append(stack[-1])
            self.starts.append(start)
            self.ends.append(after if name in VOID else end_of_text)
            if name in VOID:
                continue
            stack.append(element)
            open_[name] = open_.get(name, 0) + 1
            if name in RAW:
                end = _RAW_END[name].search(page, at)
                text(at, end.start() if end else end_of_text, decode=name in DECODED_RAW)
                at = end.start() if end else end_of_text

    def _mark_end(self, name: str, end: int) -> None:
        first = self.first(name)
        if first and self.ends[first] == self.ends[0]:
            self.ends[first] = end

    def first(self, *names: str) -> int:
        """The first element with one of the names, 0 if there is none."""
        return next((i for i, tag in enumerate(self.tags) if tag in names), 0)

    def inside(self, marked) -> list[bool]:
        """Per element: it or an element around it is marked."""
        out = [False] * len(self.tags)
        for i, parent in enumerate(self.parents):
            out[i] = bool(marked(i)) or (parent >= 0 and out[parent])
        return out

    def attributes(self, element: int) -> dict[str, str]:
        """Attributes by lower-case name; the first of a name counts."""
        out: dict[str, str] = {}
        for name, double, single, plain in _ATTRIBUTE.findall(self.raw[element]):
            out.setdefault(name.lower(), decoded_value(double or single or plain))
        return out


def decoded_value(value: str) -> str:
    """Character references of an attribute value: unlike in text, one
    without its semicolon stays as it is (``?a=1&copy=2``)."""
    return references.unescape(_OPEN_REFERENCE.sub("&amp;", value)) if "&" in value else value


def title(page: str) -> str:
    """Text of the first title element, '' if there is none."""
    tree = Tree(page)
    own = tree.first("title")
    return next((text for element, text in tree.texts if own and element == own), "")


def visible_text(page: str, skipped: frozenset) -> str:
    """Text outside the ``skipped`` elements, one space between text nodes."""
    tree = Tree(page)
    hidden = tree.inside(lambda i: tree.tags[i] in skipped)
    return " ".join(text.strip() for element, text in tree.texts if not hidden[element])


def body(page: str) -> str:
    """Source of the body element, '' if there is none."""
    tree = Tree(page)
    own = tree.first("body")
    return page[tree.starts[own] : tree.ends[own]] if own else ""


def metadata(page: str) -> dict[str, str]:
    """Contents of the meta elements before the body by property or name
    (lower case; the first that is not empty counts), and ``<title>``."""
    return tree_metadata(Tree(page))


def tree_metadata(tree: Tree) -> dict[str, str]:
    end = tree.first("body") or len(tree.tags)
    out: dict[str, str] = {}
    for i in range(1, end):
        if tree.tags[i] == "meta":
            own = tree.attributes(i)
            key = (own.get("property") or own.get("name") or "").strip().lower()
            if key and own.get("content"):
                out.setdefault(key, own["content"])
    first = tree.first("title")
    out["<title>"] = next((text for element, text in tree.texts if first and element == first), "")
    return out


# ---------------------------------------------------------------- articles
# Sizes and weights of the article rule (see ``article``).
MIN_PARAGRAPH = 25
LONG_SIBLING = 80
TAG_WEIGHT = {"article": 25, "main": 25, "section": 5, "div": 5, "blockquote": 3, "pre": 3, "td": 3} | dict.fromkeys(
    ("address", "dd", "dl", "dt", "form", "li", "ol", "ul"), -3
) | dict.fromkeys(("h1", "h2", "h3", "h4", "h5", "h6", "th"), -5)
NAME_WEIGHT = 25
ARTICLE_NAMES = frozenset("article body content entry main post story text".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments cookie disqus footer menu nav newsletter "
    "pagination pager popup promo promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: Elements whose text is never part of an article.
NO_ARTICLE = frozenset(
    "aside button footer form header iframe nav noscript object script select style svg template textarea title".split()
)
#: A paragraph's own text counts for its parents, a container's for itself.
PARAGRAPHS = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
LISTS = frozenset("dl div ol p section table td ul".split())


def _name_weight(attributes: dict[str, str]) -> int:
    names = {n for v in (attributes.get("class", ""), attributes.get("id", "")) for n in v.lower().split()}
    return NAME_WEIGHT * (bool(names & ARTICLE_NAMES) - bool(names & FURNITURE_NAMES))


class Article:
    """Scores of a page's blocks, and what is kept of it."""

    def __init__(self, tree: Tree) -> None:
        self.tree = tree
        n = len(tree.tags)
        self.block, self.linked = list(range(n)), [False] * n
        for i in range(1, n):
            parent = tree.parents[i]
            if tree.tags[i] in INLINE:
                self.block[i] = self.block[parent]
            self.linked[i] = self.linked[parent] or tree.tags[i] == "a"
        self.name = [_name_weight(tree.attributes(i)) if "class" in tree.raw[i].lower() or "id" in tree.raw[i].lower() else 0 for i in range(n)]
        self.dropped = tree.inside(lambda i: tree.tags[i] in NO_ARTICLE or self.name[i] < 0)
        # own text of each block, then totals of its subtree
        self.own, self.commas, own_links = [0] * n, [0] * n, [0] * n
        self.ends_sentence = [False] * n
        for element, text in tree.texts:
            text = " ".join(text.split())
            if not text or self.dropped[element]:
                continue
            b = self.block[element]
            self.own[b] += len(text)
            self.commas[b] += text.count(",")
            self.ends_sentence[b] = text[-1] in ".!?"
            if self.linked[element]:
                own_links[b] += len(text)
        self.size, self.links = list(self.own), list(own_links)
        for i in range(n - 1, 0, -1):
            self.size[tree.parents[i]] += self.size[i]
            self.links[tree.parents[i]] += self.links[i]
        self._score(own_links)

    def density(self, i: int) -> float:
        return self.links[i] / self.size[i] if self.size[i] else 0.0

    def _score(self, own_links: list[int]) -> None:
        """Each paragraph gives its score to its parent block, half of it to
        the block around that."""
        tree, n = self.tree, len(self.tree.tags)
        self.score = [0.0] * n
        for i in range(1, n):
            if self.block[i] != i or self.own[i] < MIN_PARAGRAPH or self.dropped[i]:
                continue
            worth = (1 + self.commas[i] + min(3, self.own[i] // 100)) * (1 - own_links[i] / self.own[i])
            up = self.block[tree.parents[i]] if tree.tags[i] in PARAGRAPHS else i
            self.score[up] += worth
            if up:
                self.score[self.block[tree.parents[up]]] += worth / 2
        for i in range(1, n):
            if self.score[i] > 0:
                self.score[i] = max(0.0, self.score[i] + TAG_WEIGHT.get(tree.tags[i], 0) + self.name[i]) * (1 - self.density(i))

    def roots(self) -> set[int]:
        """The best block and its siblings that read like it."""
        tree = self.tree
        best = max(range(len(tree.tags)), key=lambda i: (self.score[i], -i))
        if self.score[best] <= 0:  # nothing of a paragraph's size: all of the main element
            named = next((i for i, tag in enumerate(tree.tags) if tag in ("article", "main") and self.size[i]), 0)
            return {named or tree.first("body")}
        kept = {best}
        for i in range(1, len(tree.tags)):
            if tree.parents[i] != tree.parents[best] or self.dropped[i] or not self.size[i]:
                continue
            alike = self.score[i] >= self.score[best] / 5 and self.size[i] > LONG_SIBLING
            text = tree.tags[i] in PARAGRAPHS or self.own[i] == self.size[i]
            prose = self.size[i] > LONG_SIBLING and self.density(i) < 0.25
            short = self.size[i] <= LONG_SIBLING and not self.links[i] and self.ends_sentence[i]
            if alike or (text and (prose or short)):
                kept.add(i)
        return kept

    def text(self) -> str:
        tree, roots = self.tree, self.roots()

        def leave_out(i: int) -> bool:
            link_list = tree.tags[i] in LISTS and self.size[i] and self.density(i) > 0.5
            return i not in roots and (link_list or self.dropped[i])

        kept = tree.inside(lambda i: i in roots)
        gone = tree.inside(leave_out)
        return " ".join(text.strip() for element, text in tree.texts if kept[element] and not gone[element])


def article(page: str) -> str:
    """Main text of a page.

    Every block element with at least 25 characters of own text is a
    paragraph worth 1 + its commas + 1 for each 100 characters (3 at most),
    less its share of link text.  Its parent gets the worth, the block around
    that half of it.  A block's score is weighted by its tag and its class
    and id names and reduced by its share of link text; the best block is
    the article, together with its siblings of over 80 characters that score a
    fifth as much, and paragraphs beside it that hold long text with few
    links or a short sentence without links.  All text
    inside stays, however short, but for navigation, forms, furniture and
    lists of links."""
    return Article(Tree(page)).text()


def article_and_metadata(page: str) -> tuple[str, dict[str, str]]:
    """``article`` and ``metadata`` of one tree."""
    tree = Tree(page)
    return Article(tree).text(), tree_metadata(tree)
