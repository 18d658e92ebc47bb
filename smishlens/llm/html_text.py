"""Main text of web pages by tree scoring.

A page becomes a list of nodes in page order, each with its parent. Boilerplate
elements (by tag, role, or a word of their class or id) are marked dead with all they
hold: reader comments, newsletters, cookie notices and adverts whatever else they are called, and
whatever elements they hold; menus, sidebars and the like unless they are what holds
the page's only article. Runs of inline content are blocks. A block of some length is a paragraph and
passes points (one, one per comma, one per hundred characters up to three) to its
ancestors, each level getting a smaller part. An element's total is its points
and a bonus for what it is called, discounted by the share of its text inside
links. The best element, widened to the article around it (the nearest article element, else
main element, else element called an article), is the container, and all that lives in it
is kept. Siblings that score well, or read like prose, are kept with it, and so are headings and,
inside an element of their own, sections, lists, tables and short paragraphs. The text is the blocks of the kept elements in page order.

Defined cases: a null or empty page, or one without text, gives an empty string; a
page in which nothing scores gives its article or main element, else its body; unclosed
and stray tags are mended as browsers do for paragraphs, list items and cells, and a tag
with an open quote ends at the next ``>``; repeated rows and further columns make no difference. Nothing is cut.
"""

from __future__ import annotations

import html as html_lib
import re
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from smishlens.llm.arrow_text import as_array

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"<]*"|'[^'<]*'|[^<>"'])*)>|<[/a-zA-Z][^>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORD = re.compile(r"[a-z0-9]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not markup; title and the like are no article text either.
_RAW = frozenset("script style textarea title noscript iframe template svg math noframes object".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr br img".split())
_DEAD_TAGS = frozenset("nav footer aside form button select input option menu dialog head".split()) | _RAW
_DEAD_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu menubar alertdialog".split())
#: What is called so is never the article.
_FOREIGN_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments consent cookie cookies disqus newsletter notice notices "
    "popup promo promoted promotion replies reply respond signup sponsor sponsored subscribe".split())
_DEAD_WORDS = frozenset(
    "banner breadcrumb breadcrumbs footer header hidden login masthead menu modal nav navbar navigation pager "
    "pagination recommended related share sharing sidebar skip social toolbar widget".split())
#: A name with one of these tells what an element has or is filed under, not what it is ("with-comments", "tag-ads").
_ABOUT_WORDS = frozenset("with has no not without show hide allow enable disable open closed free category tag type status format".split())
_GOOD_WORDS = frozenset("article body content entry main page post story text".split())
#: An element so called is an article when there is no article or main element around.
_ARTICLE_WORDS = frozenset("article entry post story".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
_FLOW = frozenset("p section ul ol dl table pre blockquote figure".split())
_PARAGRAPHS = frozenset("p li td th pre blockquote dd dt h1 h2 h3 h4 h5 h6 figcaption caption summary".split())
#: An element that opens ends an open element of these.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
         "tr": {"tr", "td", "th"}, "option": {"option"}}
_SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"table", "tr"}, "th": {"table", "tr"},
           "tr": {"table"}, "option": {"select"}}

#: Fewest characters of a paragraph, and points per element name.
MIN_PARAGRAPH = 25
_BONUS = {"article": 25.0, "main": 25.0, "section": 5.0, "div": 5.0, "blockquote": 3.0, "pre": 3.0,
          "ul": -3.0, "ol": -3.0, "dl": -3.0, "th": -5.0}
LEVELS = 5
_COMMA = re.compile("[,،、，]")


class _Page:
    """Nodes in page order: name, parent, words of class and id, text of text nodes."""

    def __init__(self, page: str):
        self.name, self.parent, self.text = ["#root"], [-1], [""]
        self.words: list[frozenset] = [frozenset()]
        self.dead = [False]
        self.foreign, self.fixed = [False], [False]  # by its names; by a name of several words
        self._open = [0]
        self._places: dict[str, list[int]] = {}  # of open elements in the stack, by name
        at = 0
        for m in _TAG.finditer(page):
            if m.start() < at:
                continue
            if m.start() > at:
                self._add_text(page[at:m.start()])
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if m[1]:
                self._close(name)
            else:
                self._add(name, m[3])
                if name in _RAW:
                    end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                    at = end.end() if end else len(page)
                    self._cut(len(self._open) - 1)
        if at < len(page):
            self._add_text(page[at:])

    def _add_text(self, text: str) -> None:
        self.name.append("#text")
        self.parent.append(self._open[-1])
        self.text.append(html_lib.unescape(text))
        self.words.append(frozenset())
        self.dead.append(False)
        self.foreign.append(False)
        self.fixed.append(False)

    def _add(self, name: str, attributes: str) -> None:
        if name not in _INLINE:
            self._end_open({"p"}, {"button", "td", "th", "table", "article", "section", "div", "aside", "body"})
        if name in _ENDS:
            self._end_open(_ENDS[name], _SCOPES[name])
        words, role, hidden, foreign, fixed = frozenset(), "", False, False, False
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if key in ("class", "id"):
                    for token in value.split():
                        own = frozenset(_WORD.findall(token))
                        words |= own
                        foreign |= bool(own & _FOREIGN_WORDS) and not own & _ABOUT_WORDS
                        # "main-nav" is a menu, but an article's header is part of it
                        fixed |= bool(own & _DEAD_WORDS - {"header"} and own & _GOOD_WORDS) and not own & _ABOUT_WORDS
                elif key == "role":
                    role = value
                elif key == "style":
                    hidden |= "display:none" in value.replace(" ", "")
                elif key == "aria-hidden":
                    hidden |= value == "true"
            hidden |= re.search(r"(?:^|\s)hidden(?:\s|=|$)", _ATTRIBUTE.sub(" ", attributes)) is not None
        self.name.append(name)
        self.parent.append(self._open[-1])
        self.text.append("")
        self.words.append(words)
        self.dead.append(name in _DEAD_TAGS or role in _DEAD_ROLES or hidden)
        self.foreign.append(foreign and name not in ("body", "html"))
        self.fixed.append(fixed)
        if name not in _VOID:
            self._push(name)

    def _push(self, name: str) -> None:
        self._places.setdefault(name, []).append(len(self._open))
        self._open.append(len(self.name) - 1)

    def _cut(self, depth: int) -> None:
        """Ends all open elements from a place of the stack on."""
        for node in reversed(self._open[depth:]):
            self._places[self.name[node]].pop()
        del self._open[depth:]

    def _last(self, names: set) -> int:
        """The last place of the stack with one of the names, 0 where there is none."""
        return max((self._places[name][-1] for name in names if self._places.get(name)), default=0)

    def _end_open(self, names: set, stop: set) -> None:
        depth = self._last(names)
        if depth > self._last(stop):
            self._cut(depth)

    def _close(self, name: str) -> None:
        if name == "br":
            self._add("br", "")
        elif depth := self._last({name}):
            self._cut(depth)


def extract(page: str) -> str:
    """The main text of one page; blocks are joined by an empty line."""
    if not page:
        return ""
    tree = _Page(page)
    name, parent, words, dead = tree.name, tree.parent, tree.words, tree.dead
    n = len(name)
    end = list(range(1, n + 1))
    for i in range(n - 1, 0, -1):
        end[parent[i]] = max(end[parent[i]], end[i])
    # a page has one main element, so what holds it is the page
    has_main = [x == "main" for x in name]
    for i in range(n - 1, 0, -1):
        has_main[parent[i]] = has_main[parent[i]] or has_main[i]
    gone = list(dead)  # by tag, role or a foreign name
    called = [False] * n  # by a dead word, its own or from above
    for i in range(1, n):
        up = parent[i]
        gone[i] = gone[up] or gone[i] or tree.foreign[i] and not has_main[i]
        own = words[i] & _DEAD_WORDS and (tree.fixed[i] or not words[i] & _GOOD_WORDS) and name[i] not in ("body", "html")
        called[i] = bool(called[up] or own and not has_main[i])
    # elements with a dead word that hold an article live only where no article stands outside of such
    articles = [i for i in range(1, n) if name[i] in ("article", "main") and not gone[i]]
    spare = all(called[i] for i in articles)
    holds = [False] * n
    for i in articles:
        holds[i] = spare
    for i in range(n - 1, 0, -1):
        holds[parent[i]] = holds[parent[i]] or holds[i]
    in_article, in_link = [False] * n, [False] * n
    owner = [0] * n  # nearest element that is no inline element
    for i in range(1, n):
        up = parent[i]
        in_article[i] = in_article[up] or name[i] in ("article", "main")
        in_link[i] = in_link[up] or name[i] == "a"
        owner[i] = i if name[i] not in _INLINE and name[i] != "#text" else owner[up]
        keeps = holds[i] or has_main[i]
        bad = words[i] & _DEAD_WORDS and (tree.fixed[i] or not words[i] & _GOOD_WORDS) and not keeps and name[i] not in ("body", "html")
        page_header = name[i] == "header" and not in_article[up] and not keeps
        dead[i] = bool(dead[up] or gone[i] or bad or page_header)

    # blocks: runs of text under one owner that no other block element interrupts
    blocks: list[tuple[int, str, int]] = []  # owner, text, characters inside links
    run: list[tuple[str, bool]] = []
    of = -1

    def flush() -> None:
        text = " ".join("".join(t for t, _ in run).split())
        if text:
            blocks.append((of, text, sum(len("".join(t.split())) for t, linked in run if linked)))
        run.clear()

    for i in range(1, n):
        if name[i] in _INLINE:
            if name[i] == "br" and not dead[i]:
                run.append((" ", False))
            continue
        if owner[i] != of or name[i] != "#text":
            flush()
            of = owner[i]
        if name[i] == "#text" and not dead[i]:
            run.append((tree.text[i], in_link[i]))
    flush()

    points, chars, linked = [0.0] * n, [0] * n, [0] * n
    for at, text, link in blocks:
        chars[at] += len(text)
        linked[at] += link
        if len(text) < MIN_PARAGRAPH:
            continue
        gain = 1 + len(_COMMA.findall(text)) + min(len(text) // 100, 3)
        gain *= 1 - min(1.0, link / len(text))
        to = parent[at] if name[at] in _PARAGRAPHS else at
        for level in range(LEVELS):
            if to <= 0:
                break
            points[to] += gain / (level + 1)
            to = parent[to]
    for i in range(n - 1, 0, -1):
        chars[parent[i]] += chars[i]
        linked[parent[i]] += linked[i]

    def total(i: int) -> float:
        if points[i] <= 0:
            return 0.0
        bonus = _BONUS.get(name[i], 0.0) + (25.0 if words[i] & _GOOD_WORDS else 0.0)
        return (points[i] + bonus) * (1 - min(1.0, linked[i] / max(chars[i], 1)))

    best, most = 0, 0.0
    for i in range(1, n):
        if not dead[i] and total(i) > most:
            best, most = i, total(i)
    if best == 0:
        named = [i for i in range(1, n) if name[i] in ("article", "main") and not dead[i]]
        kept = [(named[0], end[named[0]])] if named else [(0, n)]
    else:
        around = [best]
        while parent[around[-1]] > 0:
            around.append(parent[around[-1]])
        around = [i for i in around if name[i] not in ("body", "html")]
        for fits in (lambda i: name[i] == "article", lambda i: name[i] == "main", lambda i: words[i] & _ARTICLE_WORDS):
            wider = next((i for i in around if fits(i)), 0)
            if wider:
                best = wider
                break
        kept, up = [(best, end[best])], parent[best]
        own = up > 0 and name[up] not in ("body", "html") and not wider
        for i in range(1, n):
            if parent[i] == up and i != best and not dead[i] and name[i] not in _INLINE and name[i] != "#text":
                density = linked[i] / max(chars[i], 1)
                prose = name[i] == "p" and density < 0.25 and chars[i] > 80
                flow = not wider and name[i] in _HEADINGS or own and name[i] in _FLOW
                if prose or flow and density < 0.25 or total(i) >= max(10.0, 0.2 * most):
                    kept.append((i, end[i]))
    # a list that is nearly all links is a menu
    menus = [(i, end[i]) for i in range(1, n)
             if name[i] in ("ul", "ol") and chars[i] and linked[i] > 0.8 * chars[i]]
    within, menu = _covered(kept, n), _covered(menus, n)
    return "\n\n".join(text for at, text, _ in blocks if within[at] and not menu[at])


def _covered(ranges: list[tuple[int, int]], n: int) -> list[bool]:
    """Which of ``n`` nodes lie in one of the ranges."""
    edge = [0] * (n + 1)
    for a, b in ranges:
        edge[a] += 1
        edge[b] -= 1
    return [x > 0 for x in accumulate(edge[:n])]


def main_text(page: Column) -> Column:
    """The main text of a column of pages; an empty string where there is none."""
    def apply(column: pa.Array) -> pa.Array:
        return pa.array([extract(x.as_py()) for x in as_array(column)], pa.string())

    apply.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "string").asNondeterministic()(page)
