"""Main text of web pages by composite text density.

A page becomes a tree.  For every node the composite density relates its
characters to its tags, less what stands in links (characters and tags inside
``a``), on the scale of the whole body.  The density sum of a node is the sum
of its children's densities; the node with the largest sum is the centre of
the article.  Along the path from the body to the centre the smallest density
is the threshold: of the centre's neighbours on that path those that reach it
and have the path node's own tag belong to the article as well.  The enclosing
``article`` or ``main`` element, if there is one, bounds it.  Elements that
never hold article text (scripts, styles, menus, forms ...) or name themselves
as such by tag, role, class or id are no part of the tree's text.  Inside the
article a class or id is not enough: what it names goes only if most of its
text is links, it is very short, or it has few characters per tag beside the
article.  Ids of headings name nothing, and what only an id names of which the
name is a part (a slug such as ``social-life``) goes only if it is links.

Text keeps page order; character references are decoded; white space becomes
one blank, and blocks are joined by one blank.

Defined cases: null, empty and text-free html give an empty text; broken
markup (unclosed or stray tags, a ``<`` without an end) is read as browsers
do in the common cases; repeated rows are read alike; extra
columns stay, but those with the name of a result column are replaced.
"""

from __future__ import annotations

import html as _html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railyard.llm.staging import reach

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*+>|</([a-zA-Z][^\s/>]*+)[^>]*+>"
    r"""|<([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^'">])*+)>"""
    r"|<([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)  # a tag whose quotes do not close ends at the next >
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:@][-\w:.]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_PART = re.compile(r"[a-z0-9]+")

_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
           "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong",
           "sub", "sup", "time", "tt", "u", "var", "wbr"}
_DROP = {"script", "style", "noscript", "template", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "head",
         "nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "svg", "canvas", "object", "embed",
         "audio", "video", "map", "datalist", "fieldset"}
_DROP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog",
               "alertdialog", "menu", "menubar", "toolbar"}
_DROP_NAMES = {"ad", "ads", "alert", "announcement", "commentlist", "adbox", "advert", "adverts", "advertisement", "advertisements", "advertising", "banner",
               "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer",
               "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
               "notification", "pager", "pagination", "popup", "promo", "promotion", "related", "replies", "reply",
               "responses", "share", "sharing", "sidebar", "sidenav", "signup", "social", "sponsor", "sponsored",
               "sponsors", "subscribe", "toolbar", "topbar", "widget"}
_BOUND = ("article", "main")
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Characters below which a named element inside the article is very short.
_SHORT = 100
#: Its characters per tag, as a part of the article's, below which it is thin.
_THIN = 0.2
#: Elements that some pages put around everything.
_WRAPS = ("form", "fieldset")
#: An open element that a start tag ends, and what stops the search for it.
_ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"})}


def _names_itself(tag: str, attributes: str) -> tuple[bool, bool, bool]:
    """Whether role or style, a class or id, and more than a part of an id's slug say what never holds article text."""
    sure = named = whole = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if name in ("class", "id"):
            if name == "id" and tag in _HEADINGS:
                continue
            parts = _PART.findall(value)
            if not _DROP_NAMES.isdisjoint(parts):
                named = True
                whole = whole or name == "class" or _DROP_NAMES.issuperset(parts)
        elif name == "role":
            sure = sure or value in _DROP_ROLES
        elif name == "hidden" or name == "aria-hidden" and value == "true" \
                or name == "style" and "display:none" in value.replace(" ", ""):
            sure = True
    return sure, named, whole


class _Open:
    """The open elements, the innermost last, and where the elements of each
    name and the blocks among them stand, so no tag needs a walk over them."""

    def __init__(self):
        self.nodes, self.names, self.blocks = [0], ["#"], [0]
        self.where: dict[str, list[int]] = {}

    def push(self, node: int, name: str) -> None:
        if name not in _INLINE:
            self.blocks.append(len(self.nodes))
        self.where.setdefault(name, []).append(len(self.nodes))
        self.nodes.append(node)
        self.names.append(name)

    def last(self, name: str) -> int:
        """Place of the innermost open element of a name, 0 if there is none."""
        held = self.where.get(name)
        return held[-1] if held else 0

    def cut(self, place: int) -> None:
        """Close the element at ``place`` and all inside it."""
        while len(self.nodes) > place:
            name = self.names.pop()
            self.nodes.pop()
            self.where[name].pop()
            if name not in _INLINE:
                self.blocks.pop()


class Page:
    """Tree of a page: node 0 is the document; parents come before children."""

    def __init__(self, source: str):
        self.tag, self.parent, self.marked = ["#"], [-1], [False]
        self.named: dict[int, bool] = {}  # nodes marked by class or id alone: whether by more than a part of a slug
        self.texts: list[tuple[int, str]] = []  # (node, text), a blank where blocks meet
        self.body = 0
        self._read(source)

    def _read(self, source: str) -> None:
        tag, parent, marked, texts = self.tag, self.parent, self.marked, self.texts
        stack, at, end = _Open(), 0, len(source)
        nodes, no_more = stack.nodes, source.rfind(">")
        while at < end:
            # behind the last > there are no tags, and a comment that opens there never closes
            m = _TOKEN.search(source, at) if at <= no_more else None
            if m is None:
                rest = source[at:]
                texts.append((nodes[-1], rest[:rest.index("<!--")] if "<!--" in rest else rest))
                break
            if m.start() > at:
                texts.append((nodes[-1], source[at:m.start()]))
            at = m.end()
            if m[2] or m[4]:
                name, attributes = (m[2] or m[4]).lower(), m[3] if m[2] else m[5]
                if name not in _INLINE:
                    texts.append((nodes[-1], " "))
                    if name not in _VOID:
                        self._close_paragraph(stack)
                    if name in _ENDS:
                        self._close(stack, *_ENDS[name])
                tag.append(name)
                parent.append(nodes[-1])
                sure, named, whole = _names_itself(name, attributes) if attributes else (False, False, False)
                sure = sure or name in _DROP or name == "header" and not any(stack.last(b) for b in _BOUND)
                marked.append(sure or named)
                node = len(tag) - 1
                if named and not sure:
                    self.named[node] = whole
                if name == "body" and self.body == 0:
                    self.body = node
                if name in _RAW:
                    stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
                    if stop is None:
                        break
                    at = stop.start()
                    stack.push(node, name)
                elif name not in _VOID and not attributes.endswith("/"):
                    stack.push(node, name)
            elif m[1]:
                name = m[1].lower()
                if name not in _INLINE:
                    texts.append((nodes[-1], " "))
                place = stack.last(name)
                # an inline end tag does not close a block
                if place and (name not in _INLINE or place > stack.blocks[-1]):
                    stack.cut(place)

    def _close_paragraph(self, stack: _Open) -> None:
        """A block ends the paragraph that is the innermost open block."""
        if stack.names[stack.blocks[-1]] == "p":
            stack.cut(stack.blocks[-1])

    def _close(self, stack: _Open, names: set[str], stops: set[str]) -> None:
        place = max(map(stack.last, names))
        if place > max(map(stack.last, stops)):
            stack.cut(place)

    def main_text(self) -> str:
        text = self._main_text()
        if not text and not all(t not in _WRAPS for t in self.tag):
            self.marked = [m and t not in _WRAPS for m, t in zip(self.marked, self.tag)]
            text = self._main_text()
        return text

    def _main_text(self) -> str:
        tag, parent, n = self.tag, self.parent, len(self.tag)
        # names are no reason to drop what holds the article or its heading
        holds = [False] * n
        for k in range(1, n):
            if tag[k] in ("article", "main", "h1", "body"):
                up = k if tag[k] != "h1" else parent[k]
                while up > 0 and not holds[up]:
                    holds[up] = True
                    if tag[up] not in _DROP or tag[up] in _WRAPS:
                        self.marked[up] = False
                    up = parent[up]
        out = self.marked[:]
        link = [t == "a" for t in tag]
        for k in range(1, n):
            out[k] = out[k] or out[parent[k]]
            link[k] = link[k] or link[parent[k]]
        top = self.body
        density, chars, _, _ = self._measure(out, link, top)
        total = [0.0] * n
        for k in range(1, n):
            total[parent[k]] += density[k]
        inside = [k == top for k in range(n)]
        for k in range(1, n):
            inside[k] = inside[k] or inside[parent[k]] and k != top
        centre = top
        for k in range(n):
            if inside[k] and total[k] > total[centre]:
                centre = k
        roots = self._article(centre, top, density, chars, out)
        if self.named and top not in roots and 0 not in roots:
            self._restore(out, link, top, roots)
        took = [False] * n
        for k in range(n):
            took[k] = (k in roots or k > 0 and took[parent[k]]) and not out[k]
        # block marks count wherever they stand, so blocks of different nodes never run together
        text = "".join([t for k, t in self.texts if took[k] or t == " "])
        if "&" in text:
            text = _html.unescape(text)
        return " ".join(text.split())

    def _measure(self, out: list, link: list, top: int) -> tuple[list, list, list, list]:
        """Densities, characters, characters in links and tags of what is not ``out``."""
        tag, parent, n = self.tag, self.parent, len(self.tag)
        chars, linked, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for k, t in self.texts:
            if t != " " and not out[k]:
                size = len(t) - t.count(" ")
                chars[k] += size
                if link[k]:
                    linked[k] += size
        for k in range(n - 1, 0, -1):
            if not out[k]:
                p = parent[k]
                chars[p] += chars[k]
                linked[p] += linked[k]
                tags[p] += tags[k] + 1
                link_tags[p] += link_tags[k] + (tag[k] == "a")
        ratio = linked[top] / max(chars[top], 1)
        density = [0.0] * n
        for k in range(n):
            if chars[k] and not out[k]:
                c, t, lc, lt = chars[k], max(tags[k], 1), max(linked[k], 1), max(link_tags[k], 1)
                base = math.log(math.log(c / max(c - linked[k], 1) * lc + ratio * c + math.e))
                density[k] = c / t * max(math.log(c / lc * t / lt) / max(base, 0.1), 0.0)
        return density, chars, linked, tags

    def _restore(self, out: list, link: list, top: int, roots: set[int]) -> None:
        """Take back what only a class or id dropped from the article, unless it is thin, links or very short."""
        parent, n = self.parent, len(self.tag)
        sure = [m and k not in self.named for k, m in enumerate(self.marked)]
        inside = [False] * n
        for k in range(1, n):
            sure[k] = sure[k] or sure[parent[k]]
            inside[k] = k in roots or inside[parent[k]]
        if not any(inside[k] and self.marked[k] and not sure[k] for k in self.named):
            return
        _, chars, linked, tags = self._measure(sure, link, top)
        per_tag = [(c - x) / max(t, 1) for c, x, t in zip(chars, linked, tags)]
        thin = _THIN * max(per_tag[k] for k in roots)
        for k in range(1, n):
            if inside[k] and k not in roots:
                own = self.marked[k]
                if own and not sure[k]:
                    own = 2 * linked[k] > chars[k] or self.named[k] and (chars[k] < _SHORT or per_tag[k] < thin)
                out[k] = out[parent[k]] or own

    def _article(self, centre: int, top: int, density: list, chars: list, out: list) -> set[int]:
        tag, parent = self.tag, self.parent
        path = [centre]
        while path[-1] != top and path[-1] > 0:
            path.append(parent[path[-1]])
        bound = [k for k in path if tag[k] in _BOUND]
        if bound:
            return {bound[-1] if tag[bound[-1]] == "article" else bound[0]}
        held = [k for k in range(len(tag)) if tag[k] == "article" and not out[k] and 2 * chars[k] > chars[centre]]
        if len(held) == 1:
            return {held[0]}
        least = min(density[k] for k in path)
        below = {up: tag[step] for step, up in zip(path, path[1:])}  # the tag that the path takes from each node on
        same = {k for k in range(1, len(tag)) if below.get(parent[k]) == tag[k] and not out[k] and density[k] >= least > 0}
        return {centre} | same


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with the html replaced by ``text`` and ``n_chars``."""
    reach(pages.sparkSession)
    rest = [c for c in pages.columns if c != html_col and c.lower() not in ("text", "n_chars")]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*rest).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             [*b.schema.names[:-1], "text", "n_chars"])

    return pages.select(*rest, F.col(html_col)).mapInArrow(
        run, ", ".join(filter(None, [kept, "text string, n_chars bigint"])))
