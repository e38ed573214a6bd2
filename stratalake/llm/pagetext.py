"""Main text of web pages by composite text density of DOM nodes."""

import re
from dataclasses import dataclass, field
from html import unescape
from math import e, log

from pyspark.sql import DataFrame

from stratalake.llm.common import map_texts

# ---- markup -------------------------------------------------------------------------------

_ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?+)?+"""
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)>")
#: What a tag is when no quote of it ends: up to the next ``>``.
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_NAMED = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?![^\s=])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", re.I)

#: Elements whose content is no markup: it ends at their own end tag only and holds no text of the page.
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript".split())
#: Elements in the middle of a text whose content is no text of it.
SILENT = frozenset("svg canvas video audio object button select datalist template".split())
#: Elements that start and end a block of text.
BLOCKS = frozenset(
    "html head body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_CELLS = frozenset("td th caption".split())
_GROUPS = frozenset("tbody thead tfoot".split())
#: What an end tag inside doesn't reach through.
_SCOPES = _CELLS | {"table"}
#: What the start of a list item doesn't reach through when it ends the item before.
_LIST_SCOPES = _SCOPES | frozenset("ul ol dl menu article section main aside nav blockquote figure details form".split())
_ITEMS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I) for name in RAW}

# ---- what is no article -------------------------------------------------------------------

#: Elements that never hold text of the article.
FURNITURE = frozenset("head nav header footer aside form fieldset legend dialog menu search".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist "
    "status log".split()
)
#: Words of a class or id that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
HINTS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising advertorial sponsor sponsored sponsors promo "
    "promotion promoted banner banners nav navbar navigation menu menus submenu breadcrumb breadcrumbs topbar "
    "header masthead footer foot colophon sidebar sidebars aside rail widget widgets cookie cookies consent gdpr "
    "notice notices notification notifications disclaimer popup modal overlay lightbox newsletter subscribe "
    "subscription signup paywall login signin register share sharing social related recommended recommendations "
    "trending comment comments commentlist disqus respond replies reply pager pagination paging toolbar "
    "search skip copyright legal tags".split()
)
#: The words among them that mark an ``article`` element too: comments are often articles in an article.
COMMENTS = frozenset("comment comments reply replies ad ads advert sponsored promo related teaser".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_NEGATED = re.compile(r"\b(?:has|with|no|without|not)[-_]\w+(?:[-_]\w+)*", re.I)
_HIDDEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)


@dataclass
class Dom:
    """Nodes in document order, so that a parent comes before its children; node 0 is the document.

    Only blocks are nodes that hold text: an inline element is part of its block.
    """

    tag: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [-1])
    attributes: list[str] = field(default_factory=lambda: [""])
    #: (node, text, characters of it in links) of each run of text between block borders, in page order
    runs: list[tuple[int, str, int]] = field(default_factory=list)
    #: link elements of each node
    links: list[int] = field(default_factory=lambda: [0])

    def add(self, tag: str, parent: int, attributes: str) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.attributes.append(attributes)
        self.links.append(0)
        return len(self.tag) - 1


class _Open:
    """The stack of open blocks, with counts by name so that a stray end tag costs nothing."""

    def __init__(self, dom: Dom) -> None:
        self.dom = dom
        self.nodes, self.names = [0], [""]
        self._counts: list[dict[str, int]] = [{}]  # by name, since each scope began
        self._items: list[dict[str, int]] = [{}]  # of list items, since each list began
        self._scopes: dict[str, int] = dict.fromkeys(_SCOPES, 0)

    def push(self, name: str, attributes: str) -> None:
        self.nodes.append(self.dom.add(name, self.nodes[-1], attributes))
        self.names.append(name)
        self._counts[-1][name] = self._counts[-1].get(name, 0) + 1
        if name in _ITEMS:
            self._items[-1][name] = self._items[-1].get(name, 0) + 1
        if name in _SCOPES:
            self._scopes[name] += 1
            self._counts.append({})
        if name in _LIST_SCOPES:
            self._items.append({})

    def pop(self) -> None:
        self.nodes.pop()
        name = self.names.pop()
        if name in _LIST_SCOPES:
            self._items.pop()
        if name in _SCOPES:
            self._scopes[name] -= 1
            self._counts.pop()
        if name in _ITEMS:
            self._items[-1][name] -= 1
        self._counts[-1][name] -= 1

    def has(self, name: str) -> bool:
        return bool(self._scopes[name] if name in _SCOPES else self._counts[-1].get(name))

    def close(self, name: str) -> bool:
        """End the innermost open block of that name within the scope; whether there is one."""
        if not self.has(name):
            return False
        while self.names[-1] != name:
            self.pop()
        self.pop()
        return True

    def imply_ends(self, name: str) -> None:
        """End what the start of a block ends without an end tag."""
        if self.names[-1] == "head":
            self.pop()
        if name in _CELLS or name in _GROUPS or name == "tr":
            if len(self._counts) > 1:  # in a table: its open cell, then its row and group
                while self.names[-1] != "table" and not (self.names[-1] in _CELLS):
                    if self.names[-1] in _GROUPS or self.names[-1] == "tr":
                        break
                    self.pop()
                if self.names[-1] in _CELLS:
                    self.pop()
                if name not in _CELLS:
                    self.close("tr")
                    if name in _GROUPS:
                        for group in _GROUPS:
                            self.close(group)
            return
        self.close("p")
        for item in _ITEMS.get(name, ()):
            if self._items[-1].get(item):
                self.close(item)
        if name in HEADINGS and self.names[-1] in HEADINGS:
            self.pop()


def parse(html: str) -> Dom:
    """The block tree of a page, in time proportional to its length.

    Follows the rules browsers use for what authors leave out: implied ends of paragraphs,
    list items and cells, missing and stray end tags, unquoted attributes, text after
    the end of ``body``. What is cut off inside a tag or a comment holds no text.
    """
    dom = Dom()
    open_ = _Open(dom)
    silent: list[tuple[str, int]] = []  # open elements without text, and how deep
    link_depth = 0  # how deep the open link is; 0: none
    pieces: list[str] = []  # of the current run
    linked = 0
    at, end, loose = 0, len(html), False

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                if open_.names[-1] == "head":  # text begins the body
                    open_.pop()
                dom.runs.append((open_.nodes[-1], text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if not silent:
            text = unescape(text) if "&" in text else text
            pieces.append(text)
            if link_depth:
                linked += len(text)

    while at < end:
        start = html.find("<", at)
        if start < 0:
            say(html[at:])
            break
        if start > at:
            say(html[at:start])
        ends = html.startswith("/", start + 1)
        first = html[start + 1 + ends : start + 2 + ends]
        if not (first.isascii() and first.isalpha()):
            if html.startswith("<!--", start):
                stop = html.find("-->", start + 2)
                at = end if stop < 0 else stop + 3
            elif ends or first in ("!", "?"):
                stop = html.find(">", start)
                at = end if stop < 0 else stop + 1
            else:
                say("<")
                at = start + 1
            continue
        found = None if loose else _TAG.match(html, start)
        if found is None:
            loose = True  # a quote that never ends: from here on, tags end at the next ">"
            found = _LOOSE.match(html, start)
            if found is None:
                break
        at = found.end()
        name, attributes = found[2].lower(), found[3]
        if name == "br":
            say(" ")
        elif ends:
            if silent and name == silent[-1][0]:
                silent.pop()
            elif name == "a":
                link_depth = 0
            elif name in BLOCKS and name not in ("html", "body"):
                closing = next((h for h in HEADINGS if open_.has(h)), name) if name in HEADINGS else name
                if open_.has(closing) or name == "p":
                    flush()
                    open_.close(closing)
                    while silent and silent[-1][1] > len(open_.names):
                        silent.pop()
                    if link_depth > len(open_.names):
                        link_depth = 0
        elif name in RAW:
            stop = _RAW_ENDS[name].search(html, at)
            at = end if stop is None else stop.end()
        elif name == "a":
            link_depth = len(open_.names)
            dom.links[open_.nodes[-1]] += 1
        elif name == "hr":
            flush()
        elif name in SILENT:
            silent.append((name, len(open_.names)))
        elif name in BLOCKS and not (name in ("html", "head", "body") and name in dom.tag[:8]):
            flush()
            open_.imply_ends(name)
            while silent and silent[-1][1] > len(open_.names):
                silent.pop()
            open_.push(name, attributes)
    flush()
    return dom


# ---- pruning and density ------------------------------------------------------------------


def _marks(tag: str, attributes: str) -> tuple[bool, set[str]]:
    """(is furniture by its element, role or state; the words of its class and id that hint at it)."""
    sure, words = tag in FURNITURE, set()
    for m in _NAMED.finditer(attributes) if attributes else ():
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "role":
            sure = sure or value.lower() in ROLES
        elif key == "hidden":
            sure = True
        elif key == "aria-hidden":
            sure = sure or value.lower() == "true"
        elif key == "style":
            sure = sure or bool(_HIDDEN.search(value))
        else:
            words |= {w.lower() for w in _WORDS.findall(_NEGATED.sub(" ", unescape(value)))} & HINTS
    return sure, words


def _kinds(dom: Dom) -> list[str]:
    """``article``, ``main`` or nothing, by element or role."""
    kinds = []
    for tag, attributes in zip(dom.tag, dom.attributes, strict=True):
        kind = tag if tag in ("article", "main") else ""
        if not kind and "role" in attributes:
            role = next((m[2].strip("\"'").lower() for m in _NAMED.finditer(attributes) if m[1].lower() == "role" and m[2]), "")
            kind = role if role in ("article", "main") else ""
        kinds.append(kind)
    return kinds


def _pruned(dom: Dom) -> tuple[list[bool], list[int], list[str]]:
    """(kept nodes, the outermost article or else main that holds each node or -1, kinds)."""
    n = len(dom.tag)
    kinds = _kinds(dom)
    holds_article, holds_heading = [bool(k) for k in kinds], [t in HEADINGS for t in dom.tag]
    holds_title, chars = [t == "h1" for t in dom.tag], [0] * n
    for node, text, _ in dom.runs:
        chars[node] += len(text)
    for i in range(n - 1, 0, -1):
        up = dom.parent[i]
        holds_article[up] |= holds_article[i]
        holds_heading[up] |= holds_heading[i]
        holds_title[up] |= holds_title[i]
        chars[up] += chars[i]
    kept, inside = [True] * n, [-1] * n
    for i in range(1, n):
        up, tag, attributes = dom.parent[i], dom.tag[i], dom.attributes[i]
        kept[i], inside[i] = kept[up], inside[up]
        if not kept[i]:
            continue
        if tag not in ("html", "body", "main"):
            sure, words = _marks(tag, attributes)
            hinted = bool(words & COMMENTS if kinds[i] == "article" else words)
            if kinds[i] != "article" and (holds_article[i] or holds_title[i] and 2 * chars[i] > chars[0]):
                hinted = False  # wraps the article
                sure = sure and tag != "form"
            if inside[i] >= 0 and holds_heading[i] and (tag == "header" or tag in HEADINGS or words == {"header"}):
                sure = hinted = False  # the head of the article, not of the page
            kept[i] = not (sure or hinted)
        if kept[i] and kinds[i] and (inside[i] < 0 or kinds[inside[i]] == "main" and kinds[i] == "article"):
            inside[i] = i
    return kept, inside, kinds


def main_text(html: str | None) -> str:
    """The article of a page: its blocks of text in page order, a line each; empty if there is none.

    Furniture (menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments)
    goes first, by element, role, and words of class or id; what wraps the article stays, and
    so does the head of an article itself. Of the rest every node gets its composite text
    density: characters per tag, adjusted by the share of characters and tags that are links.
    The node whose children have the greatest sum is the core of the article, and the least density on
    its path to the body is the threshold: beside that path, headings and subtrees that
    reach it belong to the text too. Where the page names its article, the core is looked for in
    what it names and widened to it, so that no short block of it is dropped.
    """
    dom = parse(html or "")
    n = len(dom.tag)
    kept, inside, kinds = _pruned(dom)
    chars, linked, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for node, text, in_links in dom.runs:
        if kept[node]:
            chars[node] += len(text)
            linked[node] += in_links
    own, own_linked = list(chars), list(linked)
    for i in range(n - 1, 0, -1):
        if kept[i]:
            up = dom.parent[i]
            link_tags[i] += dom.links[i]
            chars[up] += chars[i]
            linked[up] += linked[i]
            tags[up] += tags[i] + 1
            link_tags[up] += link_tags[i]
    if not chars[0]:
        return ""
    share = linked[0] / chars[0]

    def density(c: int, t: int, lc: int, lt: int) -> float:
        if not c:
            return 0.0
        t, plain, lc, lt = max(t, 1), max(c - lc, 1), max(lc, 1), max(lt, 1)
        return c / t * max(log(c / lc * t / lt), 0.0) / log(c / plain * lc + share * c + e)

    score = [density(chars[i], tags[i], linked[i], link_tags[i]) if kept[i] else 0.0 for i in range(n)]
    beside = [density(own[i], 1, own_linked[i], min(dom.links[i], 1)) for i in range(n)]
    total = list(beside)  # text beside blocks counts as a child
    for i in range(n - 1, 0, -1):
        total[dom.parent[i]] += score[i]

    named = {i for i in range(1, n) if kept[i] and inside[i] == i and chars[i]}
    if any(kinds[i] == "article" for i in named):
        named = {i for i in named if kinds[i] == "article"}
    candidates = (i for i in range(n) if kept[i] and chars[i] and (not named or inside[i] in named))
    core = max(candidates, key=lambda i: (total[i], -i))
    alone = set()  # nodes of which only the text beside their blocks is taken
    if named:
        roots = {inside[core]}
    else:
        path = [core]
        while path[-1] > 0 and dom.tag[path[-1]] != "body":
            path.append(dom.parent[path[-1]])
        threshold = min(score[i] for i in path)
        above = set(path[1:])
        roots = {i for i in range(1, n) if dom.parent[i] in above and (dom.tag[i] in HEADINGS or score[i] >= threshold)}
        roots.add(core)
        roots -= above
        alone = {i for i in above if beside[i] >= threshold}
    taken = [False] * n
    for i in range(n):
        # a list of links and next to nothing else is a menu
        menu = dom.tag[i] in ("ul", "ol", "dl") and link_tags[i] >= 3 and linked[i] >= 0.9 * chars[i]
        taken[i] = kept[i] and not menu and (i in roots or (i > 0 and taken[dom.parent[i]]))
    return "\n".join(text for node, text, _ in dom.runs if taken[node] or (node in alone and kept[node]))


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page (page_id, url, html); further columns are left out.

    Null or empty html, or a page of furniture only, has the empty text; null ids and urls and
    repeated rows pass through; a page of any length is read whole, in linear time.
    """

    def run(columns: list, texts) -> dict:
        made = [main_text(t) for t in texts]
        return {"page_id": columns[0], "url": columns[1], "text": made, "n_chars": [len(t) for t in made]}

    ids = dict(pages.dtypes)
    return map_texts(pages, run, f"page_id {ids['page_id']}, url string, text string, n_chars bigint", ("page_id", "url", "html"))
