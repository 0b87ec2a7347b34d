r"""Main text of HTML pages by composite text density.

Every DOM node gets a composite text density: its characters per tag, adjusted
by how much of the node and of the whole page is link text. The density sum of a
node is the sum of its children's densities; the node with the largest sum holds
the article. The smallest density on the path from it to the body is the
threshold for its surroundings: siblings that reach it belong to the article too.
If the node stands in an ``article`` or ``main`` element, that element is the outer
limit: up to it, what surrounds any node of the path is tried, and headings stay.
Within the selection, lists below the threshold whose text is mostly links are left
out, and so are articles nested in one with at least as much text of its own.

Elements that are never article text (scripts, forms, menus, page headers and
footers, sidebars) are left out before densities are computed. So are elements whose
class, id or role says that they are notices, adverts, sidebars or reader comments,
however much of the page they hold. A hint never drops the article: what holds a main,
or the article with the most text of its own outside comments, stays, and where such an
element is missing and a hint may be about the layout ("menu-open"), the element with the
densest node stays. Ids of headings and of the article's sections are no hints.

Text is split into blocks at block-level tags; character references are decoded,
white space within a block becomes one space, and blocks are joined in page order
by two newlines.

Each page is one row of a map over the input: no shuffle, and memory is bounded
by the largest page.

Defined cases: a null or empty page, or one without text, gives an empty text;
unclosed tags end where HTML lets them end; unclosed comments and scripts run to the
end of the page; repeated rows give repeated results; an empty table gives an
empty result. Other input columns are left out, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probelens.llm.common import ship

ship(__name__)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("head script style noscript template iframe object svg canvas form button select option textarea input label fieldset nav header footer aside menu dialog audio video map".split())
BLOCKS = frozenset("address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup hr html li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Start tags that end an open paragraph.
ENDS_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "li", "dd", "dt"} | {"form", "header", "footer", "nav", "aside", "fieldset", "menu"}
#: Start tags that end an open element of the same set, up to its container.
ENDS_OWN = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Parts of a class, id or role that mark what is not the article.
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner breadcrumb breadcrumbs comment comments commentlist "
    "consent cookie cookies contentinfo disqus footer gdpr menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup privacy promo promoted promotion recommended related replies respond responses share sharing sidebar sidebars social "
    "sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_ABOUT_REPLIES = re.compile(r"^(?:user|reader)?[-_]?(?:comments?|commentlist|disqus|repl(?:y|ies)|respond|responses)$", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Elements that hold the article if they are there; a hint on them is no reason to drop it.
BOUNDS = ("article", "main")
#: Hints that are about reader comments.
REPLIES = frozenset("comment comments commentlist disqus replies respond responses".split())
#: Words that make a hint before them one about the layout.
STATES = frozenset("active closed disabled enabled fixed free off on open".split())
#: How strongly an element's names speak: a hint among other words, alone, one about comments; never article text.
AMONG, ALONE, REPLY, NOT_TEXT = 1, 2, 3, 4
#: Characters outside all hinted elements that make a page's text likely to be there.
LEAST = 80
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Elements within a run of text, unless they hold others.
INLINE = frozenset("a abbr b bdi bdo big br cite code del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are left out of the article where most of their text is in links.
LISTS = frozenset("dl div ol section table ul".split())


def _unwanted(tag: str, attrs: list[tuple[str, str | None]], inside: bool) -> int:
    """``NOT_TEXT`` for what is never article text, else the strongest hint; ``inside`` an article or main."""
    if tag in NEVER:
        return NOT_TEXT
    if tag in ("html", "body", *BOUNDS) or not attrs:
        return 0
    found = 0
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and _HIDDEN.search(value)):
            return NOT_TEXT
        if name in ("class", "id", "role") and value:
            # The id of a heading, or of a section of the article, is often made of its title.
            slug = name == "id" and (tag in HEADINGS or (tag == "section" and inside and not _ABOUT_REPLIES.search(value)))
            found = found if slug else max(found, *map(_hint, value.split()), 0)
    return found


def _hint(word: str) -> int:
    """How strongly one class name speaks: "comment-list" as reader comments, "sidebar" alone, "left-sidebar" among others, "no-sidebar" not at all."""
    parts = [p.lower() for p in _PARTS.findall(word)]
    found = 0
    for n, p in enumerate(parts):
        if p not in HINTS or (n and parts[n - 1] in ("no", "non", "has", "with", "without")):
            continue
        state = n + 1 < len(parts) and parts[n + 1] in STATES
        found = max(found, AMONG if state else REPLY if p in REPLIES else ALONE if word.lower() in HINTS else AMONG)
    return max(found, ALONE if word.lower() in HINTS - REPLIES else REPLY if word.lower() in REPLIES else 0)


class _Tree(HTMLParser):
    """Nodes in page order: parent, tag, and the pieces of text with the node they belong to."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.dropped, self.hinted = [-1], ["#page"], [False], [0]
        self.open = [0]
        self.text: list[tuple[int, str]] = []

    def _close_to(self, depth: int) -> None:
        del self.open[depth:]

    def _ends(self, own: set[str], limit: set[str]) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[depth]]
            if tag in own:
                return self._close_to(depth)
            if tag in limit:
                return None
        return None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_P:
            self._ends({"p"}, {"td", "th", "button", "object"})
        if tag in ENDS_OWN:
            self._ends(*ENDS_OWN[tag])
        up = self.open[-1]
        self.parent.append(up)
        self.tag.append(tag)
        unwanted = _unwanted(tag, attrs, any(self.tag[i] in BOUNDS for i in self.open) if attrs and tag == "section" else False)
        self.dropped.append(self.dropped[up] or unwanted == NOT_TEXT)
        self.hinted.append(unwanted % NOT_TEXT)
        if tag in VOID:
            self.text.append((len(self.tag) - 1, "\n"))
        else:
            self.open.append(len(self.tag) - 1)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            node = self.tag[self.open[depth]]
            if node == tag:
                return self._close_to(depth)
            if node in ("table", "body") and tag not in ("table", "body", "html"):
                return None
        return None

    def handle_data(self, data: str) -> None:
        self.text.append((self.open[-1], data))


def _held(tree: _Tree, chars: list[int]) -> tuple[set[int], list[bool]]:
    """What holds a main, or the article with the most text of its own (outside comments), and what lies in them."""
    n = len(tree.tag)
    total, inside, own, in_link, reply = list(chars), [-1] * n, [0] * n, [False] * n, [False] * n
    for i in range(1, n):
        up = tree.parent[i]
        inside[i] = up if tree.tag[up] == "article" else inside[up]
        in_link[i] = in_link[up] or tree.tag[i] == "a"
        reply[i] = reply[up] or tree.hinted[i] == REPLY
        if not in_link[i]:
            own[i if tree.tag[i] == "article" else inside[i]] += chars[i]
    for i in range(n - 1, 0, -1):
        total[tree.parent[i]] += total[i]
    articles = [i for i in range(1, n) if tree.tag[i] == "article" and own[i]]
    articles = [i for i in articles if not reply[i]] or articles
    held = {max(articles, key=lambda i: (own[i], -i))} if articles else set()
    held |= {i for i in range(1, n) if tree.tag[i] == "main" and total[i]}
    inner = [i in held for i in range(n)]
    for i in range(1, n):
        inner[i] = inner[i] or inner[tree.parent[i]]
    for i in list(held):
        while i > 0:
            held.add(i)
            i = tree.parent[i]
    return held, inner


def _heeded(tree: _Tree, chars: list[int]) -> None:
    """Drop what a hint speaks against, whatever its size; the article is never dropped.

    What holds a main or the article stays. Of the outermost other elements with a hint the one
    that holds the densest node stays, and those in it are tried in turn, where the hint may be
    about the layout: if it is one word among others and the page has no article or main, if it
    stands alone and next to nothing is outside, or if nothing at all is.
    """
    if not any(tree.hinted):
        return
    n = len(tree.tag)
    held, inner = _held(tree, chars)
    hint = [0 if i in held else tree.hinted[i] for i in range(n)]
    plain = [True] * n
    for i in range(1, n):
        plain[i] = plain[tree.parent[i]] and tree.tag[i] != "a" and tree.tag[i] not in HEADINGS
    while True:
        outer = [0] * n
        for i in range(1, n):
            outer[i] = outer[tree.parent[i]] or (i if hint[i] else 0)
        rest = sum(chars[i] for i in range(n) if plain[i] and not outer[i] and (inner[i] or not held))
        may_stay = {AMONG: not held or not rest, ALONE: not rest or (not held and rest < LEAST), REPLY: not rest}
        tried = [bool(outer[i]) and may_stay[hint[outer[i]]] for i in range(n)]
        if not any(tried):
            break
        trial = _Trial(tree, [False] * n)
        for i in range(1, n):
            below = hint[i] and outer[i] != i
            trial.dropped[i] = trial.dropped[tree.parent[i]] or tree.dropped[i] or below or (bool(outer[i]) and not tried[i])
        left = [0 if d else c for c, d in zip(chars, trial.dropped, strict=True)]
        best = _densest(trial, left, *_densities(trial, left))
        if not outer[best]:
            break
        hint[outer[best]] = 0
    for i in range(1, n):
        tree.dropped[i] = tree.dropped[i] or tree.dropped[tree.parent[i]] or bool(hint[i])
        chars[i] = 0 if tree.dropped[i] else chars[i]


class _Trial:
    """A tree with other elements dropped."""

    def __init__(self, tree: _Tree, dropped: list[bool]) -> None:
        self.tag, self.parent, self.dropped = tree.tag, tree.parent, dropped


def _nested(tree: _Tree, chars: list[int]) -> None:
    """Drop articles inside an article that has at least as much text of its own: comments, in HTML5's terms.

    What else holds them goes too, up to the article, if headings are its only other text.
    """
    n = len(tree.tag)
    inside, own, bare, linked, headed = [-1] * n, [0] * n, [0] * n, [False] * n, [False] * n
    for i in range(1, n):
        up = tree.parent[i]
        inside[i] = up if tree.tag[up] == "article" else inside[up]
        linked[i] = linked[up] or tree.tag[i] == "a"
        headed[i] = headed[up] or tree.tag[i] in HEADINGS
        if not linked[i] and not headed[i]:
            own[i if tree.tag[i] == "article" else inside[i]] += chars[i]
    most = list(own)
    for i in range(n - 1, 0, -1):
        if tree.tag[i] == "article" and inside[i] >= 0:
            most[inside[i]] = max(most[inside[i]], most[i])
    # Text besides headings and nested articles, for each node.
    for i in range(n - 1, 0, -1):
        bare[i] += 0 if headed[i] else chars[i]
        if tree.tag[i] != "article":
            bare[tree.parent[i]] += bare[i]
    for i in range(1, n):
        outer = inside[i]
        if tree.tag[i] == "article" and outer >= 0 and not tree.dropped[i] and own[outer] and own[outer] >= most[outer]:
            while tree.parent[i] != outer and not bare[tree.parent[i]]:
                i = tree.parent[i]
            tree.dropped[i] = True
    for i in range(1, n):
        tree.dropped[i] = tree.dropped[i] or tree.dropped[tree.parent[i]]
        chars[i] = 0 if tree.dropped[i] else chars[i]


def _densities(tree: _Tree, chars: list[int]) -> tuple[list[float], list[float], list[int], list[int], list[bool]]:
    """Composite text density and density sum of every node, its characters, those in links, and whether it is a phrase."""
    n = len(tree.tag)
    total, linked, tags, links = list(chars), [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[tree.parent[i]] or tree.tag[i] == "a"
        linked[i] = chars[i] if in_link[i] else 0
    for i in range(n - 1, 0, -1):
        if not tree.dropped[i]:
            up = tree.parent[i]
            total[up] += total[i]
            linked[up] += linked[i]
            tags[up] += tags[i] + 1
            links[up] += links[i] + (tree.tag[i] == "a")
    page_share = linked[0] / total[0] if total[0] else 0.0
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n):
        if tree.dropped[i] or not total[i]:
            continue
        c, t, lc, lt = total[i], max(1, tags[i]), max(1, linked[i]), max(1, links[i])
        base = math.log(c / max(1, c - linked[i]) * linked[i] + page_share * c + math.e)
        # A page without a link has base 1 and no logarithm to it: characters per tag alone.
        density[i] = c / t * (math.log(c * t / (lc * lt)) / math.log(base) if base > 1.0 + 1e-9 else 1.0)
    phrase = [tag in INLINE for tag in tree.tag]
    for i in range(n - 1, 0, -1):
        phrase[tree.parent[i]] = phrase[tree.parent[i]] and phrase[i]
    leaf = [True] * n
    for i in range(1, n):
        if not tree.dropped[i] and not phrase[i]:
            sums[tree.parent[i]] += density[i]
            leaf[tree.parent[i]] = False
    # A node of nothing but text and phrases stands for its own density: a page may be one bare
    # block, and marking up a paragraph's words makes it no container. A phrase never does.
    sums = [0.0 if p else d if alone else s for p, d, alone, s in zip(phrase, density, leaf, sums, strict=True)]
    return density, sums, total, linked, phrase


def _densest(tree, chars, density, sums, total, linked, phrase) -> int:
    """The node with the largest density sum; the first of equal ones, the page itself if there is none."""
    nodes = [i for i in range(1, len(tree.tag)) if not tree.dropped[i] and total[i]]
    return max(nodes, key=lambda i: (sums[i], density[i] if phrase[i] else 0.0, -i), default=0)


def _selected(tree: _Tree, chars: list[int]) -> list[bool]:
    """Whether a node's own text belongs to the article."""
    density, sums, total, linked, phrase = _densities(tree, chars)
    n = len(tree.tag)
    wanted = [False] * n
    nodes = [i for i in range(1, n) if not tree.dropped[i] and total[i]]
    bodies = [i for i in nodes if tree.tag[i] == "body"] or [0]
    if not nodes:
        wanted[0] = bool(total[0])
        return wanted
    best = _densest(tree, chars, density, sums, total, linked, phrase)
    path = [best]
    while path[-1] not in (0, *bodies):
        path.append(tree.parent[path[-1]])
    threshold = min(density[i] for i in path)
    # The outermost article, or else the outermost main.
    bound = max((k for k, i in enumerate(path) if tree.tag[i] in BOUNDS), key=lambda k: (tree.tag[path[k]] == BOUNDS[0], k), default=None)
    # All on the path reach the threshold; up to the bound their surroundings are searched.
    around = set() if tree.tag[best] in ("body", "html") else set(path[1 : bound + 1]) if bound is not None else {tree.parent[best]}
    whole = [False] * n
    for i in range(1, n):
        up = tree.parent[i]
        if tree.dropped[i]:
            continue
        list_of_links = tree.tag[i] in LISTS and total[i] and linked[i] * 2 > total[i] and density[i] < threshold
        if whole[up]:
            whole[i] = not list_of_links
        elif i == best:
            whole[i] = True
        elif up in around and i not in around and total[i]:
            part = bound is not None and (tree.tag[i] in HEADINGS or (phrase[i] and chars[up] > 0))
            whole[i] = density[i] >= threshold or part
        wanted[i] = whole[i] or (bound is not None and i in around)
    return wanted


def main_text(html: str | None) -> str:
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    if tree.rawdata.startswith("<!--"):
        tree.rawdata = ""  # a comment that never ends
    tree.close()
    chars = [0] * len(tree.tag)
    for node, data in tree.text:
        if not tree.dropped[node]:
            chars[node] += len(data.strip())
    _heeded(tree, chars)
    _nested(tree, chars)
    wanted = _selected(tree, chars)
    # The block of a node is its nearest block-level ancestor or itself; a run of
    # text goes on until the block changes or another block has come in between.
    block = [0] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        block[i] = i if tree.tag[i] in BLOCKS else block[tree.parent[i]]
    blocks: list[list[str]] = []
    last, seen = -1, 0
    for node, data in tree.text:
        between = any(tree.tag[k] in BLOCKS for k in range(seen + 1, node + 1))
        seen = max(seen, node)
        if not wanted[node] or tree.dropped[node]:
            last = -1 if between else last
            continue
        if block[node] != last or between:
            blocks.append([])
            last = block[node]
        blocks[-1].append(data)
    joined = (" ".join("".join(b).split()) for b in blocks)
    return "\n\n".join(b for b in joined if b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            texts = pa.array([main_text(x.as_py()) for x in part.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), texts], names=["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    rows = pages.select("page_id", "url", "html")
    found = rows.mapInArrow(_extract, rows.drop("html").withColumn("text", F.lit("").cast("string")).schema)
    return found.withColumn("n_chars", F.length("text").cast("long"))
