"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelvigil.llm.common import map_columns, table

#: A comment may be empty in short form. A value is quoted only right behind its equals sign; quotes elsewhere are letters.
_TAG = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))"""
    r"""|<(/?)([A-Za-z][^\s/>]*)((?:[^=>]|=\s*(?:"[^"]*"|'[^']*'|[^\s>"'][^\s>]*)?)*+>|[^>]*>|[^>]*\Z)"""
    r"""|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([A-Za-z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_WORDS = re.compile(r"[a-z]+")
_JOINT = re.compile(r"[-_]+")
_MARKS = re.compile(r"[.,;:!?…。，、；：！？]")

#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
#: An opening tag ends an open element of these names, up to the element named behind the colon.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
#: Never part of an article.
DROPPED = frozenset(
    "head nav footer aside button select dialog noscript template svg math object audio video canvas".split()
)
#: Classes, ids and roles that mark what is not the article, alone or joined to each other.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion menu nav navbar navigation breadcrumb "
    "breadcrumbs masthead banner footer sidebar widget related recommended share sharing social cookie cookies consent "
    "gdpr notice notices alert newsletter subscribe subscription signup login search comment comments commentlist "
    "disqus reply replies popup modal overlay dialog toolbar pagination pager copyright disclaimer contentinfo "
    "complementary".split()
)
#: Elements, and words of a class, id or role, that hold an article.
CONTAINERS = frozenset({"article", "main"})
CONTENT = frozenset("article articlebody content entry main post story".split())
#: Elements that say nothing of their text, and with them those of layout tables: the article's subtree is one of these.
BARE = frozenset("html body div section center article main".split())
LAYOUT = BARE | frozenset("table tbody tr td".split())
#: Share of the fused mass that makes a container the page's article; share that an element needs to be the article's
#: subtree on a page without one; link share that makes a list a menu.
MAJOR, SUBTREE, LINKS = 0.5, 0.9, 0.8
#: A text with one mark in so many characters is taken for sentences throughout.
SENTENCE = 60
#: Weights of a node and of its neighbours below the same parent.
KERNEL = (0.5, 0.25)


@dataclass(eq=False, repr=False)
class _Open:
    """An open element, with what holds for everything inside it. Paths are numbered, so depth costs nothing."""

    name: str
    path: int
    parent: int
    dropped: bool
    container: int | None
    content: bool
    list: int | None
    marked: bool
    article: bool
    number: int
    above: _Open | None


_ROOT = _Open("", 0, -1, False, None, False, None, False, False, 0, None)


@dataclass
class Node:
    """Text of one block inside an element, how many of its characters are in links, and the numbers of these links."""

    inside: _Open
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    links: set[int] = field(default_factory=set)
    text: str = ""


def _only(token: str, words: frozenset[str]) -> bool:
    """True if a class, id or role is one of the words, or some of them and numbers joined by - or _."""
    if token in words:
        return True
    parts = [part for part in _JOINT.split(token) if not part.isdigit()]
    return bool(parts) and words.issuperset(parts)


def _opened(name: str, rest: str, outer: _Open, paths: dict[tuple[int, str], int], number: int) -> _Open:
    words: set[str] = set()
    tokens: set[str] = set()
    hidden = False
    if len(rest) > 1:
        for key, *values in _ATTRIBUTE.findall(rest):
            value = next((v for v in values if v), "").lower()
            if key.lower() in ("class", "id", "role"):
                words.update(_WORDS.findall(value))
                tokens.update(value.split())
            hidden |= key.lower() == "hidden" or (key.lower() == "aria-hidden" and value == "true")
    page = name in ("html", "body")
    # The header of an article holds its title; the header of a page does not.
    dropped = hidden or name in DROPPED or (name == "header" and outer.container is None)
    # Some servers wrap the whole page in a form, so a form is weighed like a class word.
    marked = name == "form" or any(_only(t, BOILERPLATE) or (t == "header" and outer.container is None) for t in tokens)
    label = name if not words else f"{name}.{'.'.join(sorted(words))}"
    path = paths.setdefault((outer.path, label), len(paths) + 1)
    main = name == "main" or any("main" in _JOINT.split(t) and _only(t, CONTENT) for t in tokens)
    container = outer.container
    if container is None and (name in CONTAINERS or main):
        container = path
    content = any(not BOILERPLATE.intersection(w) and CONTENT.intersection(w) for w in map(_WORDS.findall, tokens))
    return _Open(
        name, path, outer.path, outer.dropped or (dropped and not page), container,
        outer.content or name in CONTAINERS or content,
        number if name in ("ul", "ol") or (name == "li" and outer.list is None) else outer.list,
        marked and not page, name in CONTAINERS or main, number, outer,
    )


def blocks(page: str) -> list[Node]:
    """The text blocks of a page in page order, with their paths from the root; comments and raw elements are gone."""
    nodes: list[Node] = []
    stack: list[_Open] = [_ROOT]
    open_names: Counter[str] = Counter()
    paths: dict[tuple[int, str], int] = {}
    links = opened = anchors = 0
    node: Node | None = None
    at, end = 0, len(page)

    def say(text: str) -> None:
        nonlocal node
        if node is None:
            if not text.strip():
                return
            node = Node(stack[-1])
            nodes.append(node)
        node.pieces.append(text)
        if links:
            node.linked += len(text)
            node.links.add(links)

    def close(place: int) -> None:
        open_names.subtract(o.name for o in stack[place:])
        del stack[place:]

    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            say(html.unescape(page[at:]))
            break
        if m.start() > at:
            say(html.unescape(page[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name == "br":
            say(" ")
            continue
        if name == "a":
            anchors += 1
            links = 0 if m[1] else anchors
        if name in INLINE:
            continue
        if name in RAW:
            if not m[1]:
                ended = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = ended.end() if ended else end
            continue
        node = None
        if name in VOID:
            continue
        if m[1]:
            if open_names[name] > 0:
                close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name))
                links = 0
            continue
        if name in CLOSES:
            ends, kept = CLOSES[name]
            if any(open_names[other] > 0 for other in ends):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name in kept:
                        break
                    if stack[i].name in ends:
                        close(i)
                        break
        elif stack[-1].name == "p":  # a paragraph holds no block
            close(len(stack) - 1)
        opened += 1
        stack.append(_opened(name, m[3], stack[-1], paths, opened))
        open_names[name] += 1
    for found in nodes:
        found.text = " ".join("".join(found.pieces).split())
    return [found for found in nodes if found.text]


def _elements(nodes: list[Node]) -> list[_Open]:
    """The elements with text somewhere inside, in the order they were opened."""
    found: dict[int, _Open] = {}
    for n in nodes:
        element = n.inside
        while element is not None and element.number not in found:
            found[element.number] = element
            element = element.above
    return [found[number] for number in sorted(found)]


def _masses(nodes: list[Node], elements: list[_Open], fused: np.ndarray) -> dict[int, float]:
    """The sum of ``fused`` inside each element, by its number."""
    mass = {e.number: 0.0 for e in elements}
    for n, value in zip(nodes, fused.tolist()):
        mass[n.inside.number] += value
    for e in reversed(elements):
        if e.above is not None:
            mass[e.above.number] += mass[e.number]
    return mass


def _boilerplate(nodes: list[Node], elements: list[_Open], fused: np.ndarray) -> dict[int, bool]:
    """Which elements, by number, are dropped, themselves or with one around them.

    A class, id or role alone does not drop the element that is or holds the heaviest article or any main, nor one
    with most of the fused mass, unless articles have more than a remainder of it outside all marked elements.
    """
    mass = _masses(nodes, elements, fused)
    every = mass[elements[0].number]
    free: dict[int, bool] = {}
    holds: set[int] = set()
    articles = [e for e in elements if e.article and mass[e.number] > 0]
    heaviest = max(articles, key=lambda e: mass[e.number], default=None)
    for e in elements:
        free[e.number] = not e.marked and (e.above is None or free[e.above.number])
    for e in articles:
        if e is heaviest or e.name == "main":
            while e is not None and e.number not in holds:
                holds.add(e.number)
                e = e.above
    outside = sum(v for n, v in zip(nodes, fused) if n.inside.container is not None and free[n.inside.number])
    alone = outside < (1 - SUBTREE) * every
    dropped: dict[int, bool] = {}
    for e in elements:
        most = alone and mass[e.number] >= MAJOR * every
        dropped[e.number] = (
            e.dropped or (e.above is not None and dropped[e.above.number])
            or (e.marked and e.number not in holds and not most)
        )
    return dropped


def _subtree(nodes: list[Node], elements: list[_Open], fused: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Which nodes are in the innermost element that has nearly all of the fused mass.

    What stands beside it or beside an element around it comes along if it is an element of text (a heading, a list,
    a table) or has the same path; of the latter not what is bare text without a mark, nor a layout cell of links.
    """
    mass = _masses(nodes, elements, fused)
    chosen = elements[0]
    steps, around = {chosen.number}, set()
    for e in elements:
        if e.above is chosen and e.name in LAYOUT and mass[e.number] >= SUBTREE * mass[elements[0].number]:
            around.add(chosen.number)
            chosen = e
            steps.add(e.number)
    paths = {e.path for e in elements if e.number in steps}
    inside: dict[int, bool] = {}
    beside: dict[int, bool] = {}
    for e in elements:
        above = None if e.above is None else e.above.number
        inside[e.number] = e is chosen or inside.get(above, False)
        alike = above in around and e.number not in steps and (e.name not in BARE or e.path in paths)
        beside[e.number] = alike or beside.get(above, False)
    return np.array([
        inside[n.inside.number]
        or beside[n.inside.number] and (n.inside.name not in BARE or m > 0)
        and not (n.inside.name in LAYOUT and 2 * n.linked > len(n.text))
        for n, m in zip(nodes, marks)
    ])


def _menus(nodes: list[Node], own: np.ndarray) -> np.ndarray:
    """Which nodes are menus: lists that are links as a whole, and blocks of several links on paths of nothing else."""
    sizes: Counter[tuple[str, int]] = Counter()
    linked: Counter[tuple[str, int]] = Counter()
    keys = [("path", p) if n.inside.list is None else ("list", n.inside.list) for n, p in zip(nodes, own.tolist())]
    for n, key in zip(nodes, keys):
        sizes[key] += len(n.text)
        linked[key] += min(n.linked, len(n.text))
    return np.array([
        linked[key] > LINKS * sizes[key] and (key[0] == "list" or len(n.links) > 1) for n, key in zip(nodes, keys)
    ])


def content_nodes(nodes: list[Node]) -> list[Node]:
    """The nodes of the article.

    For each path, the characters outside links and the share of sentences by punctuation marks are averaged over its
    nodes. Both ratios are smoothed over neighbours below one parent, fused, and set to zero in boilerplate; the fused ratio grows in line with the characters. An article or main element with most of the fused mass is the
    article, otherwise the innermost element with nearly all of it. Every block in there is kept, however short,
    but boilerplate and menus.
    """
    if not nodes:
        return []
    _, own = np.unique([n.inside.path for n in nodes], return_inverse=True)
    free = np.array([max(len(n.text) - n.linked, 0) for n in nodes], dtype=float)
    marks = np.array([len(_MARKS.findall(n.text)) for n in nodes], dtype=float)
    sentences = np.minimum(1.0, SENTENCE * marks / [len(n.text) for n in nodes])
    count = np.bincount(own)
    ratios = [(np.bincount(own, x) / count)[own] for x in (free, sentences)]
    parents = np.array([n.inside.parent for n in nodes])
    beside = (parents[1:] == parents[:-1]).astype(float)
    smooth = []
    for ratio in ratios:
        total, weight = KERNEL[0] * ratio, np.full(len(nodes), KERNEL[0])
        for mine, other in ((slice(1, None), slice(None, -1)), (slice(None, -1), slice(1, None))):
            total[mine] += KERNEL[1] * beside * ratio[other]
            weight[mine] += KERNEL[1] * beside
        smooth.append((np.bincount(own, total / weight) / count)[own])
    elements = _elements(nodes)
    standing = np.array([0.0 if n.inside.dropped else 2.0 if n.inside.content else 1.0 for n in nodes])
    fused = smooth[0] * (1 + smooth[1]) * standing
    boilerplate = _boilerplate(nodes, elements, fused)
    dropped = np.array([boilerplate[n.inside.number] for n in nodes])
    fused[dropped] = 0
    if not fused.any():
        return []
    mass: dict[int, float] = {}
    for n, value in zip(nodes, fused):
        if n.inside.container is not None:
            mass[n.inside.container] = mass.get(n.inside.container, 0.0) + value
    best = max(mass, key=mass.get, default=None)
    if best is not None and mass[best] >= MAJOR * fused.sum():
        passed = np.array([n.inside.container == best for n in nodes])
    else:
        passed = _subtree(nodes, elements, fused, marks)
    return [n for n, keep in zip(nodes, passed & ~dropped & ~_menus(nodes, own)) if keep]


def main_text(page: str | None) -> str:
    """Blocks of the article, white space made single, joined by line ends; empty if there is none."""
    return "\n".join(n.text for n in content_nodes(blocks(page or "")))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page, from its whole html.

    Null or empty html, or a page without an article, gives an empty text. Null ids and urls and repeated rows come
    as they are. Other columns are not read.
    """
    out = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def work(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            texts = [main_text(page) for page in batch["html"]]
            yield {"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    columns = [F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html")]
    return map_columns(pages, columns, "page_id long, url string, text string, n_chars long", work, out)


def op3_html_text(spark, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
