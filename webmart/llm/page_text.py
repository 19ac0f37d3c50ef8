"""Main text of web pages by tag-path ratios.

A page is cut into blocks: stretches of text between the boundaries of block elements, each with its tag path, the block
elements from the root to it with their classes. Page furniture is left out with all it holds: ``FURNITURE`` elements,
roles, classes and ids that name it, and headers outside articles; so are comments of the markup and elements whose content
is no text.

The other blocks are scored by path. Of each path three ratios are taken over all its blocks: text length per block,
punctuation marks per block, and the share of text in links. Length and punctuation are smoothed along the page by a
Gaussian and averaged again by path; a path's score fuses them: the root of length times punctuation (each with one added),
times the share outside links. Where a page marks its article (failing that, its main part) and the mark holds text, paths
elsewhere score nothing; an article within an article is a reader's comment, unless the outer one has no text of its own.
Paths of at least ``SHARE`` of the best score select content: with a path, all blocks of its section are kept (the article
or main part; elsewhere the nearest division, section or cell), so that headings and short paragraphs stay with their
neighbours. What is kept is kept whole.

Character references are decoded once. White space (as Python's ``str.split`` has it) becomes one space; blocks without any
other character vanish. Null and empty html gives an empty text. Unclosed elements end where HTML ends them; a tag that never
ends takes the rest of the page along. A step of a path is an element with its first class, cut to ``STEP`` characters, and
elements deeper than ``DEEPEST`` share the path of that depth, so paths stay short on any page. Rows are independent: repeated rows
repeat their result; other columns are ignored. Work and memory are in proportion to the page.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from webmart.llm.common import Columns, in_batches

SHARE = 0.35
STEP, DEEPEST = 24, 32
#: Weights of a block and of its neighbours one and two places away: a Gaussian of deviation 0.6.
KERNEL = tuple(math.exp(-((d / 0.6) ** 2) / 2) for d in range(3))

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; titles are text of the window, not of the page.
_RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
#: Elements within lines: they neither end a block nor appear in a path.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Elements within lines whose content is no text of the line.
_HIDDEN = frozenset(
    "script style title textarea iframe noembed noframes button select datalist noscript template object applet svg canvas audio "
    "video picture map".split()
)
#: Elements that carry no main text.
FURNITURE = frozenset("head nav footer aside form fieldset option dialog menu xmp".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog status menu menubar".split())
#: Words at the beginning or the end of a class or an id that name page furniture.
_NAMES = frozenset(
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs masthead banner header footer sidebar aside widget widgets ad ads "
    "advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promotion cookie cookies consent "
    "gdpr notice notices notification alert alerts popup modal overlay newsletter subscribe subscription signup login search form comment "
    "comments respond replies disqus share sharing social related recommended recommendations pagination pager toolbar".split()
)
_NEGATED = frozenset("has no not with without is".split())
_STATES = frozenset("open closed free enabled disabled".split())
_SECTIONS = frozenset("html body article main section div td th details center".split())
_P_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
#: What a start tag ends: these elements, unless one of the latter stands in between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
#: A ``p`` inside one of these is not ended by what comes in another.
_SCOPES = frozenset("html body article main section div td th table li blockquote aside nav footer header form".split())

_VALUE = r"\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|((?![\"'])[^\s>]*+))"
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:{_VALUE})?+")
_TAG = re.compile(rf"<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+)>")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
#: Where a block stands, by how much of the page's own marking speaks for it.
ELSEWHERE, MAIN, NESTED, ARTICLE = range(4)


@dataclass
class Block:
    """Text of one block: its tag path, the path of its section, how many of its characters are in links, and its mark."""

    path: str
    section: str
    text: str
    linked: int
    mark: int


@dataclass
class Path:
    """Ratios of one tag path."""

    nodes: int = 0
    chars: int = 0
    punctuation: int = 0
    linked: int = 0
    mark: int = ELSEWHERE
    score: float = 0.0
    kept: bool = False
    smoothed: list[float] = field(default_factory=lambda: [0.0, 0.0])


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, content) of the parts of a page: text, start tags with their attributes, and end tags."""
    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            yield "text", "", page[at:]
            return
        if mark > at:
            yield "text", "", page[at:mark]
        following = page[mark + 1 : mark + 3]
        if following[:1].isascii() and following[:1].isalpha() or following[:1] == "/" and following[1:].isascii() and following[1:].isalpha():
            tag = _TAG.match(page, mark)
            if tag is None:
                return
            name, at = tag[2].lower(), tag.end()
            if tag[1]:
                yield "end", name, ""
                continue
            yield "start", name, tag[3]
            if name in _RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(page, at)
                at = close.start() if close else size
        elif page.startswith("<!--", mark):
            end = page.find("-->", mark + 2)
            at = end + 3 if end >= 0 else size
        elif following[:1] in ("!", "?", "/"):
            end = page.find(">", mark)
            at = end + 1 if end >= 0 else size
        else:
            yield "text", "", "<"
            at = mark + 1


def _named(attribute: str) -> bool:
    """Whether a class or an id names page furniture."""
    for name in attribute.split():
        words = [word.lower() for word in _WORDS.findall(name)]
        if words and words[0] not in _NEGATED and words[-1] not in _STATES and not _NAMES.isdisjoint((words[0], words[-1])):
            return True
    return False


class _Element:
    """An open block element: its path and section, whether it is page furniture, and its mark."""

    __slots__ = ("name", "depth", "path", "section", "skip", "mark")

    def __init__(self, name: str, above: _Element | None, attributes: str = ""):
        found = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
        classes, role = found.get("class", ""), found.get("role", "").lower()
        self.name = name
        self.depth = above.depth + 1 if above else 0
        self.mark = above.mark if above else ELSEWHERE
        starts = name == "article" or found.get("itemprop", "").lower() == "articlebody"
        if name == "article":
            self.mark = NESTED if self.mark >= NESTED else ARTICLE
        elif starts:
            self.mark = ARTICLE
        elif (name == "main" or role == "main") and self.mark < MAIN:
            starts, self.mark = True, MAIN
        furniture = name in FURNITURE or role in _ROLES or name == "header" and self.mark < NESTED
        if not furniture and name not in ("html", "body", "main"):
            furniture = (_named(classes) or _named(found.get("id", ""))) and not (name == "header" and self.mark >= NESTED)
        self.skip = furniture or above is not None and above.skip
        if above is None or self.depth > DEEPEST:
            self.path = above.path if above else ""
        else:
            step = ".".join([name, *classes.split()[:1]])[:STEP]
            self.path = f"{above.path}/{step}"
        own = above is None or starts or name in _SECTIONS and self.mark == ELSEWHERE
        self.section = self.path if own else above.section


class _Page:
    """The open elements of a page while its tokens are read."""

    def __init__(self) -> None:
        self.elements = [_Element("", None)]
        self.count: Counter[str] = Counter()
        self.hidden: list[str] = []
        self.hidden_count: Counter[str] = Counter()

    def open(self, name: str, attributes: str) -> None:
        self.elements.append(_Element(name, self.elements[-1], attributes))
        self.count[name] += 1

    def cut(self, place: int) -> None:
        for element in self.elements[place:]:
            self.count[element.name] -= 1
        del self.elements[place:]

    def close(self, names: frozenset[str] | set[str], bounds: frozenset[str] | set[str] = frozenset()) -> bool:
        """End the innermost element of these names, if any, unless one of ``bounds`` stands in between."""
        if any(self.count[name] for name in names):
            for place in range(len(self.elements) - 1, 0, -1):
                if self.elements[place].name in names:
                    self.cut(place)
                    return True
                if self.elements[place].name in bounds:
                    break
        return False

    def passes_hidden(self, kind: str, name: str) -> bool:
        """Follow the elements without text; False while inside of one."""
        if kind == "text":
            return not self.hidden
        if kind == "start":
            if (self.hidden or name in _HIDDEN) and name not in _VOID:
                self.hidden.append(name)
                self.hidden_count[name] += 1
            return not self.hidden and name not in _HIDDEN
        if not self.hidden:
            return True
        if self.hidden_count[name]:
            ended = ""
            while ended != name:
                ended = self.hidden.pop()
                self.hidden_count[ended] -= 1
            return False
        if self.count[name]:  # the element around it ends, so it does
            self.hidden.clear()
            self.hidden_count.clear()
        return not self.hidden


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order, without page furniture."""
    found: list[Block] = []
    state = _Page()
    text: list[str] = []
    linked = 0
    in_link = False

    def flush() -> None:
        nonlocal linked, in_link
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                top = state.elements[-1]
                found.append(Block(top.path, top.section, words, min(linked, len(words)), top.mark))
            text.clear()
        linked, in_link = 0, False

    for kind, name, content in tokens(page or ""):
        if not state.passes_hidden(kind, name):
            continue
        if kind == "text":
            if not state.elements[-1].skip:
                text.append(content)
                linked += len(content) if in_link else 0
        elif name in _INLINE:
            if name == "a":
                in_link = kind == "start"
            elif name == "br" and not state.elements[-1].skip:
                text.append(" ")
        elif kind == "start":
            flush()
            if name in _P_ENDS:
                state.close({"p"}, _SCOPES)
            while name in _ENDS and state.close(*_ENDS[name]):
                pass
            if name not in _VOID:
                state.open(name, content)
        else:
            flush()
            state.close({name})
    flush()
    return found


def score_paths(found: list[Block]) -> dict[str, Path]:
    """The ratios, score and verdict of each tag path."""
    paths: dict[str, Path] = {}
    for block in found:
        path = paths.setdefault(block.path, Path(mark=block.mark))
        path.nodes += 1
        path.chars += len(block.text)
        path.punctuation += len(_PUNCTUATION.findall(block.text))
        path.linked += block.linked
    own = [(paths[b.path].chars / paths[b.path].nodes, paths[b.path].punctuation / paths[b.path].nodes) for b in found]
    for i, block in enumerate(found):
        near = range(max(0, i - 2), min(len(found), i + 3))
        weight = sum(KERNEL[abs(i - j)] for j in near)
        for k in (0, 1):
            paths[block.path].smoothed[k] += sum(KERNEL[abs(i - j)] * own[j][k] for j in near) / weight
    mark = max((path.mark for path in paths.values()), default=ELSEWHERE)
    for path in paths.values():
        length, punctuation = (value / path.nodes for value in path.smoothed)
        if path.mark == mark:
            path.score = math.sqrt((1 + length) * (1 + punctuation)) * (1 - path.linked / path.chars)
    best = max((path.score for path in paths.values()), default=0.0)
    for path in paths.values():
        path.kept = path.score > 0 and path.score >= SHARE * best
    return paths


def main_text(page: str | None) -> tuple[str, dict[str, Path]]:
    """The kept blocks of a page joined by empty lines, and its tag paths."""
    found = blocks(page)
    paths = score_paths(found)
    sections = {(block.section, block.mark) for block in found if paths[block.path].kept}
    return "\n\n".join(block.text for block in found if (block.section, block.mark) in sections), paths


PATHS = "array<struct<path: string, nodes: int, chars: int, punctuation: int, score: double, kept: boolean>>"


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, the main text, its length in code points, and the scored tag paths."""

    def start():
        def apply(columns: Columns) -> Columns:
            made = [main_text(page) for page in columns["html"]]
            paths = [
                [
                    {"path": name, "nodes": p.nodes, "chars": p.chars, "punctuation": p.punctuation, "score": p.score, "kept": p.kept}
                    for name, p in scored.items()
                ]
                for _, scored in made
            ]
            return {
                "page_id": columns["page_id"],
                "url": columns["url"],
                "text": [text for text, _ in made],
                "n_chars": [len(text) for text, _ in made],
                "paths": paths,
            }

        return apply

    schema = f"page_id long, url string, text string, n_chars long, paths {PATHS}"
    return in_batches(pages.select("page_id", "url", "html"), schema, start, rows=64)
