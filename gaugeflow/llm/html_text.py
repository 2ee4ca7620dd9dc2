"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a hidden variable: it is content (or holds
some) or not. Its tag, its
class words and the shape of its text speak for either; parent and child are tied
by potentials. Messages go up from the leaves and down from the root
(sum-product), after which each element has its marginal, and the text of
elements that are more likely content than not is the main text. All potentials
are counted on labelled pages.
"""

import html
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.html_training import labelled_pages

#: Fixed values of HTML: elements without an end tag, raw text, inline, never text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split()
)
_NEVER = frozenset(
    "head title script style noscript template iframe object svg math canvas audio video map form fieldset label legend input select option optgroup textarea button datalist output noembed noframes xmp dialog".split()
)
#: Fixed values of HTML: start tags that end an open element of these, up to a scope.
_P_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section summary table ul li dt dd".split()
)
_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"),
    "tfoot": ("tbody", "tr", "td", "th"), "thead": ("caption",),
}
_SCOPE = frozenset("ul ol dl table td th body html article section div aside main".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL
)
_TAG_START = re.compile(r"</?[a-zA-Z]")
_NAME_END = re.compile(r"[\s/>]")
_TAG_SIGN = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(?<![^\s=/>\"'])([^\s=/>\"']++)\s*+=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_ODDS_LIMIT = 30.0
_OTHER = "other"  # any tag, for those not in the labelled pages


@dataclass
class Element:
    tag: str
    parent: int
    words: tuple[str, ...] = ()
    label: int | None = None
    chars: int = 0  # of text in it, not in elements below
    linked: int = 0  # of these, inside links
    ends: int = 0  # sentences that end in it


@dataclass
class Page:
    elements: list[Element]
    runs: list[tuple[int, str]]  # (element, text), a block break where the element is -1


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if "=" in text else {}


class _Tokens:
    """Tokens of a page in order, in time linear in its length.

    After the first tag that never ends, whether a tag ends is found through the
    signs that can decide it: the next ``>`` or quote after its name, and from a
    quote the next one after its partner. What follows from a sign is remembered,
    and so is the next sign from where the last tag's name ended.
    """

    def __init__(self, source: str):
        self.source, self.broken = source, False
        self.ends: dict[int, bool] = {}
        self.ahead = {_NAME_END: (0, 0), _TAG_SIGN: (0, 0)}

    def next(self, at: int) -> re.Match | None:
        while (at := self.source.find("<", at)) >= 0:
            is_tag = _TAG_START.match(self.source, at) is not None
            if not (is_tag and self.broken) or self._ends(at):
                if found := _TOKEN.match(self.source, at):
                    return found
                self.broken |= is_tag
            at += 1
        return None

    def _next_sign(self, pattern: re.Pattern, at: int) -> int:
        """First place of a sign from ``at``, which never goes back; the size if none."""
        start, found = self.ahead[pattern]
        if not start <= at <= found:
            sign = pattern.search(self.source, at)
            found = sign.start() if sign else len(self.source)
            self.ahead[pattern] = (at, found)
        return found

    def _ends(self, at: int) -> bool:
        sign = self._next_sign(_TAG_SIGN, self._next_sign(_NAME_END, at + 2))
        passed = []
        while sign not in self.ends:
            passed.append(sign)
            if sign == len(self.source) or self.source[sign] == ">":
                self.ends[sign] = sign < len(self.source)
                break
            partner = self.source.find(self.source[sign], sign + 1)
            if partner < 0:
                self.ends[sign] = False
                break
            further = _TAG_SIGN.search(self.source, partner + 1)
            sign = further.start() if further else len(self.source)
        for place in passed:
            self.ends[place] = self.ends[sign]
        return self.ends[sign]


class _Stack:
    """Open elements (tag, number of its block) with the places of each tag."""

    def __init__(self):
        self.open: list[tuple[str, int]] = []
        self.places: dict[str, list[int]] = {}

    def push(self, tag: str, block: int) -> None:
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, block))

    def _last(self, tags) -> int:
        return max((self.places[tag][-1] for tag in tags if self.places.get(tag)), default=-1)

    def pop_to(self, names, scope) -> list[tuple[str, int]]:
        """Takes the innermost element of ``names`` off, with all in it, unless one of ``scope`` is in it."""
        place = self._last(names)
        if place < 0 or place < self._last(scope):
            return []
        gone = self.open[place:]
        for tag, _ in gone:
            self.places[tag].pop()
        del self.open[place:]
        return gone


def parse_page(source: str) -> Page:
    """Elements in page order and the runs of text between them.

    Broken markup is read as browsers do in the common cases: missing end tags,
    unknown end tags, a page that just stops, ``<`` that starts no tag.
    """
    elements, runs = [Element("#page", -1)], []
    stack = _Stack()  # inline elements belong to the block above
    stack.push("#page", 0)
    links = 0

    def add_text(text: str) -> None:
        if not text:
            return
        text = html.unescape(text)
        at = stack.open[-1][1]
        runs.append((at, text))
        size = len(text) - text.count(" ")
        element = elements[at]
        element.chars += size
        element.linked += size if links else 0
        element.ends += sum(text.count(c) for c in ".!?")

    def close(names, scope=_SCOPE) -> None:
        nonlocal links
        gone = stack.pop_to(names, scope)
        links -= sum(tag == "a" for tag, _ in gone)
        if any(tag not in _INLINE for tag, _ in gone):
            runs.append((-1, ""))

    at, size, tokens = 0, len(source), _Tokens(source)
    while at < size:
        found = tokens.next(at)
        if not found:
            add_text(source[at:])
            break
        add_text(source[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            close((tag,), ())
            continue
        if tag in _P_ENDS:
            close(("p",))
        if tag in _CLOSES:
            for _ in _CLOSES[tag]:
                close(_CLOSES[tag], frozenset(("ul", "ol", "dl", "table")))
        if tag in _INLINE:
            stack.push(tag, stack.open[-1][1])
            links += tag == "a"
            continue
        runs.append((-1, ""))
        if tag in _VOID:
            continue
        given = _attributes(found[3])
        words = re.split(r"[\s_\-]+", f"{given.get('class', '')} {given.get('id', '')} {given.get('role', '')}".lower())
        label = int(given["y"]) if given.get("y") in ("0", "1") else None
        elements.append(Element(tag, stack.open[-1][1], tuple(dict.fromkeys(w for w in words if w)), label))
        stack.push(tag, len(elements) - 1)
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b", re.IGNORECASE).search(source, at)
            at = end.start() if end else size
    return Page(elements, runs)


def _signs(element: Element) -> list[tuple[str, str]]:
    signs = [("word", word) for word in element.words] or [("word", "")]
    if element.chars:
        signs.append(("linked", str(round(3 * element.linked / element.chars))))
        signs.append(("ends", str(min(3, element.ends))))
        signs.append(("chars", str(min(6, int(math.log2(element.chars + 1) / 1.5)))))
    return signs


@dataclass(frozen=True)
class PageModel:
    """Log odds for content of each sign; ties to the parent by tag.

    A tie is how often an element of the tag is content or not, under a parent
    that is or is not: (11, 10, 01, 00).
    """

    signs: dict[tuple[str, str], float]
    ties: dict[str, tuple[float, float, float, float]]


def train_page_model(pages: list[str]) -> PageModel:
    """Counts signs and ties on pages whose elements are labelled with ``y``."""
    counts = (Counter(), Counter())
    totals = (Counter(), Counter())
    ties: dict[str, Counter] = {_OTHER: Counter()}
    for source in pages:
        elements = parse_page(source).elements
        labels = [1]
        for element in elements[1:]:
            labels.append(labels[element.parent] if element.label is None else element.label)
        for element, label in zip(elements[1:], labels[1:]):
            if element.tag in _NEVER:
                continue
            for tag in (element.tag, _OTHER):
                ties.setdefault(tag, Counter())[labels[element.parent], label] += 1
            for sign in _signs(element):
                counts[label][sign] += 1
                totals[label][sign[0]] += 1
    signs = {}
    for sign in {*counts[0], *counts[1]}:
        kinds = len({s for s in (*counts[0], *counts[1]) if s[0] == sign[0]})
        share = [(counts[y][sign] + 0.5) / (totals[y][sign[0]] + 0.5 * kinds) for y in (0, 1)]
        signs[sign] = math.log(share[1] / share[0])
    made = {}
    for kind, seen in ties.items():
        rows = [[seen[p, c] + 0.5 for c in (0, 1)] for p in (0, 1)]
        (n00, n01), (n10, n11) = ([x / sum(r) for x in r] for r in rows)
        made[kind] = (n11, n10, n01, n00)
    return PageModel(signs, made)


def _exp(odds: float) -> float:
    return math.exp(max(-_ODDS_LIMIT, min(_ODDS_LIMIT, odds)))


def content_marginals(elements: list[Element], model: PageModel) -> list[float]:
    """Log odds of each element for content, by one pass up and one down."""
    number = len(elements)
    own = [0.0] * number
    fixed = [False] * number
    for at, element in enumerate(elements):
        fixed[at] = at > 0 and (element.tag in _NEVER or fixed[element.parent])
        if fixed[at] or not at:  # the page itself holds content
            own[at] = -_ODDS_LIMIT if fixed[at] else _ODDS_LIMIT
        else:
            own[at] = sum(model.signs.get(s, 0.0) for s in _signs(element))
    gathered, message = own[:], [0.0] * number
    for at in range(number - 1, 0, -1):  # children stand after their parents
        if fixed[at]:
            continue  # what can never be text says nothing of its parent
        n11, n10, n01, n00 = model.ties.get(elements[at].tag, model.ties[_OTHER])
        odds = _exp(gathered[at])
        message[at] = math.log((n11 * odds + n10) / (n01 * odds + n00))
        gathered[elements[at].parent] += message[at]
    belief = gathered[:]
    for at in range(1, number):
        if fixed[at]:
            continue
        parent = elements[at].parent
        n11, n10, n01, n00 = model.ties.get(elements[at].tag, model.ties[_OTHER])
        odds = _exp(belief[parent] - message[at])
        belief[at] = gathered[at] + math.log((n11 * odds + n01) / (n10 * odds + n00))
    return belief


def main_text(source: str | None, model: PageModel) -> str:
    """Blocks of content joined by spaces; empty for an empty page."""
    if not source:
        return ""
    page = parse_page(source)
    belief = content_marginals(page.elements, model)
    blocks, block = [], []
    for at, text in [*page.runs, (-1, "")]:
        if at < 0:
            if joined := " ".join("".join(block).split()):
                blocks.append(joined)
            block = []
        elif belief[at] > 0:
            block.append(text)
    return " ".join(blocks)


def _extractor(model: PageModel):
    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                texts = [main_text(h, model) for h in part.column("html").to_pylist()]
                columns = [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())]
                columns.append(pa.array([len(t) for t in texts], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return run


def extract_text(pages: DataFrame, model: PageModel | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html).

    Row by row, so repeated rows and null ids or urls are kept as they are. A null
    or empty html has an empty text. Markup that never closes is read to the end
    of the page. Other columns are ignored.
    """
    model = model or train_page_model(labelled_pages())
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(_extractor(model), "page_id long, url string, text string, n_chars long")
