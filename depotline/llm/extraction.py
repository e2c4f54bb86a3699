"""Main text of web pages by a maximum-scoring subsequence.

A page is read once into tokens: words, each with the block it stands in, and tags. Words
score positive or negative by what their block looks like (its kind, its length, its share
of linked words), tags score negative by their name, and an element that is no content by
its own name (navigation, forms, adverts, comments of readers and the like) scores once for
the whole of it, so that a long one inside an article does not tear it apart. A linear scan
finds the contiguous run of the largest total. The run is widened to the element that holds
all of it, where that is no mere wrapper of the page, and its blocks are the text.

Weights come from labelled pages: pages that mark their main text themselves, with one
``article`` or ``main`` element. Spark counts over all of them what share of each kind of
word and tag lies inside the marked element; the logarithm of the odds, drawn towards
prior weights by some pseudo-counts, is the weight. The marks themselves are never scored,
so the weights hold on pages without them; on a labelled page what lies outside its mark scores
negative, and what stands inside it and is no aside is the text. Without labelled pages the
priors decide.

Text: character references are decoded; white space inside a block becomes one space; blocks
are trimmed and joined by one line feed in page order; empty ones vanish. A line break
inside a block is white space. Scripts, styles, templates and comments never count.

Defined cases: null and empty pages, and pages without any words that score, have the empty
text; tags that are never closed end where their parent does; markup that breaks off is
text up to there; repeated rows are rows of their own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.llm.batches import emit, records
from depotline.llm.registry import query

# ---- fixed values: names of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text; all others stand inside one.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup "
    "hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements whose content is not markup, or never the page's own text.
RAW = frozenset("script style noscript template textarea title iframe svg math object canvas audio video select button".split())
#: Elements that a following block ends.
PARAGRAPH = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Elements that end the ones named before them, up to the elements that hold them.
ITEMS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "td": (("td", "th"), ("tr",)),
    "th": (("td", "th"), ("tr",)),
    "tr": (("tr",), ("table",)),
}
#: Elements that are no content by their name, and those whose role says so.
ASIDE = frozenset("nav header footer aside form dialog menu fieldset".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words in classes and ids of elements that are no content, or are.
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion teaser nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs "
    "header masthead topbar footer foot bottombar copyright sidebar side aside widget widgets rail notice notices cookie cookies consent gdpr privacy popup modal overlay alert "
    "newsletter subscribe subscription signup login comment comments commentlist respond reply replies disqus discussion feedback social share sharing follow related recommended "
    "recommendations more pagination pager paging toolbar search searchbox tags tagcloud hidden disclaimer skip".split()
)
CONTENT_WORDS = frozenset("article content main post entry story body text page wrapper container site layout root app".split())
#: Words in classes and ids that make an ``article`` no article of the page.
REPLY_WORDS = frozenset("comment comments reply replies teaser related promo ad ads card".split())
MARKS = ("article", "main")

# A quote opens a value only behind an equals sign.
TAG = re.compile(r"<!--(?:.*?-->|.*)|<!\[CDATA\[(?:.*?\]\]>|.*)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*+\"|'[^']*+')?)*+)(?:>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
PART = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)

#: Pages that the prior weighs as much as.
PRIOR_PAGES = 20.0
#: Largest weight of a word, and the least a tag or an aside element costs.
WORD_LIMIT, TAG_LEAST, TAG_LIMIT = 2.0, 0.1, 4.0


@dataclass
class Block:
    """A run of text between block tags."""

    texts: list[str] = field(default_factory=list)
    kind: str = "text"
    words: int = 0
    linked: int = 0
    #: Element that it stands in, and the outermost one around it that is no content (-1: none).
    parent: int = 0
    aside: int = -1

    def text(self) -> str:
        return " ".join("".join(self.texts).split())

    def shape(self) -> str:
        """What its words look like: kind, length, share of linked words."""
        length = min(5, self.words.bit_length() - 1) if self.words else 0
        linked = 0 if not self.linked else 1 if 2 * self.linked <= self.words else 2
        return f"{self.kind}:{length}:{linked}"


SURE, UNSURE = 1, 2


@dataclass
class Element:
    name: str
    parent: int
    #: Nearest element around it (or itself) that is a block, and its place among the open ones.
    block: int
    depth: int
    #: Whether it is no content by its name: 0, SURE, or UNSURE where it may turn out to hold the page's heading or mark.
    kind: int
    #: Outermost element around it that is no content (-1: none).
    aside: int
    #: Names of MARKS around it.
    marks: frozenset[str]
    first: int
    last: int = -1


class Page:
    """Blocks, elements and the sequence of tags between them, from one reading of the markup."""

    def __init__(self, markup: str):
        self.blocks: list[Block] = []
        self.elements: list[Element] = [Element("", -1, 0, 0, 0, -1, frozenset(), 0)]
        #: Order of what scores: numbers of blocks as they are, tags by name.
        self.sequence: list[int | str] = []
        self._open = [0]
        self._opened: Counter[str] = Counter()
        self._block: Block | None = None
        self._read(markup)
        self._close_to(1)
        self.elements[0].last = len(self.blocks)

    # ---- reading

    def _read(self, markup: str) -> None:
        at, size = 0, len(markup)
        while at < size:
            found = TAG.search(markup, at)
            if found is None:
                self._text(markup[at:])
                return
            if found.start() > at:
                self._text(markup[at : found.start()])
            at = found.end()
            if found.group(2) is None:
                continue
            name, attributes = found.group(2).lower(), found.group(3) or ""
            if found.group(1):
                self._end_tag(name)
            elif name not in RAW:
                self._start_tag(name, attributes)
            elif not attributes.endswith("/"):
                # Up to the end tag, or without one all that follows.
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(markup, at)
                at = end.end() if end else size

    def _text(self, text: str) -> None:
        if self._block is None:
            if text.isspace():
                return
            parent = self.elements[self._open[-1]].block
            own = self.elements[parent]
            kind = "heading" if own.name in HEADINGS else own.name if own.name in ("p", "li", "td", "blockquote", "pre") else "text"
            self._block = Block(kind=kind, parent=parent, aside=own.aside)
            self.sequence.append(len(self.blocks))
            self.blocks.append(self._block)
        self._block.texts.append(html.unescape(text) if "&" in text else text)
        n = len(text.split())
        self._block.words += n
        if self._opened["a"]:
            self._block.linked += n

    def _start_tag(self, name: str, attributes: str) -> None:
        if name in BLOCKS:
            self._block = None
            self._imply_ends(name)
            self.sequence.append(name)
        elif name == "br" and self._block is not None:
            self._block.texts.append(" ")
        if name in VOID or (attributes.endswith("/") and name not in BLOCKS):
            return
        number, parent = len(self.elements), self.elements[self._open[-1]]
        kind = aside_kind(name, attributes) if name in BLOCKS else 0
        if name == "header" and parent.marks:
            kind = UNSURE
        if name == "h1" or (name in MARKS and not kind):
            self._content_inside()
        marks = parent.marks | {name} if name in MARKS else parent.marks
        aside = parent.aside if parent.aside >= 0 else number if kind else -1
        self.elements.append(Element(name, self._open[-1], number if name in BLOCKS else parent.block, len(self._open), kind, aside, marks, len(self.blocks)))
        self._open.append(number)
        self._opened[name] += 1

    def _content_inside(self) -> None:
        """What is open and was taken for no content by a doubtful name holds the heading or the mark: it is content."""
        while (outer := self.elements[self._open[-1]].aside) >= 0 and self.elements[outer].kind == UNSURE:
            self.elements[outer].kind = 0
            for number in range(outer, len(self.elements)):
                own = self.elements[number]
                around = self.elements[own.parent].aside
                own.aside = around if around >= 0 else number if own.kind else -1
            for block in self.blocks[self.elements[outer].first :]:
                block.aside = self.elements[block.parent].aside

    def _imply_ends(self, name: str) -> None:
        """A block tag ends an open paragraph, an item of a list or table the item before it."""
        ends, within = ITEMS.get(name, ((), ()))
        if any(self._opened[e] for e in ends):
            for depth in range(len(self._open) - 1, 0, -1):
                own = self.elements[self._open[depth]].name
                if own in within:
                    break
                if own in ends:
                    self._close_to(depth)
                    break
        block = self.elements[self.elements[self._open[-1]].block]
        if block.name in PARAGRAPH:
            self._close_to(block.depth)

    def _end_tag(self, name: str) -> None:
        if name in BLOCKS:
            self._block = None
            self.sequence.append(name)
        if not self._opened[name]:
            return
        for depth in range(len(self._open) - 1, 0, -1):
            own = self.elements[self._open[depth]].name
            if own == name:
                self._close_to(depth)
                return
            # The end of what stands inside a block never closes the block.
            if name not in BLOCKS and own in BLOCKS:
                return

    def _close_to(self, depth: int) -> None:
        while len(self._open) > depth:
            element = self.elements[self._open.pop()]
            element.last = len(self.blocks)
            self._opened[element.name] -= 1
            if element.name in BLOCKS:
                self._block = None

    # ---- scoring

    def marked(self) -> Element | None:
        """The element by which the page marks its main text: the only article, or else the only main element, with words."""
        for name in MARKS:
            found = [e for e in self.elements if e.name == name and e.aside < 0 and name not in self.elements[e.parent].marks]
            if len(found) == 1:
                inside = self.blocks[found[0].first : found[0].last]
                return found[0] if any(b.words and b.aside < 0 for b in inside) else None
        return None

    def observations(self) -> Iterator[tuple[str, bool, int]]:
        """Of a labelled page each kind of token, whether it lies inside the mark, and how many there are."""
        mark = self.marked()
        if mark is None:
            return
        at = 0
        for token in self.sequence:
            if isinstance(token, int):
                block, at = self.blocks[token], token + 1
                if block.aside < 0 and block.words:
                    yield f"word {block.shape()}", mark.first <= token < mark.last, block.words
            elif token not in MARKS:
                yield f"tag {token}", mark.first < at < mark.last, 1

    def scores(self, weights: dict[str, float]) -> list[tuple[float, int]]:
        """Score of every token in page order, with the number of its block (-1: a tag)."""
        out, seen, mark = [], -1, self.marked()
        for token in self.sequence:
            if not isinstance(token, int):
                if token not in MARKS:
                    out.append((tag_weight(token, weights), -1))
                continue
            block = self.blocks[token]
            if block.aside >= 0:
                # Once for the whole element, however long.
                if block.aside != seen:
                    seen = block.aside
                    out.append((-TAG_LIMIT, -1))
            elif mark and not mark.first <= token < mark.last:
                out.append((-WORD_LIMIT * block.words, token))
            else:
                out.append((block.words * word_weight(block, weights), token))
        return out

    def region(self, weights: dict[str, float]) -> tuple[int, int]:
        """First block of the best run, and the one after its last."""
        best, best_run, total, first = 0.0, (0, 0), 0.0, -1
        for score, block in self.scores(weights):
            if total <= 0:
                total, first = 0.0, -1
            total += score
            if block >= 0:
                first = block if first < 0 else first
                if total > best:
                    best, best_run = total, (first, block + 1)
        return best_run

    def holder(self, low: int, high: int) -> int:
        """Lowest element that holds the blocks ``low`` to ``high``."""
        at = self._container(self.blocks[low])
        while not (self.elements[at].first <= low and high <= self.elements[at].last):
            at = self.elements[at].parent
        return at

    def _container(self, block: Block) -> int:
        """Element whose children a block and those beside it are."""
        own = self.elements[block.parent]
        return block.parent if block.kind == "text" else own.parent

    def main_text(self, weights: dict[str, float]) -> str:
        low, high = self.region(weights)
        if high <= low:
            return ""
        at = self.holder(low, high)
        holder = self.marked() or self.elements[at]
        if holder.name in ("", "html", "body"):
            first, last = low, high
        else:
            first, last = holder.first, holder.last
        around = {at} | {self._container(b) for b in self.blocks[low:high] if b.aside < 0}
        picked = []
        for number in range(first, last):
            block = self.blocks[number]
            if block.aside >= 0 or not block.words:
                continue
            # Beyond the run only what stands beside its blocks or just below, and is no list of links.
            own = self._container(block)
            beside = own in around or self.elements[own].parent in around
            if low <= number < high or holder.name in MARKS or (beside and 2 * block.linked <= block.words):
                text = block.text()
                if text:
                    picked.append(text)
        return "\n".join(picked)


def aside_kind(name: str, attributes: str) -> int:
    """Whether an element is no content by its name, role, class or id: 0 if not, SURE, or UNSURE."""
    if name in ASIDE:
        return SURE
    if not attributes or name in ("html", "body"):
        return 0
    kind = 0
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next(filter(None, values), "")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and UNSEEN.search(value)):
            return SURE
        if key == "role":
            if value.lower() in ASIDE_ROLES:
                return SURE
        elif key in ("class", "id"):
            words = set(PART.findall(CAMEL.sub(" ", value).lower()))
            if name in MARKS:
                kind = kind or (SURE if words & REPLY_WORDS else 0)
            elif words & ASIDE_WORDS:
                kind = max(kind, UNSURE if words & CONTENT_WORDS else SURE)
    return kind


def prior(feature: str) -> float:
    """Weight before any page is seen: words count for content, the more the longer their block, unless they are links."""
    what, _, rest = feature.partition(" ")
    if what == "tag":
        return -0.5 if rest in PARAGRAPH or rest in ("li", "blockquote", "pre", "td", "tr") else -1.5
    block, length, linked = rest.split(":")
    if linked == "2":
        return -2.0
    base = {"p": 1.0, "blockquote": 1.0, "pre": 1.0, "heading": 0.5}.get(block, 0.0)
    return base + 0.3 * (int(length) - 2) - (0.3 if linked == "1" else 0.0)


def word_weight(block: Block, weights: dict[str, float]) -> float:
    feature = f"word {block.shape()}"
    known = weights.get(feature)
    return known if known is not None else prior(feature)


def tag_weight(name: str, weights: dict[str, float]) -> float:
    known = weights.get(f"tag {name}")
    return known if known is not None else prior(f"tag {name}")


def count_features(pages: DataFrame, markup: str = "html") -> DataFrame:
    """Per kind of token (``feature``) the labelled ``pages`` that have it, and the sum of the shares of it ``inside`` the mark."""
    schema = pa.schema([("feature", pa.string()), ("inside", pa.float64()), ("pages", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter[str] = Counter()
        pages_of: Counter[str] = Counter()
        for (text,) in records(batches, markup):
            own: Counter[str] = Counter()
            hit: Counter[str] = Counter()
            for feature, within, n in Page(text or "").observations():
                own[feature] += n
                hit[feature] += n if within else 0
            for feature, n in own.items():
                inside[feature] += hit[feature] / n
                pages_of[feature] += 1
        # Kinds of words are few; tags of a name that no standard knows are as many as pages make up.
        for start in range(0, len(names := list(pages_of)), 50_000):
            part = names[start : start + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([float(inside[f]) for f in part]), pa.array([pages_of[f] for f in part])], schema=schema)

    counted = pages.select(markup).mapInArrow(run, "feature string, inside double, pages bigint")
    return counted.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("pages").alias("pages"))


#: Tags whose weights are learned; others keep the prior, which bounds what is sent to the tasks.
LEARNED_TAGS = sorted(BLOCKS - ASIDE - set(MARKS))


def learn_weights(pages: DataFrame, markup: str = "html") -> dict[str, float]:
    """Weights of words and tags from all labelled pages."""
    learned = F.col("feature").startswith("word ") | F.col("feature").isin([f"tag {t}" for t in LEARNED_TAGS])
    weights = {}
    for row in count_features(pages, markup).where(learned).collect():  # some hundred kinds of tokens
        before = prior(row.feature)
        share = 1 / (1 + math.exp(-before))
        odds = (row.inside + PRIOR_PAGES * share) / (row.pages - row.inside + PRIOR_PAGES * (1 - share))
        weight = math.log(odds)
        if row.feature.startswith("tag "):
            weights[row.feature] = round(min(-TAG_LEAST, max(-TAG_LIMIT, weight)), 6)
        else:
            weights[row.feature] = round(min(WORD_LIMIT, max(-WORD_LIMIT, weight)), 6)
    return weights


def extract(pages: DataFrame, weights: dict[str, float], markup: str = "html") -> DataFrame:
    """``page_id``, ``url`` and the main ``text`` of every page."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for page_id, url, held in records(batches, "page_id", "url", markup):
                text = Page(held or "").main_text(weights)
                yield (page_id, url, text), len(text)

        return emit(rows(), schema)

    return pages.select(F.col("page_id").cast("long"), "url", markup).mapInArrow(run, "page_id bigint, url string, text string")


@query("op13_extraction")
def op13_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, learn_weights(pages)).withColumn("n_chars", F.length("text").cast("long"))
