"""The main text of web pages by the ratios of their tag paths.

A page is read into blocks of text, each with the path of tags from the root to it. Paths whose blocks are
long, punctuated and not links are prose; menus and notes are not. For each path the length of text and the
punctuation of a block are taken over all its blocks, smoothed over neighbouring blocks of one container in
page order, fused with the share of text outside of links, blended with the mean of the container, and
compared with a threshold that follows the spread of the page; blocks of the paths above it are the text. So a
short paragraph stays that shares its path with long ones, and a heading that stands among them.

Some parts are no article by what they say they are: tags, roles and class names for menus, headers, footers,
sidebars, notices, adverts, forms and comments. They are left out before paths are measured. A class name
counts for nothing on a wrapper around an article, a form for nothing if it holds most of the page, and where
the page has exactly one article (or else one main part), paths outside of it score 0.

Pages are read as browsers do: end tags may be missing, quotes open, comments unclosed. White space, non-breaking
space included, is one space; a line break is white space. The time grows with the length of the page.

Null pages and pages without text give an empty text; repeated rows are extracted each, other columns are left
alone. An empty table gives no rows.
"""

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.arrow_text import map_batches

# Share of the best path's score that a path needs, whatever the spread; more than the second is never asked for.
LEAST_SCORE = 0.3
MOST_SCORE = 0.5
# Weights of a block and its neighbours.
KERNEL = (1, 4, 6, 4, 1)
# How much of a path's score is the mean of its container.
CONTAINER_SHARE = 0.5
PUNCTUATION = ".,;:!?…¿¡。、，！？；："

# Tags by their part in HTML.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table caption "
    "tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no text of the page up to their end tag.
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
LEFT_OUT = frozenset(
    "aside audio button canvas datalist dialog footer map menu meter nav noscript object progress select svg template "
    "video".split()
)
CONTAINERS = frozenset("body center div form section td th".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split()
)
# Class names and ids of parts that are no article; the second kind also on an article.
SIDE_WORDS = frozenset(
    "alert aside banner breadcrumb breadcrumbs consent cookie cookies copyright footer gdpr login masthead menu modal nav "
    "navbar navigation newsletter notice notification overlay pager pagination popup recommended related search share "
    "sharebar sharing sidebar signup skip social subscribe subscription toast toolbar topbar widget".split()
)
FOREIGN_WORDS = frozenset(
    "ad ads adsense adslot advert advertisement advertisements advertising adverts comment commentlist comments disqus "
    "promo promoted promotion replies reply respond sponsor sponsored".split()
)
# A header with one of these is the article's own.
OWN_WORDS = frozenset("article content entry main post section story title".split())
# With one of these a word tells of another part of the page.
ABOUT_WORDS = frozenset("has no with without".split())

# A tag, comment or declaration. Quotes count after an equals sign only.
_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>|<[!?/][^>]*>", re.DOTALL
)
_NAMED = re.compile(
    r"(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE
)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE) for tag in sorted(RAW)}
# An element that starts ends these, as far up as the second set.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody"}, {"table"}), "tfoot": ({"thead", "tbody"}, {"table"}), "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()), "article": ({"nav", "header"}, {"article", "main", "aside"}),
    "main": ({"nav", "header"}, {"article", "aside"}),
}


class Element:
    """An open or closed element: its path, and why its text may not count."""

    __slots__ = ("chars", "container", "foreign", "form", "hint", "parent", "path", "semantic", "tag", "wraps")

    def __init__(self, tag: str, parent: "Element | None", path: int) -> None:
        self.tag, self.parent, self.path = tag, parent, path
        self.foreign = parent is not None and parent.foreign
        # The nearest element that its class names put aside, unless it wraps an article; the nearest form.
        self.hint = parent.hint if parent else None
        self.form = parent.form if parent else None
        self.semantic = parent.semantic if parent else None
        self.container = parent.container if parent else self
        self.wraps, self.chars = False, 0


class Block:
    __slots__ = ("chars", "element", "link", "text")

    def __init__(self, element: Element, text: str, link: int) -> None:
        self.element, self.text, self.chars, self.link = element, text, len(text), link


def _attributes(written: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(written)} if written else {}


def _names(attributes: dict[str, str]) -> list[str]:
    return [w.lower() for key in ("class", "id") for w in _WORDS.findall(attributes.get(key, ""))]


class Page:
    """The blocks of a page and their elements."""

    def __init__(self, source: str) -> None:
        self.blocks: list[Block] = []
        self._paths: dict[tuple[int, str], int] = {}
        self._open = [Element("", None, 0)]
        self._count: dict[str, int] = {}
        self._text: list[str] = []
        self._link_text: list[str] = []
        # How many elements were open when the link began; 0 outside of links.
        self._link = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, end = 0, source.rfind(">") + 1
        while True:
            tag = _TAG.search(source, at, end)
            if tag is None:
                break
            self._say(source[at : tag.start()])
            at = tag.end()
            name = (tag[2] or "").lower()
            if not name:
                continue
            if tag[1]:
                self._close(name)
            elif name in RAW:
                stop = _END[name].search(source, at)
                # As in browsers a script runs to the end; the page survives a title without one.
                at = stop.end() if stop else (len(source) if name in ("script", "style") else at)
            else:
                self._start(name, tag[3])
        rest = source[at:]
        # What is left of a tag that never ends is no text.
        cut = re.search(r"<[a-zA-Z/!?]", rest)
        self._say(rest[: cut.start()] if cut else rest)
        self._flush()

    def _say(self, text: str) -> None:
        if not text or self._open[-1].foreign:
            return
        text = html.unescape(text) if "&" in text else text
        self._text.append(text)
        if self._link:
            self._link_text.append(text)

    def _flush(self) -> None:
        """End the block."""
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                link = len(" ".join("".join(self._link_text).split()))
                self.blocks.append(Block(self._holder(), text, link))
            self._text, self._link_text = [], []

    def _holder(self) -> Element:
        """The innermost open block."""
        at = len(self._open) - 1
        while at and self._open[at].tag not in BLOCKS and "-" not in self._open[at].tag:
            at -= 1
        return self._open[at]

    def _pop(self) -> None:
        tag = self._open.pop().tag
        self._count[tag] -= 1
        if self._link > len(self._open):
            self._link = 0

    def _close(self, name: str) -> None:
        if name == "a":
            self._link = 0
        if name in BLOCKS or "-" in name:
            self._flush()
        if self._count.get(name):
            while self._open[-1].tag != name:
                self._pop()
            self._pop()

    def _start(self, name: str, written: str) -> None:
        if name == "br":
            self._say(" ")
        elif name == "a":
            self._link = len(self._open)
        block = name in BLOCKS or "-" in name
        if block:
            self._flush()
            self._end_implied(name)
        if name in VOID or written.endswith("/") and not block:
            return
        attributes = _attributes(written)
        if block or name in LEFT_OUT or name not in ("html", "body") and self._is_side(name, attributes):
            self._push(name, attributes, block)

    def _end_implied(self, name: str) -> None:
        # A span that is put aside ends with its line.
        while self._open[-1].parent and self._open[-1].tag not in BLOCKS | LEFT_OUT and "-" not in self._open[-1].tag:
            self._pop()
        top = self._open[-1].tag
        if top == "p" or top in HEADINGS and name in HEADINGS:
            self._pop()
        if name in _CLOSES:
            ends, within = _CLOSES[name]
            if any(self._count.get(tag) for tag in ends):
                at = len(self._open) - 1
                while at and self._open[at].tag not in ends and self._open[at].tag not in within:
                    at -= 1
                if at and self._open[at].tag in ends:
                    while len(self._open) > at:
                        self._pop()

    def _push(self, name: str, attributes: dict[str, str], block: bool) -> None:
        parent = self._open[-1]
        label = name
        if name in CONTAINERS or name in ("article", "main", "ul", "ol", "table"):
            label = " ".join([name, *_WORDS.findall(attributes.get("class", ""))])
        path = self._paths.setdefault((parent.path, label), len(self._paths) + 1) if block else parent.path
        element = Element(name, parent, path)
        self._open.append(element)
        self._count[name] = self._count.get(name, 0) + 1
        if not block or name in LEFT_OUT or name == "header" and parent.semantic is None or self._is_foreign(name, attributes):
            element.foreign = True
        elif name == "form":
            element.form = element
        elif name not in ("html", "body", "article", "main") and self._is_side(name, attributes):
            element.hint = element
        if name in ("article", "main"):
            outer = element.hint
            while outer is not None and not outer.wraps:
                outer.wraps = True
                outer = outer.parent.hint if outer.parent else None
            if parent.semantic is None or parent.semantic.tag == "main" and name == "article":
                element.semantic = element
            element.container = element
        elif (name in CONTAINERS or "-" in name) and element.semantic is None:
            element.container = element

    @staticmethod
    def _is_foreign(name: str, attributes: dict[str, str]) -> bool:
        if not attributes or name in ("html", "body"):
            return False
        if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
            return True
        if "display:none" in attributes.get("style", "").lower().replace(" ", ""):
            return True
        words = _names(attributes)
        return ABOUT_WORDS.isdisjoint(words) and not FOREIGN_WORDS.isdisjoint(words)

    @staticmethod
    def _is_side(name: str, attributes: dict[str, str]) -> bool:
        if not attributes:
            return False
        if attributes.get("role", "").lower() in ROLES or Page._is_foreign(name, attributes):
            return True
        words = _names(attributes)
        if not ABOUT_WORDS.isdisjoint(words):
            return False
        return not SIDE_WORDS.isdisjoint(words) or "header" in words and OWN_WORDS.isdisjoint(words)


def _put_aside(element: Element, known: dict[int, bool]) -> bool:
    """Whether class names or roles put the element aside; ``known`` says it of elements that do so."""
    hint, seen = element.hint, []
    while hint is not None and hint.wraps and id(hint) not in known:
        seen.append(id(hint))
        hint = hint.parent.hint if hint.parent else None
    aside = hint is not None and known.get(id(hint), True)
    known.update(dict.fromkeys(seen, aside))
    return aside


def _candidates(page: Page) -> list[Block]:
    """The blocks that may be of the article."""
    known: dict[int, bool] = {}
    left = [b for b in page.blocks if not b.element.foreign and not _put_aside(b.element, known)]
    for block in left:
        if block.element.form is not None:
            block.element.form.chars += block.chars
    most = sum(b.chars for b in left) / 2
    left = [b for b in left if b.element.form is None or b.element.form.chars > most]
    for tag in ("article", "main"):
        parts = {id(b.element.semantic) for b in left if b.element.semantic is not None and b.element.semantic.tag == tag}
        if len(parts) == 1:
            return [b for b in left if id(b.element.semantic) in parts]
    return left


def _smoothed(values: list[float]) -> list[float]:
    """Each value averaged with its neighbours."""
    reach, n = len(KERNEL) // 2, len(values)
    made = []
    for i in range(n):
        near = [(KERNEL[j - i + reach], values[j]) for j in range(max(i - reach, 0), min(i + reach + 1, n))]
        made.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return made


def _path_scores(blocks: list[Block]) -> dict[int, float]:
    """The score of each tag path, from 0 to 1."""
    sums: dict[int, list[float]] = {}
    for b in blocks:
        own = sums.setdefault(b.element.path, [0, 0, 0, 0])
        own[0] += 1
        own[1] += b.chars
        own[2] += sum(map(b.text.count, PUNCTUATION))
        own[3] += 0 if b.element.tag in HEADINGS else b.link
    length = {path: chars / n for path, (n, chars, _, _) in sums.items()}
    marks = {path: punctuation / n for path, (n, _, punctuation, _) in sums.items()}
    prose = {path: 1 - min(link / chars, 1) for path, (_, chars, _, link) in sums.items()}
    # Smooth within each container, in page order; a path's value is the mean over its blocks.
    runs: dict[int, list[Block]] = {}
    for b in blocks:
        runs.setdefault(id(b.element.container), []).append(b)
    smooth = {path: [0.0, 0.0] for path in sums}
    for run in runs.values():
        paths = [b.element.path for b in run]
        for kind, ratio in enumerate((length, marks)):
            for path, value in zip(paths, _smoothed([ratio[p] * prose[p] for p in paths]), strict=True):
                smooth[path][kind] += value / sums[path][0]
    longest = max(s[0] for s in smooth.values()) or 1
    marked = max(s[1] for s in smooth.values())
    own = {path: ((s[0] / longest) * (s[1] + 1) / (marked + 1)) ** 0.5 * prose[path] for path, s in smooth.items()}
    # Blend with the container, weighted by text.
    means: dict[int, list[float]] = {}
    for b in blocks:
        mean = means.setdefault(b.element.container.path, [0, 0])
        mean[0] += own[b.element.path] * b.chars
        mean[1] += b.chars
    return {
        b.element.path: prose[b.element.path] * (
            (1 - CONTAINER_SHARE) * own[b.element.path]
            + CONTAINER_SHARE * means[b.element.container.path][0] / means[b.element.container.path][1]
        )
        for b in blocks
    }


def main_text(source: str | None) -> str:
    """The article of a page: its blocks in page order, with an empty line between them."""
    blocks = _candidates(Page(source or ""))
    if not blocks:
        return ""
    scores = _path_scores(blocks)
    values = [scores[b.element.path] for b in blocks]
    mean = sum(values) / len(values)
    spread = (sum((v - mean) ** 2 for v in values) / len(values)) ** 0.5
    best = max(values)
    least = min(max(spread, LEAST_SCORE * best), MOST_SCORE * best)
    return "\n\n".join(b.text for b, value in zip(blocks, values, strict=True) if value >= least and value > 0)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """page_id, url, ``text`` and ``n_chars`` of each page."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = pa.array((main_text(source.as_py()) for source in batch.column(2)), pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], ["page_id", "url", "text"])

    kept = pages.select("page_id", "url", F.col(column).alias("html"))
    types = ", ".join(f"{name} {kept.schema[name].dataType.simpleString()}" for name in ("page_id", "url"))
    return map_batches(kept, run, f"{types}, text string").withColumn("n_chars", F.length("text").cast("bigint"))
