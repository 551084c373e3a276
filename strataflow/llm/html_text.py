"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags.  First pass: link density, length and stop-word density
decide a block (content or boilerplate) or leave it open (short or in between).  Second pass: an open
block takes the label of its nearest decided neighbour, a heading that of what follows it.  The page's own
markup comes before both: what stands in menus, footers, forms, adverts or comments is boilerplate,
and blocks inside the article element start as content, whatever their length.  A form, or a wrapper that
only tells its layout (``has-sidebar``), is beside the article only if it holds neither an article nor content; an
article inside any wrapper starts afresh, and where the wrapper is a named part it counts if no other does.

Tags are cut by a tokenizer of its own, and what stands around a block is kept up to date as elements open and close, so a
page of any shape takes time in proportion to its length.  Pages stream through Arrow batches in place; a page is held
by one task, one at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from strataflow.llm.common import col

# Elements that begin a new block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose text is never shown as text of the article.
UNSEEN = frozenset(
    "script style noscript template head title svg annotation annotation-xml iframe object audio video canvas select option "
    "textarea button datalist".split()
)
# Elements and words in class, id or role that mark parts of a page beside its article.
BESIDE = frozenset("nav footer aside form dialog menu".split())
BESIDE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|banner|sponsor(?:ed)?|promo|nav|navbar|navigation|menu|breadcrumbs?|"
    r"sidebar|side-bar|footer|comments?|comment-list|disqus|replies|respond|cookies?|consent|notices?|notifications?|"
    r"newsletter|subscribe|signup|login|share|sharing|social|related|recommended|popup|modal|widget|toolbar|"
    r"pagination|pager|masthead|complementary|contentinfo|search)(?:$|[\s_-])",
    re.I,
)
# Elements whose class, id or role says what a part of the page is; those of headings, paragraphs and words do not.
CONTAINERS = frozenset("div section ul ol dl aside table center details fieldset nav header footer article main".split())
# Inside an article only these words count as a part of a name (others must be the whole name).
CLEAR_WORDS = re.compile(
    r"(?:^|[_-])(?:adverts?|advertisement|sponsor(?:ed)?|promo|nav|navbar|navigation|breadcrumbs?|sidebar|side-bar|footer|comments?|"
    r"comment-list|disqus|cookies?|consent|newsletter|popup|modal|widget|toolbar|pagination|pager|masthead)(?:$|[_-])",
    re.I,
)
# With one of these words, or with a listed word after the first, a name tells how a wrapper is laid out.
LAYOUT_WORDS = frozenset("layout page template enabled active open".split())
MAIN = frozenset("article main".split())
MAIN_WORDS = re.compile(
    r"(?:^|[\s_-])(?:article|article-body|post|post-content|entry|entry-content|story|main-content)(?:$|[\s_-])", re.I
)
# An opening tag of the key ends an open element of the values (their end tags may be left out).
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
# Frequent small words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    "the of and to a in is that it for on with as was be by this are or from at an not have but his they you "
    "der die das und in zu den mit von ist des sich auf für ein eine nicht als im dem auch es an werden aus er hat dass "
    "le la les de des et en un une du est que qui dans pour pas au sur par plus ne se ce il avec "
    "el los las y que en del se por un una con no para es al lo como más su".split()
)

# Blocks of nothing but such words stand at the foot of a page.
FOOT = re.compile(
    r"(?:imprint|impressum|legal notice|mentions légales|aviso legal|privacy(?: policy)?|datenschutz|terms(?: of (?:use|service))?|"
    r"contact|kontakt|copyright|all rights reserved)\W*|(?:copyright\s*)?(?:©|\(c\)).{0,80}",
    re.I,
)

LENGTH_SHORT, LENGTH_LONG = 70, 200
#: Share of stop words on a page under which its language is not one of theirs.
STOP_KNOWN = 0.05
STOP_LOW, STOP_HIGH = 0.15, 0.25
LINK_HIGH = 0.33

_SPACE = re.compile(r"\s+")
_WORD = re.compile(r"\w+")


class Mark:
    """An element that looks like a part beside the article, and the one around it within the same article."""

    __slots__ = ("kind", "around", "holds", "only_hints", "only_named", "under_element", "under_named", "told", "_unheld")

    def __init__(self, kind: str, around: Mark | None) -> None:
        self.kind = kind  # element: aside by its tag; named: by a name of its own; hint: a form, or a wrapper's layout
        self.around = around
        self.holds = False  # an article or content after all
        self.only_hints = kind == "hint" and (around is None or around.only_hints)
        self.only_named = kind in ("hint", "named") and (around is None or around.only_named)
        self.under_element = kind == "element" or (around is not None and around.under_element)
        self.under_named = kind == "named" or (around is not None and around.under_named)
        self.told = False  # that all hints from here outwards hold an article
        self._unheld: Mark | None = self

    def unheld(self) -> Mark | None:
        """The nearest mark from here outwards that holds nothing; what lies between is skipped the next time."""
        passed, mark = [], self
        while mark is not None and mark.holds:
            passed.append(mark)
            mark = mark._unheld if mark._unheld is not mark else mark.around
        for p in passed:
            p._unheld = mark
        return mark

    def hold_all(self) -> None:
        """All marks from here outwards hold content."""
        mark = self.unheld()
        while mark is not None:
            mark.holds = True
            mark = mark.unheld()

    def tell_hints(self) -> None:
        """All hints from here outwards hold an article."""
        mark: Mark | None = self
        while mark is not None and not mark.told:
            mark.told = True
            mark.holds |= mark.kind == "hint"
            mark = mark.around


def named_beside(names: str, inside: bool = False) -> str:
    """named, hint or nothing, by the words of class, id and role.  Inside an article a name counts if it is a listed word as
    a whole, or has one that means nothing else."""
    found = ""
    for name in names.split():
        hit = BESIDE_WORDS.search(name)
        if hit and inside and hit.span() != (0, len(name)):
            hit = CLEAR_WORDS.search(name)
        if hit and hit.start() == 0 and LAYOUT_WORDS.isdisjoint(re.split("[_-]", name.lower())):
            return "named"
        found = "hint" if hit else found
    return found


@dataclass
class Block:
    """A run of text between block-level tags."""

    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    inside: bool = False  # of the article
    mark: Mark | None = None  # the innermost one around it, opened within its innermost article
    second: bool = False  # in an article inside a part that is named as beside
    heading: bool = False
    _text: str | None = None

    @property
    def beside(self) -> bool:
        """In a part that is not the article."""
        return self.mark is not None and self.mark.unheld() is not None

    def text(self) -> str:
        if self._text is None:
            self._text = _SPACE.sub(" ", "".join(self.parts)).strip()
        return self._text


_TAG = re.compile(r"</?[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*(?:([^\s/>=][^\s/>=]*)(\s*=\s*)?|(=))")
_VALUE = re.compile(r"[^\s>]*")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in ("script", "style")}


def tokens(html: str) -> Iterator[tuple[str, str, Mapping[str, str]]]:
    """(kind, text or tag, attributes) of a page: data, start, empty (a tag that ends itself), end.

    Comments, declarations and processing instructions are passed over; an unclosed one ends at the next ``>``, as does a
    tag with an unclosed quote.  A ``<`` that begins nothing is text.  Every character is looked at a bounded number of times."""
    at, n = 0, len(html)
    last, last_comment = html.rfind(">"), html.rfind("-->")
    quotes = {q: html.rfind(q) for q in "\"'"}
    simple = False  # a tag ran to the end of the page: from there on tags end at the next >
    while at < n:
        begin = html.find("<", at)
        if begin < 0 or begin > last:
            end = html.find("<!--", at)  # a page that ends within a comment
            yield "data", unescape(html[at:] if end < 0 else html[at:end]), {}
            return
        mark = html[begin + 1 : begin + 2]
        tag = _TAG.match(html, begin) if mark.isalpha() or mark == "/" else None
        if tag is None and mark not in ("!", "?", "/"):
            end = html.find("<", begin + 1)
            end = n if end < 0 else end
            yield "data", unescape(html[at:end]), {}
            at = end
            continue
        if begin > at:
            yield "data", unescape(html[at:begin]), {}
        if tag is None:
            if html.startswith("<!-->", begin) or html.startswith("<!--->", begin):
                at = html.index(">", begin) + 1
            elif html.startswith("<!--", begin) and begin + 4 <= last_comment:
                at = html.index("-->", begin + 4) + 3
            else:
                at = html.index(">", begin) + 1
            continue
        name, end = tag[0].lstrip("</").lower(), tag.end()
        attributes: dict[str, str] = {}
        if simple:
            end = html.index(">", end)
        else:
            while end < n:
                found = _ATTRIBUTE.match(html, end)
                if found is None:
                    break
                end = found.end()
                if found[2]:
                    quote = html[end : end + 1]
                    if quotes.get(quote, -1) > end:
                        stop = html.index(quote, end + 1)
                        value, end = html[end + 1 : stop], stop + 1
                    else:
                        value = _VALUE.match(html, end)[0]
                        end += len(value)
                    attributes.setdefault(found[1].lower(), value)
                elif found[1]:
                    attributes.setdefault(found[1].lower(), "")
            spaces = re.compile(r"[\s/]*").match(html, end)
            end = spaces.end()
            if end >= n:
                simple = True
                end = html.index(">", tag.end())
        closed = html[end - 1] == "/"
        at = end + 1
        if tag[0][1] == "/":
            yield "end", name, {}
            continue
        yield "empty" if closed else "start", name, attributes
        if name in _RAW_END and not closed:
            stop = _RAW_END[name].search(html, at)
            at = stop.start() if stop else n


class _Open:
    """An open element: its tag, what it means, its mark, and how many block-level elements were open before it."""

    __slots__ = ("tag", "meaning", "mark", "blocks_before", "inner", "alive")

    def __init__(self, tag: str, meaning: str, mark: Mark | None, blocks_before: int, inner: Mark | None) -> None:
        self.tag, self.meaning, self.mark, self.blocks_before, self.inner, self.alive = tag, meaning, mark, blocks_before, inner, True


class _Blocks:
    """Cuts a page into blocks; tolerant of missing end tags."""

    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.open: list[_Open] = []
        self.of_tag: dict[str, list[_Open]] = {}
        self.count: Counter[str] = Counter()  # open elements by what they mean
        self.open_blocks = 0
        self.inner: Mark | None = None  # the innermost mark within the innermost article
        self.block = Block()

    def _meaning(self, tag: str, attrs: Mapping[str, str]) -> str:
        if tag in UNSEEN:
            return "unseen"
        if not attrs and tag not in BESIDE and tag not in MAIN and tag != "header":
            return ""
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", ""), re.I):
            return "unseen"
        named = unescape(" ".join(attrs.get(k, "") for k in ("class", "id", "role"))) if tag in CONTAINERS else ""
        if tag == "form":
            return "hint"
        inside = self.count["main"] + self.count["fresh"] > 0
        if tag in BESIDE or (tag == "header" and not inside):
            return "element"
        kind = named_beside(named, inside)
        if tag in MAIN:
            # a comment or a teaser among others is an article element too: its own name tells
            inner = self.inner
            return "main" if inner and (inner.under_element or (inner.under_named and kind == "named")) else "fresh"
        if kind:
            return kind
        if named.strip() and MAIN_WORDS.search(named):
            return "main"
        return ""

    def _cut(self, heading: bool = False) -> None:
        if self.block.parts:
            self.blocks.append(self.block)
        self.block = Block(heading=heading)

    def start(self, tag: str, attrs: Mapping[str, str]) -> None:
        if tag == "br":
            if self.block.parts:
                self.block.parts.append(" ")
            return
        for other in CLOSES.get(tag, ()):
            if self.open and self.open[-1].tag == other:
                self.end(other)
        if tag in BLOCKS:
            if tag != "title" and self.of_tag.get("head"):
                self.end("head")  # its end tag may be left out
            if self.open and self.open[-1].tag == "p":  # a block-level tag ends a paragraph
                self.end("p")
            self._cut(tag[0] == "h" and tag[1:].isdigit())
        if tag in VOID:
            return
        meaning = self._meaning(tag, attrs)
        outer, mark = self.inner, None
        if meaning == "fresh":
            if self.inner:
                self.inner.tell_hints()
            self.inner = None
        elif meaning in ("element", "named", "hint"):
            self.inner = mark = Mark(meaning, self.inner)
        entry = _Open(tag, meaning, mark, self.open_blocks, outer)
        self.open.append(entry)
        self.of_tag.setdefault(tag, []).append(entry)
        self.open_blocks += tag in BLOCKS
        self.count[meaning] += 1
        self.count["a"] += tag == "a"

    def _close(self, entry: _Open) -> None:
        self.of_tag[entry.tag].pop()
        self.open_blocks -= entry.tag in BLOCKS
        self.count[entry.meaning] -= 1
        self.count["a"] -= entry.tag == "a"
        entry.alive = False

    def end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._cut()
        if not self.of_tag.get(tag):
            return
        entry = self.of_tag[tag][-1]
        if tag not in BLOCKS and self.open_blocks > entry.blocks_before:
            self._close(entry)  # an inline element left open around blocks: only it goes
            return
        while True:
            last = self.open.pop()
            if last.alive:
                self._close(last)
                self.inner = last.inner
            if last is entry:
                break
        while self.open and not self.open[-1].alive:
            self.open.pop()

    def data(self, text: str) -> None:
        if self.count["unseen"] > 0 or not text:
            return
        block = self.block
        if not block.parts:
            block.inside = self.count["main"] + self.count["fresh"] > 0
            block.mark, block.second = self.inner, self.count["named"] > 0
        block.parts.append(text)
        if self.count["a"] > 0:
            block.link_chars += len(text.strip())


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page that have text."""
    page = _Blocks()
    for kind, what, attributes in tokens(html):
        if kind == "data":
            page.data(what)
        elif kind == "end":
            page.end(what)
        else:
            page.start(what, attributes)
            if kind == "empty" and what == "svg":
                page.end(what)
    page._cut()
    return [b for b in page.blocks if b.text()]


def first_pass(block: Block) -> str:
    """content, boilerplate, or open (short, or in between)."""
    if block.beside:
        return "boilerplate"
    if block.inside:
        return "content"
    return text_label(block)


def _linked(block: Block, text: str) -> bool:
    return block.link_chars > LINK_HIGH * len(text)


def text_label(block: Block) -> str:
    """The label by the block's text alone."""
    text = block.text()
    if _linked(block, text) or FOOT.fullmatch(text):
        return "boilerplate"
    if len(text) < LENGTH_SHORT or block.heading:
        return "open"
    words = _WORD.findall(text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if stops >= STOP_HIGH:
        return "content" if len(text) > LENGTH_LONG else "open"
    if stops >= STOP_LOW and len(text) > LENGTH_LONG:
        return "content"
    return "open" if stops >= STOP_LOW or len(text) > LENGTH_LONG else "boilerplate"


def settled(blocks: list[Block], labels: list[str]) -> list[str]:
    """Open blocks take the label of the nearest decided neighbour, counted in blocks; content on a tie.

    The ends of a page decide nothing.  A heading takes the label of the block after it.  Where nothing is content, what
    is open is: nothing tells it from the article."""
    if "content" not in labels:
        return ["content" if label == "open" else label for label in labels]
    far = len(labels) + 1
    before, after = [(far, "")] * len(labels), [(far, "")] * len(labels)
    for out, order in ((before, range(len(labels))), (after, range(len(labels) - 1, -1, -1))):
        at, last = None, ""
        for k in order:
            if labels[k] != "open":
                at, last = k, labels[k]
            if at is not None:
                out[k] = abs(k - at), last
    found = []
    for (d, one), (e, other) in zip(before, after):
        found.append("content" if d == e and "content" in (one, other) else one if d <= e else other)
    for k in range(len(labels) - 2, -1, -1):
        if labels[k] == "open" and blocks[k].heading:
            found[k] = found[k + 1]
    return found


def _without_stop_words(blocks: list[Block], labels: list[str]) -> list[str]:
    """On a page in another language, length and links decide alone."""
    texts = [b.text() for b in blocks]
    plain = [not b.beside and not _linked(b, t) and not FOOT.fullmatch(t) for b, t in zip(blocks, texts)]
    words = [w for t, p in zip(texts, plain) if p for w in _WORD.findall(t.lower())]
    if sum(w in STOP_WORDS for w in words) >= STOP_KNOWN * len(words):
        return labels
    free = [p and not b.inside and not b.heading for p, b in zip(plain, blocks)]
    return [("content" if len(t) >= LENGTH_SHORT else "open") if f else label for f, t, label in zip(free, texts, labels)]


def _clear_marks(blocks: list[Block]) -> None:
    """Wrappers that hold content are not beside: forms and layouts always, named parts where nothing else is left."""
    for kinds in ("only_hints", "only_named"):
        for b in blocks:
            if b.beside and getattr(b.mark, kinds) and text_label(b) == "content":
                b.mark.hold_all()
        if any(not b.beside and (b.inside or text_label(b) == "content") for b in blocks):
            break


def main_text(html: str | None) -> str:
    """The main text: content blocks in page order, one line each.  Null and empty pages have none.

    A page with an article element has its text there; elsewhere nothing counts."""
    if not html:
        return ""
    blocks = blocks_of(html)
    _clear_marks(blocks)
    labels = [first_pass(b) for b in blocks]
    if any(b.inside and not b.beside for b in blocks):
        first = any(b.inside and not b.beside and not b.second and not b.heading for b in blocks)
        counts = [b.inside and not (first and b.second) for b in blocks]
        labels = [label if counted else "boilerplate" for counted, label in zip(counts, labels)]
    else:
        labels = _without_stop_words(blocks, labels)
    return "\n".join(b.text() for b, label in zip(blocks, settled(blocks, labels)) if label == "content")


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without the html and with its main text; repeated rows and null ids are rows of their own.

    A column that already has the name of the main text gives way to it."""
    kept = [c for c in pages.columns if c != html and c.lower() != text.lower()]
    chosen = pages.select(*[col(c) for c in kept], col(html))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py()) for h in batch.column(len(kept))], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], texts], names=[*kept, text])

    fields = [f for f in chosen.schema.fields if f.name in kept]
    return chosen.mapInArrow(run, T.StructType([*fields, T.StructField(text, T.StringType())]))
