"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks: runs of text between the borders of block-level elements. A
classifier gives each block a score from its containers and its text, which becomes a
capacity to the source (content) or the sink (boilerplate). Neighbouring blocks and blocks
with a common container are joined by smoothness edges. A maximum flow then gives the
labelling of least total cost. Blocks whose score outweighs all their edges have their label
at once, which is exact, so the flow runs over the doubtful blocks only.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import slices, small_batches

SCHEMA = "page_id long, url string, text string, n_chars long"

BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
#: Elements whose content is no text of the page; one that is never closed lasts to the page's end, as in HTML.
RAW = frozenset("script style template title textarea iframe noframes xmp".split())
#: Ordinary elements, text inside them included, that part words.
SPACE = frozenset("br wbr img input object svg math video audio canvas".split())
#: Inside these no element is raw text; an HTML block ends them.
FOREIGN = frozenset("svg math".split())
CLOSES_P = BLOCK - {"button", "label", "noscript", "option", "optgroup", "legend", "caption"}
#: An opening tag ends an open element of these kinds if it is the innermost block.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"td", "th", "tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOILER_TAGS = frozenset("nav footer aside menu dialog button select search noscript head".split())
#: Words of class, id and role that mark boilerplate, and those that mark content.
BOILER_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts alert breadcrumb breadcrumbs captcha comment comments commentlist consent cookie cookies copyright disclaimer discussion disqus "
    "dropdown feedback footer form gdpr hidden login menu menubar modal nav navbar navigation newsletter notice notification pager pagination paywall popup promo promoted promotion recommended "
    "related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe toc toolbar topbar widget complementary contentinfo".split()
)
#: These mark boilerplate outside of content only; an article may have a header of its own.
HEADER_WORDS = frozenset("banner header masthead".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())
#: Of these, the words that mark inline elements too; others may stand there for other things, as in highlighted code.
INLINE_WORDS = frozenset("ad ads advert advertisement advertising adverts hidden promo promoted sponsor sponsored".split())
#: Terminal costs of containers. What a text itself says is worth less than two neighbours in its container.
BOILER, CONTENT, FAINT = -80, 24, -10
#: Smoothness: next block in the same container, next block elsewhere, next block of a common outer
#: container; between a container that marks boilerplate and one that doesn't.
BESIDE, NEXT, NEAR, ACROSS = 16, 6, 8, 1

_OPEN = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
_STOP = re.compile(r"""[>"']""")
_LEAVES = re.compile(rf"<(?:{'|'.join(sorted(BLOCK))}|/(?:{'|'.join(sorted(FOREIGN))}))(?=[\s/>])", re.I)
_NAMED = re.compile(r"""(?<![\w-])(class|id|role|itemprop|style|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z0-9]+")
_LEGAL = re.compile(r"©|\bcopyright\b|\ball rights reserved\b|\bcookies?\b|\bprivacy policy\b", re.I)
_ENDS = re.compile(r"[.!?…:;][\"'”’»)]*$")


@dataclass
class Box:
    """An open block-level element and what its ancestors and itself say."""

    tag: str
    parent: Box | None
    evidence: int = 0
    content: bool = False
    boiler: bool = False
    #: A form is around it; something else that marks boilerplate is.
    in_form: bool = False
    framed: bool = False


@dataclass
class Block:
    box: Box
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def opened(tag: str, attributes: str, parent: Box | None) -> Box:
    """A box with the evidence of its tag and attributes; content counts once, the nearest form only."""
    box = Box(tag, parent)
    content, boiler, header = False, tag in BOILER_TAGS, tag == "header"
    if tag in ("article", "main"):
        content = True
    if attributes and tag not in ("html", "body"):
        for name, *values in _NAMED.findall(attributes):
            name, value = name.lower(), "".join(values).lower()
            if name == "style":
                boiler |= "display:none" in value.replace(" ", "") or "visibility:hidden" in value.replace(" ", "")
            elif name == "hidden" or name == "aria-hidden":
                boiler |= name == "hidden" or value == "true"
            else:
                for one in value.split():
                    if not one.startswith(("no-", "has-", "with-", "without-")):
                        words = _WORD.findall(one)
                        boiler |= not BOILER_WORDS.isdisjoint(words)
                        header |= not HEADER_WORDS.isdisjoint(words)
                        content |= not CONTENT_WORDS.isdisjoint(words)
    inside = content or bool(parent and parent.content)
    boiler |= header and not inside
    if parent:
        box.content, box.boiler, box.evidence, box.in_form, box.framed = parent.content, parent.boiler, parent.evidence, parent.in_form, parent.framed
    if tag == "form":
        box.evidence += BOILER
        box.boiler = True
    if boiler:
        box.evidence += BOILER if not box.boiler or tag == "form" else BOILER // 2
        box.boiler = True
    elif tag == "main":  # the page itself says what its content is, whatever frame it stands in
        box.evidence, box.content, box.boiler = CONTENT, True, False
    elif content and not box.content:
        # A form around a whole page's content is part of the frame, not of the content.
        box.evidence += CONTENT - (BOILER if parent and parent.in_form and not parent.framed else 0)
        box.content = True
    box.evidence += FAINT * (header and inside)
    box.in_form |= tag == "form"
    box.framed |= tag != "form" and box.boiler and not (parent and parent.boiler)
    return box


def unseen(attributes: str) -> bool:
    """Whether an inline element is hidden or an advert."""
    for name, *values in _NAMED.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "style":
            if "display:none" in value.replace(" ", "") or "visibility:hidden" in value.replace(" ", ""):
                return True
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name in ("class", "id") and any(not INLINE_WORDS.isdisjoint(_WORD.findall(x)) for x in value.split()):
            return True
    return False


class Scanner:
    """Tags of a page, found in one pass: no place is read more than a few times, however malformed the page is."""

    def __init__(self, page: str):
        self.page = page
        #: False once a tag's quoted values would swallow the rest of the page: then quotes mean nothing.
        self.quoted = True
        self.lone: set[str] = set()
        self.found: dict[str, re.Match | None] = {}

    def tag_end(self, start: int) -> int:
        """Where the tag ends whose attributes begin at ``start``, -1 if nowhere. A quote opens a value after = only, if it is closed."""
        page, at = self.page, start
        while self.quoted:
            m = _STOP.search(page, at)
            if m is None:
                self.quoted = False
                break
            if m[0] == ">":
                return m.end()
            at, k = m.end(), m.start() - 1
            while page[k].isspace():
                k -= 1
            if page[k] == "=" and m[0] not in self.lone:
                closed = page.find(m[0], at)
                if closed < 0:
                    self.lone.add(m[0])
                else:
                    at = closed + 1
        return page.find(">", start) + 1 or -1

    def following(self, name: str, pattern: re.Pattern, at: int) -> re.Match | None:
        """The first match from ``at`` on, where ``at`` never falls for a name."""
        if name not in self.found or (m := self.found[name]) and m.start() < at:
            self.found[name] = pattern.search(self.page, at)
        return self.found[name]


def blocks_of(page: str) -> list[Block]:
    """Blocks with text, in page order. Copes with elements that are never closed, or closed twice."""
    root, scanner = Box("", None), Scanner(page)
    top, link, out, foreign = root, 0, [], False
    now = Block(root)
    at, end = 0, len(page)
    open_tags: dict[str, int] = {}
    #: An inline element that isn't seen: its tag, how many of it are open, and the box it stands in.
    hidden, nested, hidden_in = "", 0, root

    def flush() -> None:
        nonlocal now
        text = " ".join(html.unescape("".join(now.parts)).split())
        if text:
            now.text = text
            out.append(now)
        now = Block(top)

    def add(piece: str) -> None:
        if not hidden:
            now.parts.append(piece)
            if link:
                now.linked += len(piece)

    def up() -> None:
        nonlocal top, hidden
        open_tags[top.tag] -= 1
        if top is hidden_in:
            hidden = ""
        top = top.parent

    while at < end:
        m = _OPEN.search(page, at)
        mark = m and page[m.start() : m.end()]
        stop = -1
        if mark == "<!--":
            stop = page.find("-->", m.end() - 2)
            stop = stop + 3 if stop >= 0 else end
        elif mark in ("<!", "<?"):
            stop = page.find(">", m.end()) + 1 or end
        elif m:
            stop = scanner.tag_end(m.end())
        if stop < 0:  # no tag ends any more; an opening tag that the page's end cuts off is markup
            piece = page[at:]
            cut = piece.rfind("<")
            add(piece[:cut] if cut >= 0 and re.match(r"<(?:/?[a-zA-Z]|!|\?)", piece[cut : cut + 3]) else piece)
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = stop
        if not m[2]:
            continue
        tag, closing, attributes = m[2].lower(), bool(m[1]), page[m.end() : stop - 1]
        if tag in BLOCK:
            foreign = False
            flush()
            if closing:
                if open_tags.get(tag):
                    while top.tag != tag:
                        up()
                    up()
            else:
                if tag in CLOSES_P and top.tag == "p":
                    up()
                for _ in range(2):
                    if top.tag in ENDS.get(tag, ()):
                        up()
                if tag != "hr":
                    top = opened(tag, attributes, top)
                    open_tags[tag] = open_tags.get(tag, 0) + 1
            now = Block(top)
        elif tag == "a":
            link = 0 if closing else 1
        elif tag in RAW:
            if not closing and not attributes.rstrip().endswith("/"):
                close = scanner.following(tag, re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I), at)
                if not foreign:
                    at = close.end() if close else end
                elif tag != "title":  # a drawing's title is text; its styles and scripts end with it
                    leave = scanner.following("", _LEAVES, at)
                    at = close.end() if close and close.end() <= (leave.start() if leave else end) else at
            now.parts.append(" ")
        elif tag in SPACE:
            if tag in FOREIGN:
                foreign = not closing and not attributes.rstrip().endswith("/")
            now.parts.append(" ")
        if hidden:
            if tag == hidden:
                nested += -1 if closing else 1
                hidden = hidden if nested else ""
        elif not closing and attributes and tag not in BLOCK and tag not in RAW and tag not in SPACE and unseen(attributes):
            hidden, nested, hidden_in = tag, 1, top
    flush()
    return out


def score(block: Block) -> int:
    """The classifier: log-odds of content in fixed units, from the containers and the text."""
    text = block.text
    words = text.count(" ") + 1
    total = block.box.evidence
    tag = block.box.tag
    total += 20 if words >= 25 else 12 if words >= 10 else 4 if words >= 5 else -6
    total += 5 if _ENDS.search(text) else 0
    total += 25 if tag == "h1" else 0
    total += 5 if tag == "p" else 0
    if block.linked:
        total -= 40 * min(block.linked, len(text)) // len(text)
    if words < 40 and _LEGAL.search(text):
        total -= 20
    return total


def edges_of(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges (block, block, capacity): each block with the next one and the next below its container's container."""
    out = []
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        box = block.box
        inner = box.parent or box
        if i:
            before = blocks[i - 1].box
            out.append((i - 1, i, ACROSS if before.boiler != box.boiler else BESIDE if (before.parent or before) is inner or before is box else NEXT))
        j = last.get(id(inner))
        if j is not None and j != i - 1:
            out.append((j, i, ACROSS if blocks[j].box.boiler != box.boiler else NEAR))
        last[id(inner)] = i
    return out


def minimum_cut(scores: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Labels of least cost: a block against its score pays |score|, an edge between labels its capacity.

    On ties a block is boilerplate (it is on the source's side only if the residual graph reaches it).
    """
    n = len(scores)
    net, near = list(scores), [[] for _ in range(n)]
    for a, b, c in edges:
        near[a].append((b, c))
        near[b].append((a, c))
    weight = [sum(c for _, c in x) for x in near]
    label: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:  # labels that no neighbour can change; each adds to its neighbours' scores
        i = queue.popleft()
        if label[i] is None and (net[i] > weight[i] or net[i] <= -weight[i]):
            label[i] = net[i] > 0
            for j, c in near[i]:
                if label[j] is None:
                    net[j] += c if label[i] else -c
                    weight[j] -= c
                    queue.append(j)
    open_ = [i for i in range(n) if label[i] is None]
    if open_:
        for i, side in zip(open_, _flow(open_, net, near, label), strict=True):
            label[i] = side
    return [bool(x) for x in label]


def _flow(open_: list[int], net: list[int], near: list[list[tuple[int, int]]], label: list[bool | None]) -> list[bool]:
    """Maximum flow by shortest augmenting levels (blocking flows) over the doubtful blocks."""
    place = {i: k for k, i in enumerate(open_)}
    source, sink = len(open_), len(open_) + 1
    to: list[int] = []
    room: list[int] = []
    out: list[list[int]] = [[] for _ in range(len(open_) + 2)]

    def join(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, k in place.items():
        if net[i] > 0:
            join(source, k, net[i], 0)
        elif net[i] < 0:
            join(k, sink, -net[i], 0)
        for j, c in near[i]:
            if label[j] is None and i < j:
                join(k, place[j], c, c)
    while True:
        level = [-1] * len(out)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(len(open_))]
        turn = [0] * len(out)
        path: list[int] = []
        at = source
        while True:
            if at == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                path, at = [], source
                continue
            while turn[at] < len(out[at]):
                e = out[at][turn[at]]
                if room[e] and level[to[e]] == level[at] + 1:
                    break
                turn[at] += 1
            else:
                if at == source:
                    break
                e = path.pop()
                at = to[e ^ 1]
                turn[at] += 1
                continue
            path.append(e)
            at = to[e]


def main_text(page: str) -> str:
    """The blocks labelled as content, in page order, one line each."""
    blocks = blocks_of(page)
    labels = minimum_cut([score(x) for x in blocks], edges_of(blocks))
    return "\n".join(x.text for x, kept in zip(blocks, labels, strict=True) if kept)


def extract_pages(pages: DataFrame) -> DataFrame:
    """Main text of every page from its whole html.

    Output, a row for each input row: page_id, url, text, n_chars (code points). Null and empty
    html and pages without content give an empty text. White space inside a block, also that
    of character references and line breaks, becomes one space. Repeated rows give repeated
    rows, other columns are ignored, an empty table gives an empty result; nothing is cut off.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(x) if x else "" for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id").cast(pa.int64()), part.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], ["page_id", "url", "text", "n_chars"])

    small_batches(pages)
    return pages.select("page_id", "url", "html").mapInArrow(run, SCHEMA)
