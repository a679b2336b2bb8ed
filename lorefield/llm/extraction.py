"""Main text of web pages by minimum-cut labelling.

A page is a sequence of text blocks. A linear classifier gives each block a
score for being content; its size becomes the capacity from the source (content)
or to the sink (boilerplate). Neighbouring blocks and blocks that are close in
the document tree are tied by smoothness edges. The minimum cut labels all
blocks together: a short paragraph stays with the article around it, a lone
sentence in a menu goes with the menu.

What an element's name says is a feature and no verdict. The nearest telling
element counts, and one that sounds like boilerplate but holds the page's main
prose, such as a form around the whole page or a layout named after its
sidebar, says nothing.
"""

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from lorefield.llm.common import batch_rows

#: Elements whose text is never shown or belongs to controls.
SILENT = "script|style|template|noscript|svg|iframe|object|textarea|select|button|title|canvas|audio|video|math"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({SILENT})\b(?:[^>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)(?:>|(?=<)|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.I | re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
PARTS = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p pre section summary table tbody td tfoot th thead
tr ul head""".split())
#: Open elements that end where one of these begins.
CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
ENDS_P = BLOCK - {"html", "body", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dt", "dd", "summary", "figcaption"}
SCOPE = frozenset("article body div form html main nav ol section table td th ul aside footer header blockquote dl".split())

MAIN = frozenset("article main content entry post story body text".split())
OUTER = frozenset("header banner masthead title".split())
AWAY = frozenset("""ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner sidebar aside nav navbar navigation menu
breadcrumb breadcrumbs footer comment comments disqus reply replies respond cookie cookies consent gdpr notice notices alert popup
modal overlay newsletter subscribe signup login search share sharing social related recommended widget pagination pager toolbar
copyright legal form hidden skip""".split())
AWAY_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
#: First parts of a name after which the rest tells how the page looks and not what the element is.
LAYOUT = frozenset("no with without has is show hide not page layout".split())

#: The classifier's weights, and the weights of the smoothness edges; one unit is one natural log-odds.
WEIGHTS = {"bias": -0.4, "main": 4.0, "away": -7.5, "outer": -6.0, "hint": -1.5, "length": 0.9, "links": -4.0, "sentence": 0.8, "heading": 0.8,
           "paragraph": 0.8}
#: Blocks of as many words with as little of them in links are prose.
PROSE_WORDS, PROSE_LINKS = 8, 0.35
#: A name is void on an element with this share of the greatest main element's prose, or of all prose where no element is called main.
MAIN_SHARE, PAGE_SHARE = 0.5, 0.8
ADJACENT, SIBLING, COUSIN = 0.5, 1.0, 0.3
UNIT = 1000


@dataclass
class Block:
    """Text of a block, characters of it in links, the three elements next around it, and the nearest telling element."""

    text: str
    linked: int
    path: tuple
    mark: int
    context: str = ""


@dataclass
class Mark:
    """An element whose tag or name tells something: ``main``, ``away``, ``outer`` or ``hint``; and the telling element around it."""

    kind: str
    around: int
    prose: int = 0
    best: int = 0  # most prose of a main element in it, itself included


def _kind(tag: str, attributes: str) -> str:
    """What an element says about its content.

    A name is one of the known words as a whole or in its last part
    (``site-footer``); a first part (``related-work``) is only a hint.
    """
    whole = hinted = main = outer = False
    if tag not in ("body", "html") and "=" in attributes:
        for v in NAMES.findall(attributes):
            for name in v.lower().strip("\"'").split():
                parts = PARTS.findall(name)
                if not parts or parts[0] in LAYOUT and len(parts) > 1:
                    continue
                whole = whole or parts[-1] in AWAY
                hinted = hinted or any(w in AWAY for w in parts)
                main = main or any(w in MAIN for w in parts)
                outer = outer or parts[-1] in OUTER
    if tag in AWAY_TAGS or whole:
        return "away"
    if hinted:
        return "hint"
    if tag in ("article", "main") or main and tag in ("div", "section", "td"):
        return "main"
    return "outer" if tag == "header" or outer else ""


def blocks(html: str) -> tuple[list[Block], list[Mark]]:
    """Blocks in page order; block elements part them, inline ones and line breaks do not.

    Costs grow with the page, however deep or broken it is: open elements are
    counted, so that tags without one are passed over, and elements around a
    block are links, not copies.
    """
    out: list[Block] = []
    marks: list[Mark] = []
    stack: list[tuple] = []  # tag, telling element
    around: list[tuple] = []  # open block elements: tag, number
    scopes: list[Counter] = [Counter()]  # open elements within each element of SCOPE
    opened: Counter = Counter()
    text: list[str] = []
    linked = links = number = 0

    def flush():
        nonlocal linked
        if text:
            whole = SPACE.sub(" ", "".join(text)).strip()
            if whole:
                out.append(Block(whole, linked, tuple(around[-3:]), stack[-1][1] if stack else -1))
            text.clear()
        linked = 0

    def close(tag_ended):
        """Close the nearest open element of these tags and all in it."""
        nonlocal links
        gone = []
        while not gone or gone[-1] not in tag_ended:
            gone.append(stack[-1][0])
            if gone[-1] in BLOCK:
                flush()
                around.pop()
            tag = stack.pop()[0]
            opened[tag] -= 1
            scopes[-1][tag] -= 1
            if tag in SCOPE:
                scopes.pop()
            links -= tag == "a"

    for m in TOKEN.finditer(html):
        tag = m[3]
        if tag is None:
            piece = m[0]
            if piece[0] != "<" or piece == "<":
                if "&" in piece:
                    piece = unescape(piece)
                text.append(piece)
                if links:
                    linked += len(piece.strip())
            continue
        tag = tag.lower()
        if m[2]:
            if opened[tag]:
                close({tag})
            elif tag in BLOCK:
                flush()
            continue
        if tag in VOID:
            if tag == "br":
                text.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            flush()
            ended = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
            if any(scopes[-1][t] > 0 for t in ended):
                close(ended)
        if m[4].rstrip().endswith("/") and tag not in BLOCK:
            continue
        mark = stack[-1][1] if stack else -1
        kind = _kind(tag, m[4])
        if kind:
            marks.append(Mark(kind, mark))
            mark = len(marks) - 1
        number += 1
        stack.append((tag, mark))
        opened[tag] += 1
        if tag in SCOPE:
            scopes.append(Counter())
        scopes[-1][tag] += 1
        if tag in BLOCK:
            around.append((tag, number))
        links += tag == "a"
    flush()
    return out, marks


def set_contexts(found: list[Block], marks: list[Mark]) -> None:
    """Decide what the telling elements around each block amount to."""
    total = 0
    for b in found:
        if b.text.count(" ") + 1 >= PROSE_WORDS and b.linked < PROSE_LINKS * len(b.text):
            total += len(b.text)
            if b.mark >= 0:
                marks[b.mark].prose += len(b.text)
    for m in reversed(marks):  # an element comes after those around it
        if m.kind == "main":
            m.best = max(m.best, m.prose)
        if m.around >= 0:
            marks[m.around].prose += m.prose
            marks[m.around].best = max(marks[m.around].best, m.best)
    named = any(m.kind == "main" for m in marks)
    most = max((m.best for m in marks), default=0)
    contexts: list[str] = []
    for m in marks:
        above = contexts[m.around] if m.around >= 0 else ""
        void = most and m.best >= MAIN_SHARE * most if named else total and m.prose >= PAGE_SHARE * total
        if above in ("away", "outer"):
            contexts.append(above)
        elif m.kind == "main":
            contexts.append("main")
        elif void and m.kind != "main" or m.kind == "outer" and above in ("main", "hint"):
            contexts.append(above)
        elif m.kind == "hint":
            contexts.append("hint" if above in ("main", "hint") else "away")
        else:
            contexts.append(m.kind)
    for b in found:
        b.context = contexts[b.mark] if b.mark >= 0 else ""


def content_score(block: Block) -> float:
    """The classifier's log-odds that a block is content."""
    words = block.text.count(" ") + 1
    w = WEIGHTS
    score = w["bias"] + w["length"] * min(words, 40) / 10
    score += w["links"] * min(1.0, block.linked / len(block.text))
    score += w["sentence"] * (block.text[-1] in ".!?…")
    last = block.path[-1][0] if block.path else ""
    score += w["heading"] * (last in ("h1", "h2", "h3")) + w["paragraph"] * (last in ("p", "pre", "blockquote"))
    score += w["main"] * (block.context in ("main", "hint"))
    return score + (w[block.context] if block.context in ("away", "outer", "hint") else 0)


def smoothness(found: list[Block]) -> list[tuple[int, int, int]]:
    """Edges ``(i, j, capacity)``: to the next block, and to the next one under the same parent and grandparent."""
    edges, seen = {}, {}
    for i, b in enumerate(found):
        if i:
            edges[i - 1, i] = edges.get((i - 1, i), 0) + ADJACENT
        for up, weight in ((2, SIBLING), (3, COUSIN)):
            if len(b.path) >= up:
                parent = b.path[-up]
                j = seen.get((up, parent))
                if j is not None and found[j].context == b.context:
                    edges[j, i] = edges.get((j, i), 0) + weight
                seen[up, parent] = i
    return [(i, j, int(UNIT * w)) for (i, j), w in edges.items()]


def source_side(n: int, source: list[int], sink: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Minimum cut by shortest augmenting paths in levels: which of ``n`` nodes stay with the source.

    Of several minimum cuts the one with the largest source side is taken.
    """
    s, t = n, n + 1
    to, room, out = [], [], [[] for _ in range(n + 2)]

    def link(a, b, forth, back):
        out[a].append(len(to))
        to.append(b)
        room.append(forth)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i in range(n):
        if source[i]:
            link(s, i, source[i], 0)
        if sink[i]:
            link(i, t, sink[i], 0)
    for i, j, c in edges:
        link(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[t] < 0:
            break
        at = [0] * (n + 2)
        path: list[int] = []
        a = s
        while True:
            if a == t:
                flow = min(room[e] for e in path)
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow
                k = next(k for k, e in enumerate(path) if not room[e])
                a = to[path[k] ^ 1]
                del path[k:]
                continue
            while at[a] < len(out[a]):
                e = out[a][at[a]]
                if room[e] and level[to[e]] == level[a] + 1:
                    break
                at[a] += 1
            if at[a] < len(out[a]):
                path.append(out[a][at[a]])
                a = to[path[-1]]
            elif path:
                a = to[path.pop() ^ 1]
                at[a] += 1
            else:
                break
    reach = [False] * (n + 2)  # nodes that still reach the sink
    reach[t] = True
    queue = deque([t])
    while queue:
        b = queue.popleft()
        for e in out[b]:
            if room[e ^ 1] and not reach[to[e]]:
                reach[to[e]] = True
                queue.append(to[e])
    return [not r for r in reach[:n]]


def main_text(html: str) -> str:
    """Content blocks of a page, joined by empty lines."""
    found, marks = blocks(html)
    set_contexts(found, marks)
    scores = [int(UNIT * content_score(b)) for b in found]
    keep = source_side(len(found), [max(0, x) for x in scores], [max(0, -x) for x in scores], smoothness(found))
    return "\n\n".join(b.text for b, k in zip(found, keep) if k)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages(page_id, url, html)``.

    Null and empty pages and pages without content give an empty text. Very long,
    deep or broken pages are read whole; parsing costs grow with their length. Repeated
    rows give repeated rows, null ids and urls are kept, other columns are
    ignored, an empty table gives an empty table.
    """
    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h or "") for h in batch_rows(b, "html")[0]]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(extracted, f"page_id {kind}, url string, text string, n_chars bigint")
