"""The main text of web pages, by a minimum cut between content and boilerplate.

A page becomes a line of blocks: stretches of text between the tags of block-level elements, each with the path of elements above
it. Every block is a node of a graph:

- a linear classifier gives each block a cost: what speaks for content (an article around it, running text, punctuation, a heading)
  counts up, what speaks for boilerplate (a menu, advert, form or comment section around it, links, bare short text) down. A
  positive cost is the capacity of the edge from the source (what it costs to call the block boilerplate), a negative one of
  the edge to the sink;
- blocks that follow each other, and blocks that are next to each other among the children of one element, are joined by
  edges whose capacity grows with how close they are in the element tree (what it costs to tell them apart).

The maximum flow from source to sink gives the cheapest cut; blocks on the source's side are the main text. So a short paragraph
between long ones stays, and a sentence in a sidebar goes, on pages without telling elements too.

Pages are read as browsers do: tags without end, unquoted attributes, unclosed or wrongly nested elements, a page cut anywhere.
Comments, scripts, styles, titles and whatever shows no text are left out; character references are decoded; white space
in a block becomes one space.

A null or empty page, one of white space or without a block has the text ''. Whole pages are read, whatever their length: time is about
linear in it. Repeated rows are treated alike. An empty table gives an empty result. A column of the input named like the new one
is replaced. There is no shuffle; each page is worked on by itself.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wortfund.llm.common import others, packed, quoted, unpacked

# --- fixed values: element names of HTML by how they are read, and words of class and id attributes ---

_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Start and end on a block of their own.
BLOCK_TAGS = _HEADINGS | set(
    "address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption figure footer form header "
    "hgroup legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: No text between their tags is markup; none of it is shown as part of the page.
RAW_TAGS = {"script", "style", "title", "textarea", "noscript", "noframes", "noembed", "iframe", "xmp", "plaintext"}
#: Elements of forms, pictures and the like: what they hold is no text of the page.
SILENT_TAGS = {"svg", "math", "template", "object", "audio", "video", "canvas", "select", "datalist", "button", "map", "head"}
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the first closes an open element of the second, up to the third.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
_SCOPE = {"table", "td", "th", "caption"}
_P_SCOPE = _SCOPE | {"button"}

ARTICLE_TAGS, ARTICLE_ROLES = {"article", "main"}, {"article", "main"}
BOILERPLATE_TAGS = {"nav", "aside", "footer", "menu", "dialog", "search"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar", "toolbar", "form"}
BOILERPLATE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored sponsors promo promoted promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer masthead topbar toolbar cookie cookies consent gdpr "
    "notice notices notification popup modal overlay newsletter subscribe signup login share sharing social related recommended "
    "recommendations trending widget pagination pager copyright disclaimer".split()
)
COMMENT_WORDS = {"comment", "comments", "reply", "replies", "respond", "disqus"}
ARTICLE_WORDS = {"article", "content", "post", "entry", "story", "main", "maintext"}

# --- the classifier: what counts for content, in units of cost ---

WEIGHTS = {
    "article": 24,  # in an article
    "article_word": 6,  # in an element whose class or id says so
    "boilerplate": -48,  # in a menu, footer, sidebar, advert, notice, comment section
    "form": -48,
    "header": -14,  # in a page header
    "main_heading": 12,
    "heading": 3,
    "paragraph": 4,
    "list_item": -3,
    "ends_sentence": 4,
    "per_4_words": 1,  # of words that are no links, up to MOST_WORDS
    "linked": -12,  # most of it is links
    "short": -5,  # under 5 words and no end of a sentence
    "sign": -10,  # a copyright sign
}
MOST_WORDS = 80
#: Capacities between blocks: that follow each other; in the same landmark; children of the same element; heading and what follows it.
NEXT, SAME_LANDMARK, SAME_PARENT, UNDER_HEADING = 1, 2, 3, 3

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SENTENCE_END = re.compile(r"[.!?…。！？:;]['\"”’»)\]]*$")


class _Element:
    __slots__ = ("tag", "parent", "kind", "holds_article")

    def __init__(self, tag: str, parent: "_Element | None", kind: str):
        self.tag, self.parent, self.kind, self.holds_article = tag, parent, kind, False


def _kind(tag: str, attributes: str) -> str:
    """What an element says of the text in it: article, article_word, boilerplate, boilerplate_word, comments, form, header,
    hidden or nothing."""
    words: set[str] = set()
    role = ""
    if attributes and not attributes.isspace():
        for name, a, b, c in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), a or b or c
            if name in ("class", "id"):
                words.update(w.lower() for w in _NAME_WORD.findall(value))
            elif name == "role":
                role = value.strip().lower()
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
                return "hidden"
    if tag in ("html", "body"):
        return ""
    if tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES:
        return "boilerplate"
    if words & COMMENT_WORDS and not (tag in ARTICLE_TAGS and words & ARTICLE_WORDS):
        return "comments"
    if tag in ARTICLE_TAGS or role in ARTICLE_ROLES:
        return "article"
    if tag == "form":
        return "form"
    if tag == "header":
        return "header"
    if words & BOILERPLATE_WORDS:
        return "boilerplate_word"
    if "header" in words and not words & ARTICLE_WORDS:
        return "header"
    return "article_word" if words & ARTICLE_WORDS else ""


class Block:
    """A stretch of text, the element it stands in, and how many of its characters are links."""

    __slots__ = ("text", "element", "linked")

    def __init__(self, text: str, element: _Element, linked: int):
        self.text, self.element, self.linked = text, element, linked


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in page order, those without text left out."""
    root = _Element("body", None, "")
    stack, out = [root], []
    open_: dict[str, int] = {}  # how many elements of a name the stack holds
    pieces: list[str] = []
    linked, link_depth, silent = 0, 0, 0  # depths of the stack from which on text is a link, or not shown
    lower = ""

    def flush():
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, stack[-1], linked))
            pieces.clear()
        linked = 0

    def push(tag, kind):
        if kind == "article":
            for e in reversed(stack):
                if e.holds_article:
                    break
                e.holds_article = True
        stack.append(_Element(tag, stack[-1], kind))
        open_[tag] = open_.get(tag, 0) + 1

    def pop_to(n):
        nonlocal link_depth, silent
        for e in stack[n:]:
            open_[e.tag] -= 1
        del stack[n:]
        link_depth = link_depth if link_depth <= n else 0
        silent = silent if silent <= n else 0

    def add(text):
        nonlocal linked
        if silent:
            return
        if "&" in text:
            text = html.unescape(text)
        pieces.append(text)
        if link_depth:
            linked += len(text)

    at, scan = 0, _TOKEN.search
    while token := scan(page, at):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        tag = token[2]
        if tag is None:
            continue
        tag = tag.lower()
        if token[1]:
            if tag == "a":
                link_depth = 0
            elif tag in ("body", "html"):
                flush()
            elif open_.get(tag):
                for n in range(len(stack) - 1, 0, -1):
                    if stack[n].tag == tag:
                        flush()
                        pop_to(n)
                        break
                    if stack[n].tag in _SCOPE and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                        break
            continue
        if tag in RAW_TAGS:
            lower = lower or page.lower()
            end = -1 if tag == "plaintext" else lower.find("</" + tag, at) if len(lower) == len(page) else page.find("</" + tag, at)
            at = len(page) if end < 0 else end
            if end >= 0 and (token := scan(page, at)):
                at = token.end()
            continue
        if tag in ("br", "hr"):
            if tag == "hr":
                flush()
            elif not silent:
                pieces.append(" ")
            continue
        if tag in VOID_TAGS or tag in ("html", "body"):
            if tag in ("html", "body"):
                flush()
            continue
        if tag == "a":
            link_depth = len(stack)
        kind = _kind(tag, token[3])
        if tag not in BLOCK_TAGS and tag not in SILENT_TAGS and kind not in ("boilerplate", "boilerplate_word", "comments", "hidden", "article"):
            continue  # an inline element
        if tag == "a" and not kind:
            continue
        flush()
        if tag in BLOCK_TAGS:
            if open_.get("p") and tag not in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend", "summary"):
                _close(stack, {"p"}, _P_SCOPE, pop_to)
            if tag in _CLOSES and any(open_.get(t) for t in _CLOSES[tag][0]):
                _close(stack, *_CLOSES[tag], pop_to)
            if tag in _HEADINGS and stack[-1].tag in _HEADINGS:
                pop_to(len(stack) - 1)
        push(tag, kind)
        if (tag in SILENT_TAGS or kind == "hidden") and not silent:
            silent = len(stack)
    add(page[at:])
    flush()
    return out


def _close(stack, tags, limit, pop_to) -> None:
    """Close the innermost open element of `tags` that no element of `limit` encloses."""
    for n in range(len(stack) - 1, 0, -1):
        if stack[n].tag in tags:
            pop_to(n)
            return
        if stack[n].tag in limit:
            return


def _landmark(element: _Element, seen: dict) -> tuple[str, _Element | None]:
    """What the elements around a text say of it, and which one. Boilerplate outdoes an article within or around it; of the
    rest the innermost counts. A form, a header, or a class name of an element that holds an article says nothing."""
    path = []
    while element is not None and element not in seen:
        path.append(element)
        element = element.parent
    found = seen[element] if element is not None else ("", None)
    for e in reversed(path):
        kind = e.kind
        if e.holds_article and kind in ("form", "header", "boilerplate_word"):
            kind = ""
        if kind in ("boilerplate_word", "comments"):
            kind = "boilerplate"
        if kind and found[0] not in ("boilerplate", "form") and (kind, found[0]) != ("article_word", "article"):
            found = (kind, e)
        seen[e] = found
    return found


def cost(block: Block, landmark: str) -> int:
    """How much speaks for content; negative: for boilerplate."""
    text, w, tag = block.text, WEIGHTS, block.element.tag
    words = text.count(" ") + 1
    total = w.get(landmark, 0)
    if tag == "h1":
        total += w["main_heading"]
    elif tag in _HEADINGS:
        total += w["heading"]
    elif tag in ("p", "blockquote", "pre"):
        total += w["paragraph"]
    elif tag == "li":
        total += w["list_item"]
    ends = _SENTENCE_END.search(text[-8:]) is not None
    if ends:
        total += w["ends_sentence"]
    free = max(0, len(text) - block.linked) / len(text)
    total += int(min(words * free, MOST_WORDS)) // 4 * w["per_4_words"]
    if free < 0.5:
        total += w["linked"]
    if words < 5 and not ends and tag not in _HEADINGS:
        total += w["short"]
    if "©" in text or "(c)" in text[:40].lower():
        total += w["sign"]
    return total


def edges(blocks: list[Block], landmarks: list) -> dict[tuple[int, int], int]:
    """Capacities between blocks, by their numbers."""
    out: dict[tuple[int, int], int] = {}
    last: dict[_Element, int] = {}
    for i, b in enumerate(blocks):
        parent = b.element.parent or b.element
        if i:
            near = NEXT
            if landmarks[i][1] is landmarks[i - 1][1]:
                near += SAME_LANDMARK
            if blocks[i - 1].element.tag in _HEADINGS and parent is blocks[i - 1].element.parent:
                near += UNDER_HEADING
            out[i - 1, i] = near
        before = last.get(parent)
        if before is not None and landmarks[before][1] is landmarks[i][1]:
            out[before, i] = out.get((before, i), 0) + SAME_PARENT
        last[parent] = i
    return out


def min_cut(costs: list[int], between: dict[tuple[int, int], int]) -> list[bool]:
    """Whether each node is on the source's side of a least cut: the nodes with a positive cost have an edge of that capacity from
    the source, those with a negative one an edge to the sink, and `between` holds the capacities, both ways, of the others.

    Shortest augmenting paths, a level graph at a time; the terminals are kept as what each node has left.
    """
    n = len(costs)
    left, want = [max(0, c) for c in costs], [max(0, -c) for c in costs]
    room: list[int] = []
    to: list[int] = []
    out: list[list[int]] = [[] for _ in range(n)]
    for (u, v), c in between.items():
        out[u].append(len(to))
        to.append(v)
        out[v].append(len(to))
        to.append(u)
        room += [c, c]
    while True:
        level = [-1] * n
        line = [i for i in range(n) if left[i]]
        for i in line:
            level[i] = 0
        reached = False
        for u in line:  # grows as it is read
            reached = reached or want[u] > 0
            for e in out[u]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    line.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        tried = [0] * n
        for s in range(n):
            while left[s]:
                path, u = [], s
                while not want[u]:
                    while tried[u] < len(out[u]):
                        e = out[u][tried[u]]
                        if room[e] and level[to[e]] == level[u] + 1:
                            break
                        tried[u] += 1
                    if tried[u] < len(out[u]):
                        path.append(out[u][tried[u]])
                        u = to[path[-1]]
                    elif path:
                        u = to[path.pop() ^ 1]
                        tried[u] += 1
                    else:
                        break
                if not want[u]:
                    break
                flow = min([left[s], want[u], *(room[e] for e in path)])
                left[s] -= flow
                want[u] -= flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def main_text(page: str | None) -> str:
    """The blocks of a page that are content, one a line."""
    blocks = blocks_of(page or "")
    seen: dict = {}
    landmarks = [_landmark(b.element, seen) for b in blocks]
    costs = [cost(b, kind) for b, (kind, _) in zip(blocks, landmarks)]
    content = min_cut(costs, edges(blocks, landmarks))
    return "\n".join(b.text for b, keep in zip(blocks, content) if keep)


def _texts(batches):
    for batch in batches:
        pages = (x.as_py() for x in batch["html"])
        yield pa.record_batch([batch["row"], pa.array([main_text(p) for p in pages], pa.string())], names=["row", "main_text"])


def extract(df: DataFrame, html_col="html", keep_html=True, text_col="main_text") -> DataFrame:
    """df with `main_text`, the main text of each page. keep_html=False leaves the page itself out."""
    kept = df if keep_html else df.select(*others(df, html_col))
    row = packed(kept) if kept.columns else F.struct(F.lit(0).alias("none")).alias("row")
    rows = df.select(row, quoted(html_col).cast("string").alias("html"))
    out = rows.mapInArrow(_texts, T.StructType([rows.schema["row"], T.StructField("main_text", T.StringType())]))
    return out.select(*(unpacked(out, text_col) if kept.columns else []), F.col("main_text").alias(text_col))
