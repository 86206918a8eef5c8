"""Main text of web pages by tree scoring.

The page becomes a tree. Menus, headers, footers, sidebars, notices, adverts,
forms, comments, scripts and styles are known by element, role, class or id and
are left out. Every paragraph passes points to its ancestors: one, one per comma
and one per 100 characters (three at most), in full to the parent, half to the
grandparent, then ever less; a container keeps the share of its points that its
text outside links has. The best container and its siblings with enough points
(or plain paragraphs beside it) are kept. Its blocks, with character references
decoded and white space made single, are joined by empty lines.

A null or empty page, and one without any text outside those parts, gives an
empty text. Pages cut off in the middle of a tag or comment lose that tag.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
# HTML element names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg math object canvas audio video textarea title head select".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
LEFT_OUT = set("nav header footer aside form button menu dialog fieldset".split()) | RAW
PARAGRAPHS = set("p pre td blockquote li dd div section article".split())
LISTS = set("ul ol dl table div section".split())
LEFT_OUT_ROLE = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
LEFT_OUT_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|sponsor\w*|promo\w*|banner|nav\w*|menu\w*|breadcrumb\w*|header|masthead|footer|sidebar|side-bar|"
    r"rail|widget\w*|cookie\w*|consent|notice\w*|popup|modal|newsletter|subscribe|signup|login|comments?|comment-\w*|disqus\w*|respond|"
    r"replies|share\w*|social\w*|related\w*|recommend\w*|pagination|pager)(?:$|[\s_-])",
    re.I,
)
CLOSES_P = BLOCK - {"body", "html"}
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "parts", "out", "points", "length", "linked")

    def __init__(self, tag: str, parent: "Node | None", out: bool) -> None:
        self.tag, self.parent, self.out = tag, parent, out
        self.parts: list = []
        self.points, self.length, self.linked = 0.0, 0, 0


def _left_out(tag: str, attributes: str) -> bool:
    if tag in LEFT_OUT:
        return True
    if not attributes.strip() or tag in ("html", "body", "article", "main"):
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name in ("class", "id") and LEFT_OUT_NAME.search(value):
            return True
        if name == "role" and value.lower() in LEFT_OUT_ROLE or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", "").lower():
            return True
    return False


def tree(page: str) -> Node:
    root = here = Node("html", None, False)
    at = 0
    while True:
        found = TOKEN.search(page, at)
        if not found:
            if at < len(page):
                here.parts.append(page[at:])
            return root
        if found.start() > at:
            here.parts.append(page[at : found.start()])
        at = found.end()
        name = found.group(2) or found.group(5)
        if not name:
            continue
        tag = name.lower()
        closing = found.group(1) or found.group(4)
        attributes = (found.group(3) or found.group(6) or "") if not closing else ""
        if closing:
            node = here
            while node is not None and node.tag != tag:
                node = node.parent if not (node.tag in BLOCK and tag not in BLOCK) else None
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        if tag in CLOSES_P:
            node = here
            while node is not None and node.tag not in BLOCK:
                node = node.parent
            if node is not None and node.tag == "p" and node.parent is not None:
                here = node.parent
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            node = here
            while node is not None and node.tag not in ("ul", "ol", "dl", "table", "menu", "body", "html", tag):
                node = node.parent
            if node is not None and node.tag == tag and node.parent is not None:
                here = node.parent
        if tag in ("html", "body"):
            continue
        if tag == "br":
            here.parts.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                here.parts.append(Node("hr", here, False))
            continue
        node = Node(tag, here, here.out or _left_out(tag, attributes))
        here.parts.append(node)
        if tag in RAW and not attributes.rstrip().endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else (len(page) if tag != "head" else at)
            continue
        if not attributes.rstrip().endswith("/") or tag in BLOCK:
            here = node


def _order(root: Node) -> list[Node]:
    """Nodes, parents first; no recursion, so depth does not matter."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += [p for p in reversed(node.parts) if isinstance(p, Node) and not p.out]
    return out


def _measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        own = sum(len(SPACE.sub(" ", p).strip()) for p in node.parts if isinstance(p, str))
        children = [p for p in node.parts if isinstance(p, Node) and not p.out]
        node.length = own + sum(c.length for c in children)
        node.linked = node.length if node.tag == "a" else sum(c.linked for c in children)


def _commas(node: Node) -> int:
    total, todo = 0, [node]
    while todo:
        for part in todo.pop().parts:
            if isinstance(part, str):
                total += part.count(",")
            elif not part.out:
                todo.append(part)
    return total


def _paragraph(node: Node) -> bool:
    """A paragraph holds text itself, not only in blocks below it."""
    if node.tag not in PARAGRAPHS or not node.length:
        return False
    return all(isinstance(p, str) or p.out or p.tag not in BLOCK for p in node.parts)


def best_parts(root: Node) -> list[Node]:
    """The best container and its siblings that belong to it."""
    nodes = _order(root)
    _measure(nodes)
    scored: list[Node] = []
    for node in nodes:
        if not _paragraph(node):
            continue
        points = 1 + _commas(node) + min(node.length // 100, 3)
        up, level = node.parent, 0
        while up is not None:
            if not up.points:
                scored.append(up)
            up.points += points / (1 if level == 0 else 2 * level)
            up, level = up.parent, level + 1
    if not scored:
        return [root]
    final = lambda n: n.points * (1 - n.linked / max(n.length, 1))
    best = max(scored, key=final)
    up = best.parent
    while up is not None:  # the article around a section is the container
        if up.tag in ("article", "main"):
            best = up
            break
        up = up.parent
    if best.parent is None:
        return [best]
    least = max(10.0, 0.2 * final(best))
    return [
        s
        for s in best.parent.parts
        if isinstance(s, Node)
        and not s.out
        and (s is best or s.points and final(s) >= least or s.tag == "p" and s.length > 80 and s.linked < 0.25 * s.length)
    ]


def blocks(parts: list[Node]) -> list[str]:
    out: list[str] = []
    held: list[str] = []

    def close() -> None:
        text = SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            out.append(text)

    for part in parts:
        todo: list = [part]
        while todo:
            item = todo.pop()
            if item is None:
                close()
            elif isinstance(item, str):
                held.append(item)
            elif not item.out:
                if item.tag in LISTS and item is not part and item.length and item.linked > 0.5 * item.length:
                    close()
                    continue
                edge = [None] if item.tag in BLOCK else []
                todo += edge + item.parts[::-1] + edge
        close()
    return out


def main_text(page: str | None) -> str:
    return "\n\n".join(blocks(best_parts(tree(page)))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
