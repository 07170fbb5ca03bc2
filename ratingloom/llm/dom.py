"""A forgiving reader of HTML into a small tree, and simple tree matching."""

from __future__ import annotations

import re
from collections.abc import Generator, Iterator
from html import unescape

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAMES = re.compile(r"[^\W_]+")
_DIGITS = re.compile(r"\d+")
# Fixed sets of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = BLOCKS - {"body", "html", "tbody", "td", "tfoot", "th", "thead", "tr"}
_SAME = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


class Node:
    """An element: tag, names from class, id and role, and children, elements or text in order."""

    __slots__ = ("tag", "names", "key", "children", "hidden")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.hidden = tag, False
        names: list[str] = []
        if attributes.strip():
            for m in _ATTRIBUTE.finditer(attributes):
                name = m[1].lower()
                if name in ("class", "id", "role"):
                    names += _NAMES.findall(unescape(m[2] or m[3] or m[4] or "").lower())
                elif name == "hidden" or name == "aria-hidden" and (m[2] or m[3] or m[4]) == "true":
                    self.hidden = True
        self.names = frozenset(names)
        self.key = f"{tag} {' '.join(sorted({_DIGITS.sub('', n) for n in names}))}" if names else tag
        self.children: list[Node | str] = []

    def elements(self) -> list[Node]:
        return [c for c in self.children if not isinstance(c, str)]


def parse(html: str) -> Node:
    """The tree of a page, cut-off ones too; raw text elements stay empty."""
    root = Node("#page")
    stack = [root]
    at = 0
    while at < len(html):
        m = _MARKUP.search(html, at)
        text = html[at:m.start() if m else len(html)]
        if text:
            stack[-1].children.append(unescape(text))
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in _CLOSES_P:
            _close(stack, {"p"}, BLOCKS - {"p"})
        if tag in _SAME:
            _close(stack, {tag} | ({"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else set()), _SAME[tag])
        if tag in ("html", "body") and any(n.tag == tag for n in stack):
            continue
        node = Node(tag, m[3] or m[6] or "")
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
        elif tag not in VOID:
            stack.append(node)
    return root


def _close(stack: list[Node], tags: set[str], within: set[str] | frozenset[str]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in within:
            return


Pairs = list[tuple[int, int, "Pairs"]]


def walk(node: Node) -> Iterator[Node]:
    """The element and all below it, in page order."""
    stack = [node]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(reversed(node.elements()))


def match(a: Node, b: Node) -> tuple[int, Pairs]:
    """Simple tree matching: the most node pairs in order under equal keys, and which children pair.

    Trees may be of any depth: calls for pairs of children wait on a list of their own.
    """
    calls, given = [_match(a, b)], None
    while True:
        try:
            calls.append(_match(*calls[-1].send(given)))
            given = None
        except StopIteration as end:
            calls.pop()
            given = end.value
            if not calls:
                return given


def _match(a: Node, b: Node) -> Generator[tuple[Node, Node], tuple[int, Pairs], tuple[int, Pairs]]:
    """Gives out the pairs of children it has to know about and is sent their results."""
    if a.key != b.key:
        return 0, []
    one, two = a.elements(), b.elements()
    if not one or not two:
        return 1, []
    if [x.key for x in one] == [y.key for y in two]:
        total, found = 1, []
        for k, (x, y) in enumerate(zip(one, two)):
            n, below = yield x, y
            total += n
            found.append((k, k, below))
        return total, found
    best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
    sub: dict[tuple[int, int], tuple[int, Pairs]] = {}
    for i, x in enumerate(one):
        row, above = best[i + 1], best[i]
        for j, y in enumerate(two):
            most = max(above[j + 1], row[j])
            if x.key == y.key:
                sub[i, j] = yield x, y
                most = max(most, above[j] + sub[i, j][0])
            row[j + 1] = most
    pairs: Pairs = []
    i, j = len(one), len(two)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((i, j, sub[i, j][1]))
    return 1 + best[-1][-1], pairs[::-1]


def _alone(node: Node) -> Node:
    out = Node(node.tag)
    out.names, out.key, out.hidden = node.names, node.key, node.hidden
    return out


def folded(node: Node, most: int) -> Node:
    """A copy in which runs of more than ``most`` siblings of one key keep their first ones."""
    top = _alone(node)
    stack = [(node, top)]
    while stack:
        node, out = stack.pop()
        last, run = None, 0
        for child in node.children:
            if isinstance(child, str):
                out.children.append(child)
                continue
            run = run + 1 if child.key == last else 1
            last = child.key
            if run <= most:
                out.children.append(_alone(child))
                stack.append((child, out.children[-1]))
    return top
