"""Main text of web pages by wrapper induction.

The pages of a host share layouts. Which texts are template is counted over all pages of the host:
a text is constant where most of the pages that have its slot, the keys on the way from the root,
hold it there. Siblings of one key share a slot, so a run's length doesn't matter; cells of tables
and lists of definitions, whose values come from few, count by position. Pages that mostly repeat
another count once. Every different page of a host is learned from: the pages are dealt by hash
into groups of about ``SAMPLE_PAGES``, and a group's pages, without constant texts, are aligned by
simple tree matching; the part that holds all varying text outside menus, forms, notices and the
like is the content. Every page is then aligned with its own group's template: what stands in the
content becomes text, constant text and everything outside goes. Where a page holds varying text
outside that part, its own content counts instead.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm.arrow import map_batches, map_groups
from ratingloom.llm.common import saved
from ratingloom.llm.dom import BLOCKS, RAW, Node, Pairs, folded, match, parse, walk

#: Different pages of a host that the place of its content is learned from together, at most (on
#: average: a host's pages are dealt by hash into as many groups as this size needs).
SAMPLE_PAGES = 12
#: Siblings of one kind that the template keeps of a run, for that place alone.
RUN = 3
#: Pages, out of all that have a slot, and share of them that must agree on a text to call it template.
LEAST_PAGES = 4
SAME = 0.6
#: Templates up to this size together go to every task; above it they are joined by host.
SENT_BYTES = 8 << 20
# Fixed names of elements and classes that hold no article text.
_NOT_TEXT = frozenset("nav aside footer form script style noscript template iframe svg math select button input textarea head object canvas audio video dialog menu map".split()) | RAW
_NOT_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation navigations menu menus "
    "breadcrumb breadcrumbs footer sidebar aside widget widgets cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "comment comments commentlist disqus reply replies respond share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login search pagination pager skip toolbar complementary contentinfo".split()
)
_HEADER = frozenset({"header", "masthead", "topbar", "banner"})
_MAIN = frozenset({"article", "main"})
#: A slot with a longer way from the root goes by its hash.
_LONG_PATH = 512
_CELLS = frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "dt", "dd"})


def host(url_col: str) -> Column:
    """The host of a URL in lower case, without port; null and other texts give an empty one."""
    found = F.regexp_extract(F.lower(F.col(url_col)), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.coalesce(found, F.lit(""))


def _shut(node: Node, inside: bool) -> bool:
    """Whether nothing in the element is article text; ``inside``: it stands in an article."""
    if node.hidden or node.tag in _NOT_TEXT:
        return True
    if node.tag in _MAIN or node.tag in ("html", "body", "#page"):
        return False
    if not inside and (node.tag == "header" or node.names & _HEADER):
        return True
    return bool(node.names & _NOT_NAMES)


def _own(node: Node) -> str:
    return " ".join("".join(c if isinstance(c, str) else " " for c in node.children).split())


def _texts(tree: Node) -> Counter:
    return Counter(text for node in walk(tree) if (text := _own(node)))


def _is_main(node: Node) -> bool:
    return node.tag in _MAIN or "main" in node.names


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def slot_texts(node: Node, path: str = "") -> Iterator[tuple[Node, str, str]]:
    """Every element that has a text of its own, with its slot and that text."""
    stack = [(node, path)]
    while stack:
        node, path = stack.pop()
        if text := _own(node):
            yield node, path, text
        if len(path) > _LONG_PATH:
            path = f"#{_hash(path)}"
        nth: Counter = Counter()
        below = []
        for child in node.elements():
            step = child.key
            if child.tag in _CELLS:
                step = f"{child.key}[{nth[child.key]}]"
                nth[child.key] += 1
            below.append((child, f"{path}/{step}"))
        stack.extend(reversed(below))


def _mark(path: str, text: str) -> int:
    return _hash(f"{path}\0{text}")


def _open(node: Node) -> Iterator[str]:
    stack = [(node, False)]
    while stack:
        node, inside = stack.pop()
        if not _shut(node, inside):
            if text := _own(node):
                yield text
            inside = inside or _is_main(node)
            stack.extend((child, inside) for child in reversed(node.elements()))


def _alike(tree: Node) -> int:
    """Equal for pages that mostly repeat each other: one of the open texts, drawn by its hash with
    the chance of its length."""
    found = {_hash(t): len(t) for t in _open(tree)}
    return min(((math.log(((h ^ 0x5DEECE66D) % (1 << 53) + 1) / ((1 << 53) + 2)) / -n, h) for h, n in found.items()), default=(0, 0))[1]


def page_marks(html: str) -> tuple[int, dict[int, set[int]]]:
    """What pages alike have in common, and the marks of the texts in each slot."""
    tree = parse(html)
    found: dict[int, set[int]] = {}
    for _, path, text in slot_texts(tree):
        found.setdefault(_hash(path), set()).add(_mark(path, text))
    return _alike(tree), found


def cleared(tree: Node, constant: set[int]) -> Node:
    """The tree, from which constant texts are taken."""
    if constant:
        for node, path, text in list(slot_texts(tree)):
            if _mark(path, text) in constant:
                node.children = node.elements()
    return tree


#: Elements that are part of a text and not a place of one.
_FLOW = frozenset("p b i em strong span a li ul ol table tr tbody".split())


class Template:
    """A node of the template: its own texts by page, children, and how much varying text it holds."""

    __slots__ = ("node", "texts", "children", "mass")

    def __init__(self, node: Node, below: bool = True):
        self.node, self.mass = node, 0.0
        self.texts = [len(_own(node))]
        self.children: list[Template] = []
        stack = [self] if below else []
        while stack:
            at = stack.pop()
            at.children = [Template(c, False) for c in at.node.elements()]
            stack += at.children

    def meet(self, other: Node, pairs: Pairs) -> None:
        stack = [(self, other, pairs)]
        while stack:
            at, other, pairs = stack.pop()
            at.texts.append(len(_own(other)))
            theirs = other.elements()
            stack.extend((at.children[i], theirs[j], sub) for i, j, sub in pairs)

    def weigh(self) -> Template:
        """Sets the average length of text outside links and what is shut."""
        open_, stack = [], [(self, False, False)]
        while stack:
            at, inside, linked = stack.pop()
            if not _shut(at.node, inside):
                inside, linked = inside or _is_main(at.node), linked or at.node.tag == "a"
                at.mass = 0.0 if linked else sum(at.texts) / len(at.texts)
                open_.append(at)
                stack.extend((c, inside, linked) for c in at.children)
        for at in reversed(open_):  # children come after their parents
            at.mass += sum(c.mass for c in at.children)
        return self

    def mains(self) -> list[Template]:
        """The outermost articles that hold text."""
        found, stack = [], [self]
        while stack:
            at = stack.pop()
            if at.mass > 0 and _is_main(at.node):
                found.append(at)
            elif at.mass > 0:
                stack.extend(reversed(at.children))
        return found

    def _to_mains(self) -> set[int]:
        """The nodes that are such an article or hold one."""
        order: list[tuple[Template, Template | None]] = []
        stack: list[tuple[Template, Template | None]] = [(self, None)]
        while stack:
            order.append(stack.pop())
            at = order[-1][0]
            if at.mass > 0 and not _is_main(at.node):
                stack.extend((c, at) for c in at.children)
        found = set()
        for at, above in reversed(order):
            if at.mass > 0 and (_is_main(at.node) or id(at) in found):
                found |= {id(at), id(above)}
        return found

    def content(self) -> Template:
        """The deepest node that holds all articles, else the deepest that holds all text."""
        mains = self._to_mains()
        at = self
        while not _is_main(at.node):
            if mains:
                below = [c for c in at.children if id(c) in mains]
            else:
                below = [c for c in at.children if c.mass > 0]
                if below and (at.mass - below[0].mass > 1e-6 or not below[0].children or below[0].node.tag in _FLOW):
                    break
            if len(below) != 1:
                break
            at = below[0]
        return at

    def plain(self, root: Template) -> list[list]:
        """As a list for JSON, parents first: tag, key, whether it is the content, and the parent's place."""
        rows, stack = [], [(self, -1)]
        while stack:
            at, above = stack.pop()
            stack.extend((c, len(rows)) for c in reversed(at.children))
            rows.append([at.node.tag, at.node.key, int(at is root), above])
        return rows


def induce(pages: list[str], constant: set[int]) -> list[list]:
    """The templates of a host's sample pages, one for each layout; pages that mostly repeat one
    already used say nothing about what varies and are left out."""
    trees, seen = [], []
    for html in pages:
        tree = parse(html)
        texts = _texts(tree)
        size = sum(len(t) * n for t, n in texts.items())
        if not any(2 * sum(len(t) * n for t, n in (texts & old).items()) > size for old in seen):
            seen.append(texts)
            trees.append(folded(cleared(tree, constant), RUN))
    if not trees:
        trees = [folded(cleared(parse(pages[0] if pages else ""), constant), RUN)]
    layouts: list[list[Node]] = []
    for tree in trees:
        fit, own = max(((_fit(o[0], tree), o) for o in layouts), key=lambda x: x[0], default=(0.0, []))
        if fit >= SAME:
            own.append(tree)
        else:
            layouts.append([tree])
    out = []
    for own in layouts:
        # the page with most in common with the others serves as the frame
        frame = max(own, key=lambda t: sum(match(t, o)[0] for o in own[:4]) / (1 + 0.01 * len(t.children)))
        template = Template(frame)
        for other in own:
            if other is not frame:
                template.meet(other, match(frame, other)[1])
        out.append(template.plain(template.weigh().content()))
    return out


def _count(node: Node) -> int:
    return sum(1 for _ in walk(node))


def _fit(one: Node, two: Node) -> float:
    """Share of both trees' nodes that pair."""
    return 2 * match(one, two)[0] / (_count(one) + _count(two))


class _Slot(Node):
    __slots__ = ("root",)

    def __init__(self, tag: str, key: str, root: int):
        self.tag, self.key, self.root = tag, key, root
        self.names, self.hidden = frozenset(), False
        self.children = []


def slots(plain: list[list]) -> list[_Slot]:
    found = []
    for rows in plain:
        made: list[_Slot] = []
        for tag, key, root, above in rows:
            made.append(_Slot(tag, key, root))
            if above >= 0:
                made[above].children.append(made[-1])
        found.append(made[0])
    return found


def _root(slot: _Slot, node: Template, pairs: Pairs) -> Template | None:
    """The page's part that is aligned with the content."""
    stack = [(slot, node, pairs)]
    while stack:
        slot, node, pairs = stack.pop()
        if slot.root:
            return node
        stack.extend((slot.children[i], node.children[j], sub) for i, j, sub in reversed(pairs))
    return None


def _blocks(node: Node, out: list[list[str]]) -> None:
    stack: list[tuple[Node | str | None, bool]] = [(node, False)]
    while stack:
        at, inside = stack.pop()
        if at is None:  # the end of a block
            out.append([])
        elif isinstance(at, str):
            out[-1].append(at)
        elif at.tag == "br":
            out[-1].append(" ")
        elif not _shut(at, inside):
            inside = inside or _is_main(at)
            if at.tag in BLOCKS:
                out.append([])
                stack.append((None, inside))
            stack.extend((c, inside) for c in reversed(at.children))


def extract(tree: Node, templates: list[_Slot]) -> str:
    """The text of the page's part aligned with the content of the template that fits best, if that
    holds all articles of the page, or all varying text; else of the page's own content."""
    page = Template(tree).weigh()
    best = max((match(t, tree) + (t,) for t in templates), key=lambda x: x[0] / (1 + _count(x[2])), default=None)
    root = _root(best[2], page, best[1]) if best else None
    held = sum(m.mass for m in page.mains()) or page.mass
    if root is None or root.mass < held - 1e-6 or page.mains() and not _holds(root, page.mains()):
        root = page.content()
    out: list[list[str]] = [[]]
    _blocks(root.node, out)
    return "\n".join(t for t in (" ".join("".join(b).split()) for b in out) if t)


def _holds(root: Template, wanted: list[Template]) -> bool:
    mine = root.mains()
    return len(mine) == len(wanted) and all(a is b for a, b in zip(mine, wanted))


def page_text(html: str, templates: list[_Slot], constant: set[int]) -> str:
    return extract(cleared(parse(html), constant), templates) or extract(parse(html), [])


def _constants(given: DataFrame) -> DataFrame:
    """host and marks: the texts that most of its pages share in a slot, counted over all pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            hosts, slots_, marks, alike = [], [], [], []
            for name, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                kind, found = page_marks(html)
                for slot, own in found.items():
                    hosts += [name] * (len(own) + 1)
                    slots_ += [slot] * (len(own) + 1)
                    marks += [None, *own]
                    alike += [kind] * (len(own) + 1)
            yield [hosts, slots_, marks, alike]

    rows = map_batches(given.where("html <> ''").select("host", "html"), run, "host string, slot bigint, mark bigint, alike bigint")
    counts = saved(rows.distinct().groupBy("host", "slot", "mark").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES), "slot-texts")
    total = counts.where("mark is null").select("host", "slot", F.col("n").alias("total"))
    most = counts.where("mark is not null").join(total, ["host", "slot"]).where(F.col("n") >= SAME * F.col("total"))
    return saved(most.groupBy("host").agg(F.collect_set("mark").alias("marks")), "constants")


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """A row per page: id, url, text ('' if none) and n_chars.

    Null and empty pages have no text. Pages without a readable host share one template. Rows that
    repeat an id are read each on its own.
    """
    given = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host(url_col).alias("host"))
    given = given.withColumn("h", F.xxhash64("html"))
    constants = _constants(given)
    different = given.where("html <> ''").select("host", "h").distinct()
    groups = different.groupBy("host").agg(F.ceil(F.count("*") / SAMPLE_PAGES).alias("groups"))
    groups = saved(groups.join(constants, "host", "left"), "host-groups")
    size = groups.agg(F.sum(64 + 8 * F.greatest(F.size("marks"), F.lit(0)))).first()[0] or 0
    given = given.join(F.broadcast(groups) if size <= SENT_BYTES else groups, "host", "left")
    given = given.withColumn("part", F.pmod("h", "groups"))
    # one shuffle of the different pages: their groups are dealt by (host, part) already
    sample = given.where("html <> '' and part is not null").select("host", "part", "h", "html", "marks").repartition("host", "part")
    sample = sample.dropDuplicates(["host", "part", "h"])

    def learn(rows: pa.Table) -> list:
        rows = rows.sort_by("h")
        marks = rows.column("marks")[0].as_py() or []
        templates = induce(rows.column("html").to_pylist(), set(marks))
        own = [rows.column("host")[0].as_py()], [rows.column("part")[0].as_py()]
        return [*own, [json.dumps([templates, sorted(marks)], separators=(",", ":"))]]

    learned = saved(map_groups(sample, ["host", "part"], learn, "host string, part bigint, template string"), "templates")
    size = learned.agg(F.sum(F.length("template") + 64)).first()[0] or 0
    joined = given.join(F.broadcast(learned) if size <= SENT_BYTES else learned, ["host", "part"], "left")
    kind = given.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        known: dict[str | None, tuple[list[_Slot], set[int]]] = {None: ([], set())}
        for batch in batches:
            out = []
            for html, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if template not in known:
                    if len(known) > 500:
                        known = {None: ([], set())}
                    plain, marks = json.loads(template)
                    known[template] = slots(plain), set(marks)
                out.append(page_text(html, *known[template]) if html else "")
            yield [batch.column(0), batch.column(1), out, [len(t) for t in out]]

    found = map_batches(joined.select("id", "url", "html", "template"), run, f"id {kind}, url string, text string, n_chars bigint")
    return found.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
