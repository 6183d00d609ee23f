"""Main text of web pages by wrapper induction.

Pages of a host that are laid out alike share a template. All pages of each layout
are parsed and aligned, node by node, with one of them by simple tree
matching. Aligned nodes whose text is the same everywhere are the template; those
whose text differs, and what only some pages have, are slots. The wrapper of the
layout is the path to the deepest node that holds all text of the slots, and the
constant parts inside that node. Each page then follows the path, level by level,
and yields the text below it without the constant parts. What varies like content
and yet is none, such as menus, adverts and comments, is told by tag, role or class.
"""

from __future__ import annotations

import html as entities
import json
import re
from difflib import SequenceMatcher
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from swathe.llm.common import stored, strings, with_columns

#: Different pages of a layout that choose its model, those of the lowest hash; all pages are aligned with that.
ALIGNED = 8
#: Drafts that a task holds at once, what the alignment of one remembers, and bytes of drafts that Spark sends to all tasks.
HELD, REMEMBERED, SENT = 64, 50_000, 16 << 20
#: Pages of different content, with less than half of their words in common, that must share a part for it to be template,
#: and the largest share of the content that may be. Otherwise the pages are copies of one another and show no template.
AGREEING, CONSTANT = 3, 0.25
#: Deeper elements stand beside, not inside, the element at this depth; their text stays.
DEEPEST = 200
#: Sibling lists whose lengths multiply to more are aligned by runs of equal labels.
WIDE = 40_000

# Element names of HTML and names that mark parts of a page.
ITEMS = frozenset("li dt dd tr td th caption figcaption".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset(
    "script style noscript template textarea title iframe svg select button head nav footer aside form object canvas "
    "audio video dialog menu fieldset datalist math map".split()
)
RAW = "script|style|textarea|title|iframe"
CLOSED_BY = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}
HOLDERS = frozenset("html body div article section main ul ol dl table td th blockquote aside nav header footer form figure".split())
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login related recommended recommendations share sharing social comment comments "
    "commentlist respond reply replies disqus footer masthead search widget widgets toolbar pagination pager skip".split()
)
NEUTRAL = frozenset(
    "area bar block bottom box button buttons container content group inner item items left link links list module outer "
    "page panel post posts right section site slot top unit wrap wrapper".split()
)
#: No class or role marks these, and these marked ones stay marked whatever they hold.
KEPT, ALWAYS = frozenset("#root html body main article".split()), frozenset("head nav footer aside menu script style title".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())

_ATTRIBUTES = r"""((?:"[^"]*"|'[^']*'|[^'">])*+)"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b{_ATTRIBUTES}>(?:.*?</(?P=raw)\s*+>|.*)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


class Node:
    __slots__ = ("tag", "label", "marked", "children", "kind")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children = tag, []
        self.label, self.marked = _named(tag, attributes) if attributes else (tag, tag in DROPPED)

    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]


@lru_cache(1 << 13)
def _named(tag: str, attributes: str) -> tuple[str, bool]:
    """Label of an element, and whether it is marked."""
    found = {k.lower(): v.strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)}
    names = re.findall(r"[a-z]+", found.get("class", "") + " " + found.get("id", ""))
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "")
    tokens = (found.get("class", "") + " " + found.get("id", "")).split()
    marked = tag in DROPPED or tag not in KEPT and (hidden or any(map(_marks, tokens)) or found.get("role") in ROLES)
    return " ".join([tag, *sorted(set(names))]), marked


def _marks(token: str) -> bool:
    """Whether a class or id as a whole names such a part: ``ad-box`` does, ``no-sidebar`` does not."""
    pieces = {p for p in re.split("[^a-z]+", token) if len(p) > 1}
    return not MARKS.isdisjoint(pieces) and pieces <= MARKS | NEUTRAL


def parse(page: str) -> Node:
    """A tree of elements and texts; anything unclosed ends with what holds it."""
    root = Node("#root")
    stack, at = [root], 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in HOLDERS and tag in INLINE:
                    break
            continue
        closes = CLOSED_BY.get(tag, frozenset() if tag in INLINE or tag in VOID else frozenset(["p"]))
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in closes:
                del stack[k:]
                break
            if stack[k].tag in HOLDERS:
                break
        node = Node(tag, m["attributes"])
        stack[-1].children.append(node)
        if tag not in VOID and not m["attributes"].endswith("/") and len(stack) < DEEPEST:
            stack.append(node)
    if at < len(page):
        stack[-1].children.append(page[at:])
    _unmark_holders(root)
    return root


def _unmark_holders(root: Node) -> None:
    """A marked node that holds the page itself is no part of it: most of its text with a main heading, or nearly all."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node.elements()
    held, heads = {}, {}
    for node in reversed(order):
        inner = [] if node.tag in ALWAYS else node.elements()
        own = 0 if node.tag in ALWAYS else sum(len("".join(c.split())) for c in node.children if isinstance(c, str))
        held[id(node)] = own + sum(held[id(c)] for c in inner)
        heads[id(node)] = node.tag in ("h1", "main", "article") or any(heads[id(c)] for c in inner)
    whole = held[id(root)]
    for node in order:
        if node.marked and node.tag not in ALWAYS and whole and held[id(node)] > whole * (0.5 if heads[id(node)] else 0.9):
            node.marked = False


def text_of(node: Node, dropped: frozenset | set = frozenset()) -> str:
    """Text below a node, without marked parts and those ``dropped`` by identity; blocks and white space are single spaces."""
    parts: list[str] = []
    todo: list = [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            parts.append(item)
            continue
        if item is not node and (item.marked or id(item) in dropped):
            parts.append(" ")
            continue
        inner = item.children
        if item.tag == "header":
            inner = [c for c in item.elements() if re.fullmatch("h[1-6]|hgroup", c.tag)]
        if item.tag in INLINE:
            todo.extend(reversed(inner))
        else:
            todo.append(" ")
            todo.extend(reversed(inner))
            todo.append(" ")
    return " ".join(entities.unescape("".join(parts)).split())


def matching(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Pairs of nodes that simple tree matching aligns: equal labels, order kept, as many as possible."""
    return Alignment().pairs(a, b)


class Alignment:
    """Simple tree matching. Subtrees of the same labels are of one kind, and what was found of two kinds holds for all such subtrees."""

    def __init__(self):
        self.numbers: dict[tuple, int] = {}
        self.kinds: list[tuple] = []
        self.sizes: dict[tuple[int, int], int] = {}
        self.ways: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def number(self, root: Node) -> None:
        order, todo = [], [root]
        while todo:
            node = todo.pop()
            order.append(node)
            todo += node.elements()
        for node in reversed(order):
            kind = (node.label, *[c.kind for c in node.elements()])
            node.kind = self.numbers.setdefault(kind, len(self.kinds))
            if node.kind == len(self.kinds):
                self.kinds.append(kind)

    def pairs(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        self.number(a)
        self.number(b)
        pairs, todo = [], [(a, b)]
        while todo:
            a, b = todo.pop()
            pairs.append((a, b))
            left, right = a.elements(), b.elements()
            todo += [(left[i], right[j]) for i, j in self._aligned(a.kind, b.kind)]
        return pairs

    def _size(self, a: int, b: int) -> int:
        """Nodes that the best matching of two trees aligns."""
        left, right = self.kinds[a], self.kinds[b]
        if left[0] != right[0]:
            return 0
        if (a, b) not in self.sizes:
            left, right = left[1:], right[1:]
            if len(left) * len(right) > WIDE:
                self.sizes[a, b] = 1 + sum(self._size(left[i], right[j]) for i, j in self._in_runs(left, right))
            else:
                self.sizes[a, b] = 1 + self._table(left, right)[-1][-1]
        return self.sizes[a, b]

    def _table(self, left: tuple, right: tuple) -> list[list[int]]:
        """Nodes aligned by the best matching of the first i and first j of two lists."""
        table = [[0] * (len(right) + 1)]
        for x in left:
            row, above = [0], table[-1]
            for j, y in enumerate(right):
                row.append(max(above[j + 1], row[j], above[j] + self._size(x, y)))
            table.append(row)
        return table

    def _in_runs(self, left: tuple, right: tuple) -> list[tuple[int, int]]:
        """Places in two long lists: runs of equal labels meet in order, and their nodes one by one."""
        a, b = ([list(run) for _, run in groupby(range(len(nodes)), key=lambda i: self.kinds[nodes[i]][0])] for nodes in (left, right))  # noqa: B023
        found, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            if self.kinds[left[a[i][0]]][0] == self.kinds[right[b[j][0]]][0]:
                found += zip(a[i], b[j])
                i, j = i + 1, j + 1
            elif len(a) - i > len(b) - j:
                i += 1
            else:
                j += 1
        return found

    def _aligned(self, a: int, b: int) -> list[tuple[int, int]]:
        """Places of the children that are aligned where two nodes are."""
        if (a, b) not in self.ways:
            left, right = self.kinds[a][1:], self.kinds[b][1:]
            self.ways[a, b] = self._in_runs(left, right) if len(left) * len(right) > WIDE else self._traced(left, right)
        return self.ways[a, b]

    def _traced(self, left: tuple, right: tuple) -> list[tuple[int, int]]:
        table = self._table(left, right)
        i, j, found = len(left), len(right), []
        while i and j:
            size = self._size(left[i - 1], right[j - 1])
            if size and table[i][j] == table[i - 1][j - 1] + size:
                found.append((i - 1, j - 1))
                i, j = i - 1, j - 1
            elif table[i][j] == table[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return found


class Draft:
    """What pages aligned with a model, one of them, show of their template. Nodes go by their place in the model.

    ``slots`` are the nodes whose own text varies or below which a page has more,
    ``tight`` the blocks that read the same on all pages. For the nodes ``tracked``,
    which alone can hold the content, ``seen`` and ``length`` are the pages that have
    them and their text in all, ``different`` up to ``AGREEING`` texts of different words.
    """

    def __init__(self, model: str, state: dict | None = None):
        self.root = parse(model)
        self.nodes, todo = [], [(self.root, False)]
        self.shown: list[bool] = []
        while todo:
            node, hidden = todo.pop()
            self.nodes.append(node)
            self.shown.append(not (hidden or node.marked))
            todo += [(c, hidden or node.marked) for c in node.elements()]
        self.place = {id(node): k for k, node in enumerate(self.nodes)}
        self.own = [_own(node) for node in self.nodes]
        blocks = (k for k, node in enumerate(self.nodes) if self.shown[k] and node.tag not in INLINE and node.tag not in ITEMS)
        texts = {k: text_of(self.nodes[k]) for k in blocks} if state is None else {k: text_of(self.nodes[k]) for k in state["tight"]}
        self.tight = {k: t for k, t in texts.items() if t}
        state = state or {"pages": 0, "slots": [], "tracked": [], "seen": [], "length": [], "different": []}
        self.pages, self.slots, self.tracked = state["pages"], set(state["slots"]), state["tracked"]
        self.seen, self.length = [0] * len(self.tracked), [0] * len(self.tracked)
        self.different = [[(t, set(t.split())) for t in texts] for texts in state["different"]]
        self.alignment = Alignment()

    def align(self, page: Node) -> dict[int, Node]:
        """The page's nodes by place, and what they show of slots and blocks."""
        if len(self.alignment.kinds) + len(self.alignment.sizes) > REMEMBERED:
            self.alignment = Alignment()
        pairs = self.alignment.pairs(self.root, page)
        met, held = {id(b) for _, b in pairs}, {self.place[id(a)]: b for a, b in pairs}
        for k, b in held.items():
            if self.shown[k] and k not in self.slots:
                if _own(b) != self.own[k] or any(id(c) not in met and not c.marked and text_of(c) for c in b.elements()):
                    self.slots.add(k)
        for k in [k for k, text in self.tight.items() if k not in held or text_of(held[k]) != text]:
            del self.tight[k]
        self.pages += 1
        return held

    def track(self) -> None:
        """From now on the nodes on the path are weighed; more pages can only shorten it. Without a slot any block may come to be on it."""
        on_path = self.path()[1]
        if not self._varies(self.root):
            on_path = [node for k, node in enumerate(self.nodes) if self.shown[k] and node.tag not in INLINE]
        self.tracked = [self.place[id(node)] for node in on_path]
        self.seen, self.length = [0] * len(self.tracked), [0] * len(self.tracked)
        self.different = [[] for _ in self.tracked]

    def weigh(self, held: dict[int, Node]) -> None:
        """Count the text of the tracked nodes; without a block left that reads the same there is no need."""
        for i, k in enumerate(self.tracked if self.tight else ()):
            if k in held:
                whole = text_of(held[k])
                self.seen[i] += 1
                self.length[i] += len(whole)
                _add_different(self.different[i], whole)

    def state(self) -> dict:
        different = [[t for t, _ in known] for known in self.different]
        return {
            "pages": self.pages, "slots": sorted(self.slots), "tight": sorted(self.tight), "tracked": self.tracked, "seen": self.seen,
            "length": self.length, "different": different,
        }

    def _varies(self, node: Node) -> bool:
        """Whether a node or one below it is a slot; the text of a single page all is."""
        todo = [node]
        while todo:
            one = todo.pop()
            if not one.marked:
                if self._is_slot(one):
                    return True
                todo += one.elements()
        return False

    def _is_slot(self, node: Node) -> bool:
        k = self.place[id(node)]
        return bool(self.own[k]) if self.pages == 1 else k in self.slots

    def path(self) -> tuple[list[dict], list[Node]]:
        """Levels from the root to the deepest node that holds all slots, and the nodes on the way."""
        path, way = [], [self.root]
        while not self._is_slot(way[-1]):
            inner = way[-1].elements()
            holding = [i for i, c in enumerate(inner) if self._varies(c)]
            if len(holding) != 1 or inner[holding[0]].tag in INLINE | {"p", "li", "td", "pre", "blockquote"}:
                break
            path.append({"labels": [c.label for c in inner], "at": holding[0]})
            way.append(inner[holding[0]])
        return path, way

    def wrapper(self) -> dict:
        path, way = self.path()
        return {"path": path, "constant": self._constants(way[-1])}

    def _constants(self, content: Node) -> list:
        """Label paths below the content node, and texts, of the blocks that read the same on all pages."""
        i = self.tracked.index(self.place[id(content)])
        if len(self.different[i]) < AGREEING:
            return []
        found, todo = [], [(c, [c.label]) for c in content.elements()]
        while todo:
            node, labels = todo.pop()
            if node.marked or node.tag in INLINE or node.tag in ITEMS:
                continue
            text = self.tight.get(self.place[id(node)])
            if text is not None:
                found.append([labels, text])
            else:
                todo += [(c, [*labels, c.label]) for c in node.elements()]
        return sorted(found) if sum(len(t) for _, t in found) * self.seen[i] <= CONSTANT * self.length[i] else []


def _own(node: Node) -> str:
    return " ".join(c for c in node.children if isinstance(c, str)).strip()


def _add_different(known: list[tuple[str, set]], whole: str) -> None:
    if len(known) < AGREEING:
        words = set(whole.split())
        if all(2 * len(words & other) < len(words | other) for _, other in known):
            known.append((whole, words))


def drafted(pages: list[str]) -> tuple[str, dict]:
    """The model, the one of middle length, and the state of the draft of a few pages laid out alike."""
    ordered = sorted(set(pages), key=lambda p: (len(p), p))
    model = ordered[len(ordered) // 2]
    draft = Draft(model)
    aligned = [draft.align(parse(p)) for p in ordered]
    draft.track()
    for held in aligned:
        draft.weigh(held)
    return model, draft.state()


def completed(model: str, states: list[dict]) -> dict:
    """The wrapper by all that was found, for one model, in the parts of a layout's pages."""
    first = states[0]
    draft = Draft(model, {**first, "tight": sorted(set(first["tight"]).intersection(*(s["tight"] for s in states)))})
    for state in states:
        draft.slots.update(state["slots"])
        for i in range(len(draft.tracked)):
            draft.seen[i] += state["seen"][i]
            draft.length[i] += state["length"][i]
            for text in state["different"][i]:
                _add_different(draft.different[i], text)
    return draft.wrapper()


def induce(pages: list[str]) -> dict:
    """The wrapper of pages laid out alike.

    ``path`` has, for each level, the labels of the children and the place of the
    next node; ``constant`` the template inside the node that it leads to, as
    label paths from there with their texts. Both are empty if no page has text
    outside marked parts.
    """
    if not pages:
        return {"path": [], "constant": []}
    model, state = drafted(pages)
    return completed(model, [state])


def extract(page: str, wrapper: dict) -> str:
    """Main text of a page. Where the page leaves the wrapper's path, the text below the last node that it reached."""
    node = parse(page)
    for level in wrapper["path"]:
        inner = node.elements()
        wanted = level["labels"][level["at"]]
        found = None
        for block in SequenceMatcher(None, level["labels"], [c.label for c in inner], autojunk=False).get_matching_blocks():
            if block.a <= level["at"] < block.a + block.size:
                found = inner[block.b + level["at"] - block.a]
        if found is None:
            found = max((c for c in inner if c.label == wanted), key=lambda c: len(text_of(c)), default=None)
        if found is None:
            found = max((c for c in inner if c.tag == wanted.split()[0] and not c.marked), key=lambda c: len(text_of(c)), default=None)
        if found is None:
            return text_of(node)
        node = found
    return text_of(node, _template(node, wrapper["constant"]))


def _template(content: Node, constant: list) -> set:
    """The nodes below ``content`` that are constant parts."""
    known: dict[tuple, set] = {}
    for labels, text in constant:
        known.setdefault(tuple(labels), set()).add(text)
    prefixes = {labels[:k] for labels in known for k in range(1, len(labels))}
    found, todo = set(), [(content, ())]
    while todo:
        node, labels = todo.pop()
        for c in node.elements():
            own = (*labels, c.label)
            if own in known and text_of(c) in known[own]:
                found.add(id(c))
            elif own in prefixes:
                todo.append((c, own))
    return found


def layout(page: str) -> str:
    """What pages of one layout have in common: the labels on the way down to the first
    article, or to the first level with several unmarked blocks and the different labels of those."""
    node, way = parse(page), []
    while node.tag not in ("article", "main"):
        blocks = [c for c in node.elements() if not c.marked and c.tag not in INLINE and c.tag not in VOID]
        if len(blocks) != 1 or blocks[0].tag not in HOLDERS:
            return " > ".join([*way, *sorted({c.label for c in blocks})])
        node = blocks[0]
        way.append(node.label)
    return " > ".join(way)


def host(url: str = "url"):
    """Host of an address in lower case; the empty string where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def laid_out(pages: DataFrame) -> DataFrame:
    """``pages`` with ``host`` and ``layout``; a null page has the empty layout."""
    return with_columns(pages.withColumn("host", host()), lambda batch: [[layout(p) if p else "" for p in strings(batch, "html")]], "layout string")


def wrappers(pages: DataFrame) -> DataFrame:
    """``host``, ``layout``, ``wrapper`` (JSON) for each layout of each host of ``pages`` (``html``, ``host``, ``layout``).

    ``ALIGNED`` different pages of a layout, those of the lowest hash, choose the
    model and make a first draft. Where a layout has more, every page of it is
    aligned with the model by the task that reads it; what the pages show is put
    together after. Null and empty pages are left out.
    """
    full = pages.where("html <> ''").select("host", "layout", "html", F.xxhash64("html").alias("key"))
    first = F.row_number().over(Window.partitionBy("host", "layout").orderBy("key"))
    chosen = full.select("host", "layout", "key").distinct().select("*", first.alias("n")).where(F.col("n") <= ALIGNED + 1)
    # Written out, so that Spark knows its size: pages move for a join only if there are too many to send around.
    chosen = stored(chosen, "chosen")
    sample = full.join(chosen, ["host", "layout", "key"]).dropDuplicates(["host", "layout", "key"]).select("host", "layout", "html", "n")

    def draft(rows: pa.Table) -> pa.Table:
        model, state = drafted([p for p, n in zip(*(rows.column(c).to_pylist() for c in ("html", "n"))) if n <= ALIGNED])
        made = rows.slice(0, 1).select(["host", "layout"]).append_column("model", [[model]]).append_column("state", [[json.dumps(state)]])
        return made.append_column("more", [[rows.num_rows > ALIGNED]])

    fields = "host string, layout string, model string, state string"
    drafts = stored(sample.groupBy("host", "layout").applyInArrow(draft, fields + ", more boolean"), "drafts")
    large = drafts.where("more").drop("more")
    size = large.agg(F.sum(F.length("model") + F.length("state"))).first()[0] or 0
    if size:
        rest = full.drop("key").join(F.broadcast(large) if size <= SENT else large, ["host", "layout"])
        shown = rest.select("host", "layout", "html", "model", "state").mapInArrow(_aligned_with_models, "host string, layout string, state string")
        parts = stored(shown, "shown").select("host", "layout", F.lit(None).cast("string").alias("model"), "state")
        small = drafts.where("not more").drop("more")
        drafts = small.unionAll(large.select("host", "layout", "model", F.lit(None).cast("string").alias("state"))).unionAll(parts)

    def complete(rows: pa.Table) -> pa.Table:
        model = next(m for m in rows.column("model").to_pylist() if m is not None)
        made = completed(model, [json.loads(s) for s in sorted(s for s in rows.column("state").to_pylist() if s is not None)])
        return rows.slice(0, 1).select(["host", "layout"]).append_column("wrapper", [[json.dumps(made)]])

    return drafts.select("host", "layout", "model", "state").groupBy("host", "layout").applyInArrow(complete, "host string, layout string, wrapper string")


def _aligned_with_models(batches):
    """What the pages of each layout show in a task; it holds the drafts of ``HELD`` layouts at once."""
    drafts: dict[tuple, Draft] = {}

    def told(items: list) -> pa.RecordBatch:
        columns = [[host for (host, _), _ in items], [layout for (_, layout), _ in items], [json.dumps(d.state()) for _, d in items]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["host", "layout", "state"])

    for batch in batches:
        for i in range(0, batch.num_rows, 64):
            for host, name, page, model, state in zip(*(c.to_pylist() for c in batch.slice(i, 64).columns)):
                if (draft := drafts.pop((host, name), None)) is None:
                    if len(drafts) >= HELD:
                        oldest = next(iter(drafts))
                        yield told([(oldest, drafts.pop(oldest))])
                    draft = Draft(model, json.loads(state))
                drafts[host, name] = draft
                draft.weigh(draft.align(parse(page)))
    yield told([*drafts.items()])


def main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: ``page_id``, ``url`` and ``text``.

    A null or empty page, or one with nothing but marked parts, has the empty
    text. A null address is a host of its own. Repeated rows stay. Pages join
    the wrapper of their host and layout, which Spark sends to all tasks while
    the wrappers are few; beyond that a host with many pages is split by adaptive
    execution. Other columns are not read.
    """
    read = stored(laid_out(pages.select("page_id", "url", "html")), "laid_out", compression="zstd")
    joined = read.join(stored(wrappers(read), "wrappers"), ["host", "layout"], "left")

    def make(batch):
        known = {"": {"path": [], "constant": []}}
        out = []
        for page, wrapper in zip(strings(batch, "html"), strings(batch, "wrapper")):
            if wrapper not in known:
                known[wrapper] = json.loads(wrapper)
            out.append(extract(page, known[wrapper]) if page else "")
        return [out]

    return with_columns(joined, make, "text string", drop=("html", "host", "layout", "wrapper")).select("page_id", "url", "text")
