"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of a host.

The token streams of a host's pages are aligned one after the other. An element that only one side has becomes optional;
one that recurs, or stands in another order, becomes a repeated group with what lies between; text that differs becomes
a slot, text that is the same everywhere belongs to the template. Elements of one label are one node of the expression,
so its size follows from the variety of a host's pages and not from their number.

Tasks align the pages they read, so a host of any size leaves one expression a task; these are aligned in two rounds.
An expression counts, for every node, the pages, the text and the link text. From it follow the rules of a host: where
its articles lie, what is made of links, and which texts are template. What a page yields does not depend on the
order in which pages were aligned, since nodes are matched by label and all that the rules use is summed.
"""

import json
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidewire.llm.common import map_batches, schema_of, slices, stored, workers_find_package
from tidewire.llm.page_tree import INLINE, clean, is_article, is_header, is_main, is_out, name_of, tree

TEXT = "#"
#: Nodes of expressions that a task holds before it writes them out.
NODES = 200_000
#: First round: groups a host's partial expressions are dealt to.
LOTS = 256
#: Rules up to this size in all are sent to every executor; beyond it only those of the largest hosts, LOTS at most.
SENT = 32 << 20
#: Pages from which a text that never changes counts as template.
TEMPLATE = 5
#: Share of a page's text that an element must hold to be its main part, and of link text that makes a list of links.
MAIN_SHARE, LINK_SHARE = 0.7, 0.6
_SLOT = 0


class Wrapper:
    """A node of the expression. ``order`` and ``group`` are its parts: labels, and which lie in one repeated group."""

    __slots__ = ("count", "order", "group", "kids", "held", "chars", "links", "same", "seen")
    made = 0

    def __init__(self):
        self.count = self.chars = self.links = 0
        self.order, self.group, self.kids, self.held, self.same, self.seen = [], [], {}, {}, None, set()
        Wrapper.made += 1

    def part(self, label: str) -> "Wrapper":
        kid = self.kids.get(label)
        if kid is None:
            kid = self.kids[label] = Wrapper()
            self.held[label] = 0
        return kid

    def align(self, order: list[str], group: list[int]) -> None:
        self.order, self.group = aligned(self.order, self.group, order, group) if self.order else (order, group)

    def add_text(self, text: str, linked: bool) -> None:
        self.count += 1
        self.chars += len(text)
        self.links += len(text) * linked
        self.settle(text if len(text) <= 200 else hash_of(text))

    def settle(self, text) -> None:
        if self.same is None:
            self.same = text
        elif self.same != text:
            self.same = _SLOT

    def absorb(self, node: list) -> None:
        """Align an element of a page with this node."""
        self.count += 1
        kids = []
        for kid in node[2]:
            if type(kid) is tuple:
                if text := clean(kid[0]):
                    kids.append((TEXT, text, kid[1]))
            else:
                kids.append((kid[0], kid, False))
        shape = tuple([k[0] for k in kids])
        if shape not in self.seen:
            if len(self.seen) > 1000:
                self.seen.clear()
            self.seen.add(shape)
            self.align(*folded(shape, ()))
        for label in set(shape):
            self.part(label)
            self.held[label] += 1
        for label, kid, linked in kids:
            if label == TEXT:
                self.kids[label].add_text(kid, linked)
            else:
                self.kids[label].absorb(kid)

    def merge(self, other: "Wrapper") -> None:
        """Align two expressions."""
        self.count += other.count
        self.chars += other.chars
        self.links += other.links
        if other.same is not None:
            self.settle(other.same)
        if other.order:
            self.align(other.order, other.group)
        for label, kid in other.kids.items():
            self.part(label).merge(kid)
            self.held[label] += other.held[label]

    def plain(self) -> list:
        return [
            self.count, self.chars, self.links, self.same,
            [[label, group, self.held[label], self.kids[label].plain()] for label, group in zip(self.order, self.group)]]

    @classmethod
    def of(cls, plain: list) -> "Wrapper":
        made = cls()
        made.count, made.chars, made.links, made.same, parts = plain
        for label, group, held, kid in parts:
            made.order.append(label)
            made.group.append(group)
            made.held[label], made.kids[label] = held, cls.of(kid)
        return made

    def expression(self) -> str:
        """The expression as text: ``?`` optional, ``( )+`` repeated, ``_`` a text slot, quoted a text of the template."""
        made, open_ = [], -1
        for label, group in zip(self.order, self.group):
            if group != open_ and open_ >= 0:
                made.append(")+")
            if group != open_ and group >= 0:
                made.append("(")
            open_ = group
            kid = self.kids[label]
            if label == TEXT:
                text = json.dumps(kid.same, ensure_ascii=False) if kid.same != _SLOT else "_"
            else:
                text = f"<{label}>" + (f" {inner} </>" if (inner := kid.expression()) else "")
            made.append(text + ("?" if self.held[label] < self.count else ""))
        return " ".join(made + [")+"] * (open_ >= 0))


def hash_of(text: str) -> str:
    import hashlib

    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def folded(labels, sets) -> tuple[list[str], list[int]]:
    """Every label once, in order, with its repeated group (-1: none).

    A label that recurs, and each of ``sets``, is repeated with all that lies between its first and last place.
    """
    first, last = {}, {}
    for at, label in enumerate(labels):
        first.setdefault(label, at)
        last[label] = at
    spans = [(first[x], last[x]) for x in first if first[x] < last[x]]
    spans += [(min(first[x] for x in s), max(last[x] for x in s)) for s in sets]
    merged = []
    for low, high in sorted(spans):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], high)
        else:
            merged.append([low, high])
    order, group, at = list(first), [], 0
    for label in order:
        while at < len(merged) and merged[at][1] < first[label]:
            at += 1
        group.append(at if at < len(merged) and merged[at][0] <= first[label] else -1)
    return order, group


def aligned(order: list[str], group: list[int], other: list[str], groups: list[int]) -> tuple[list[str], list[int]]:
    """Two part lists on their longest common subsequence; labels that stand crosswise become repeated."""
    places = {label: at for at, label in enumerate(order)}
    tails, ends, before = [], [], {}
    for label in other:  # rising places: every label occurs once in each list
        if (place := places.get(label)) is not None:
            at = bisect_left(tails, place)
            before[label] = ends[at - 1] if at else None
            if at == len(tails):
                tails.append(place)
                ends.append(label)
            else:
                tails[at], ends[at] = place, label
    matched, label = set(), ends[-1] if ends else None
    while label is not None:
        matched.add(label)
        label = before[label]
    labels, at = [], 0
    for label in other:
        if label in matched:
            labels += order[at:places[label] + 1]
            at = places[label] + 1
        else:
            labels.append(label)
    labels += order[at:]
    sets = {}
    for side, (names, numbers) in enumerate(((order, group), (other, groups))):
        for label, number in zip(names, numbers):
            if number >= 0:
                sets.setdefault((side, number), []).append(label)
    return folded(labels, sets.values())


def rules_of(wrapper: Wrapper) -> dict:
    """What the expression of a host says about its articles; paths are labels joined by ``>``.

    ``kind``: the element that holds them (``article``, ``main``, or neither); ``root``: the smallest element that holds
    most of the text; ``open``: elements that look left out but hold an article; ``drop``: lists of links;
    ``same``: texts of the template.
    """
    text = {"article": 0, "main": 0, "all": 0}
    made = {"kind": "", "root": "", "open": [], "drop": [], "same": {}}

    def holds(node: Wrapper) -> bool:
        return any(
            x != TEXT and (is_article(x) or is_main(x) or name_of(x) == "h1" or not is_out(x) and holds(k))
            for x, k in node.kids.items())

    weights: dict[int, int] = {}

    def walk(node: Wrapper, path: str, inside: frozenset) -> tuple[int, int]:
        total = linked = 0
        for label, kid in node.kids.items():
            if label == TEXT:
                total += kid.chars
                linked += kid.links
                if kid.same != _SLOT and kid.count >= TEMPLATE and name_of(path.rpartition(">")[2]) not in ("h1", "h2"):
                    made["same"][path] = kid.same
                continue
            at = f"{path}>{label}"
            if is_out(label) or is_header(label) and "article" not in inside:
                if name_of(label) in ("div", "section", "header", "td") and holds(kid):
                    made["open"].append(at)
                else:
                    continue
            now = inside | ({"article"} if is_article(label) else {"main"} if is_main(label) else set())
            chars, links = walk(kid, at, now)
            if chars and links > LINK_SHARE * chars and not now and name_of(label) not in ("h1", "h2", "h3", "h4"):
                made["drop"].append(at)
                continue
            total += chars
            linked += links
            for kind in now - inside:
                text[kind] += chars - links
        weights[id(node)] = total - linked
        return total, linked

    text["all"] = max(1, (lambda t: t[0] - t[1])(walk(wrapper, "", frozenset())))
    made["kind"] = next((k for k in ("article", "main") if text[k] * 4 >= text["all"]), "")
    node, path = wrapper, ""
    while True:
        inner = [
            (weights.get(id(k), 0), x) for x, k in node.kids.items()
            if x != TEXT and name_of(x) in ("html", "body", "div", "section", "table", "tbody", "tr", "td", "center", "main", "article")]
        weight, label = max(inner, default=(0, ""))
        if not weight or weight < MAIN_SHARE * weights.get(id(node), 0):
            break
        node, path = node.kids[label], f"{path}>{label}"
    made["root"] = path
    slots = text["all"] - sum(len(t) for t in made["same"].values())
    if slots <= 1:
        made["same"] = {}
    return made


@lru_cache(maxsize=2000)
def _ready(rules: str) -> dict:
    made = json.loads(rules)
    return {**made, "open": frozenset(made["open"]), "drop": frozenset(made["drop"])}


def main_text(html: str, rules: dict) -> str:
    """The article of a page: its blocks of text, joined by an empty line."""
    found: dict[str, list[str]] = {"article": [], "main": [], "root": [], "all": []}
    open_, drop, same, root = rules["open"], rules["drop"], rules["same"], rules["root"]
    held: list[str] = []
    within: tuple = ("all",)

    def flush() -> None:
        if held:
            if text := clean("".join(held)):
                for kind in within:
                    found[kind].append(text)
            held.clear()

    # Depth first: a node's text runs and its elements in the order of the page.
    todo = [(iter(tree(html)[2]), "", within)]
    while todo:
        kids, path, within = todo[-1]
        for kid in kids:
            if type(kid) is tuple:
                text = kid[0]
                if path in same and (known := clean(text)) and same[path] in (known, hash_of(known) if len(known) > 200 else known):
                    continue
                held.append(text)
                continue
            label = kid[0]
            below = f"{path}>{label}"
            if (is_out(label) or is_header(label) and "article" not in within) and below not in open_ or below in drop and within == ("all",):
                if kid[1] not in INLINE:
                    flush()
                continue
            flush()
            inner = within
            if is_article(label) and "article" not in within:
                inner += ("article",)
            if is_main(label) and "main" not in within:
                inner += ("main",)
            if below == root and "root" not in within:
                inner += ("root",)
            todo.append((iter(kid[2]), below, inner))
            break
        else:
            flush()
            todo.pop()
    order = {"article": ("article", "main", "root", "all"), "main": ("main", "article", "root", "all")}.get(
        rules["kind"], ("root", "all"))
    return "\n\n".join(next((found[k] for k in order if found[k]), []))


def host_of(url: str) -> Column:
    """Host of an address in lower case, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def wrappers(pages: DataFrame) -> DataFrame:
    """Stored ``host, n_pages, expression, rules, wrapper`` of every host with a page that is not null."""
    keep = pages.where("html IS NOT NULL").select(host_of("url").alias("host"), "html")
    schema = schema_of(keep, ["host"], "lot long, wrapper string")

    def run(batches):
        part, seq, held = TaskContext.get().partitionId(), 0, {}

        def rows():
            lots = [part << 32 | seq] * len(held)
            return pa.RecordBatch.from_arrays([
                pa.array(list(held), pa.string()), pa.array(lots, pa.int64()),
                pa.array([json.dumps(w.plain()) for w in held.values()], pa.string())], names=schema.names)

        Wrapper.made = 0
        for batch in batches:
            for piece, texts in slices(batch, "html"):
                for host, html in zip(piece.column(0).to_pylist(), texts):
                    if (wrapper := held.get(host)) is None:
                        wrapper = held[host] = Wrapper()
                    wrapper.absorb(tree(html))
                    if Wrapper.made > NODES:
                        yield rows()
                        held, seq, Wrapper.made = {}, seq + 1, 0
        if held:
            yield rows()

    def together(table: pa.Table) -> Wrapper:
        whole = None
        for _, plain in sorted(zip(table.column("lot").to_pylist(), table.column("wrapper").to_pylist())):
            made = Wrapper.of(json.loads(plain))
            if whole is None:
                whole = made
            else:
                whole.merge(made)
        return whole

    def first(table: pa.Table) -> pa.Table:
        return pa.table({"host": table.column("host")[:1], "lot": table.column("lot")[:1], "wrapper": pa.array(
            [json.dumps(together(table).plain())])})

    def second(table: pa.Table) -> pa.Table:
        whole = together(table)
        return pa.table({
            "host": table.column("host")[:1], "n_pages": pa.array([whole.count]), "expression": pa.array([whole.expression()]),
            "rules": pa.array([json.dumps(rules_of(whole))]), "wrapper": pa.array([json.dumps(whole.plain())])})

    workers_find_package(pages.sparkSession)
    partial = stored(map_batches(keep, run, schema), "wrapper-parts")
    lots = partial.withColumn("of", F.pmod(F.xxhash64("lot"), F.lit(LOTS)))
    some = lots.groupBy("host", "of").applyInArrow(first, schema)
    return stored(some.groupBy("host").applyInArrow(
        second, "host string, n_pages long, expression string, rules string, wrapper string"), "wrappers")


def extract_articles(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, one row per input row.

    The text is the page's article: its blocks in order, character references decoded, white space inside a block as
    one blank, joined by two line feeds. It has no menus, headers, footers, sidebars, notices, adverts, forms, scripts,
    reader comments or texts that all pages of the host repeat word for word. The place of the article is that of the
    host's wrapper: ``article``, else ``main``, else the smallest element that holds most of the text; a page without
    it yields what is left of its body.

    A null page is empty and has an empty text; repeated rows yield each; an address without a host, or null, belongs to
    the host of empty name; an empty table gives no rows; other columns are ignored. Pages may be of any length;
    elements nested deeper than 150 belong to the one at that depth.
    """
    known = wrappers(pages).select("host", "n_pages", "rules")
    size = known.agg(F.coalesce(F.sum(F.length("rules") + F.length("host")), F.lit(0)), F.coalesce(F.sum("n_pages"), F.lit(0))).first()
    rows = pages.select("page_id", "url", "html", host_of("url").alias("host"))
    if size[0] <= SENT:
        joined = rows.join(F.broadcast(known.drop("n_pages")), "host", "left")
    else:  # hosts with more than a LOTS-th of all pages, fewer than LOTS of them, do not pass the shuffle
        large = known.where(F.col("n_pages") * LOTS > size[1]).drop("n_pages")
        sent = rows.join(F.broadcast(large), "host")
        others = rows.join(F.broadcast(large.select("host")), "host", "left_anti").join(known.drop("n_pages"), "host", "left")
        joined = sent.unionByName(others)
    joined = joined.select("page_id", "url", "html", "rules")
    schema = schema_of(joined, ["page_id", "url"], "text string, n_chars long")
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for piece, texts in slices(batch, "html"):
                made = [main_text(t, _ready(r)) if t and r else "" for t, r in zip(texts, piece.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(made, pa.string()), pa.array(list(map(len, made)), pa.int64())],
                    names=arrow.names)

    return map_batches(joined, run, schema)
