"""Main-text extraction by wrappers: union-free regular expressions inferred per host.

1. Each page becomes a stream of block tags (with their class words) and text slots; inline tags belong to the text.
   Adjacent equal groups fold into repeated groups, so a page is a short expression such as
   ``<nav> <ul> ( <li> # )+ </ul> </nav> <article> ( <h1> # )+ ( <p> # )+ </article>``.
   Tasks count equal expressions per host and sum each slot's characters, link characters and text hashes, so a host
   with a third of all pages becomes a few rows before anything is shuffled.
2. Per host (first in ``SALTS`` parts, then their results) the expressions are aligned one after the other: equal
   tags and groups meet, what has no counterpart becomes optional, groups merge inside. The result is the wrapper.
3. Every page is aligned with its host's wrapper and judged by its own layout, once per distinct expression and task: its
   main slots are those in its article element, else its main element, else an element with a class word for content.
   A layout without any of these is judged by what the wrapper knows of the slots' texts over the host: constant over
   distinct pages (copies of a page count once), mostly links, or outside the part that holds most of the text. If
   all text is constant, it stays. Class words and forms around the main or article element or around most of the text
   do not make that boilerplate.
4. A page gives the texts in its main slots. Wrappers are joined to pages by host; adaptive execution splits a hot host or
   broadcasts measured small tables.

Defined results: null or empty html gives an empty text; a cut-off tag, comment or script at the end is dropped
(text after a '<' that no '>' follows); '</' before a non-letter is a comment up to '>'; <svg .../> ends itself;
character references are decoded once; a br counts as white space, other inline tags as nothing; a page whose url
is null or has no host belongs to the host ''; repeated rows give repeated rows. Extra columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from difflib import SequenceMatcher
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import grouped, materialise, prepare, shuffle_partitions, slices

SALTS = 16
MAX_PERIOD = 16
# Expressions a task counts before it hands them on.
HELD_EXPRESSIONS = 5000
# So many distinct pages must hold a text that never changes before it counts as part of a template.
TEMPLATE_PAGES = 3

_CONTAINERS = frozenset("html head body main article section nav header footer aside div ul ol dl table thead tbody tfoot form fieldset "
                        "figure blockquote details dialog menu address center select button video audio object".split())
# block tags whose end is optional or implied: the next block begins where they end
_LEAVES = frozenset("p li dt dd h1 h2 h3 h4 h5 h6 tr td th pre caption figcaption summary legend option hr title optgroup".split())
_RAW = frozenset("script style textarea title noscript template iframe svg xmp noembed noframes".split())
_BOILERPLATE = frozenset("head nav footer aside form menu dialog button select fieldset object video audio title option".split())
_MAIN_HINT = re.compile(r"(?:^|[.\-_])(?:article|post|entry|story|content|main)(?:[\-_]?(?:body|text|content))?(?:$|[.\-_])")
_BOILERPLATE_HINT = re.compile(
    r"(?:^|[.\-_])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|gdpr|notices?|alert|popup|modal|"
    r"newsletter|subscribe|signup|share|sharing|social|sidebar|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|"
    r"comments?|commentlist|replies|reply|respond|disqus|related|recommended|widgets?|login|search|pagination|pager|toolbar|skip|hidden)(?:$|[.\-_])")

# a hint after these, or between another word and one of those, tells of an element elsewhere: has-sidebar, content-sidebar-wrap
_BEFORE_MENTION, _AFTER_MENTION = frozenset("has no with without".split()), frozenset("wrap wrapper container".split())

# whoever speaks there, it is not the article
_COMMENTS = frozenset("comment comments commentlist replies reply respond disqus".split())
_TITLE_OF = frozenset("article post entry story content".split())

# comment, declaration, '</' before a non-letter up to '>', tag; a quote opens a value only after '=', and only if it closes
_TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++)?)?|=)*+(?=>)|[^>]*+)>"""
                    r"""|<(?=[a-zA-Z/])""", re.S)
_WORDS_OF = re.compile(r"(?:^|\s)(class|id|role|hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)


# ---- a page as tokens ----------------------------------------------------------------------------------------


def _label(tag: str, attributes: str) -> str:
    """The tag and its class, id and role words, without digits; ``hidden`` where it is not shown."""
    if not attributes.strip():
        return tag
    words = []
    for m in _WORDS_OF.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            words.append("hidden")
        elif name != "style":
            words += re.sub(r"[^a-z_\-\s]", "", value.lower()).split()
    return ".".join([tag, *dict.fromkeys(w for w in words if w)])


def tokens(page: str) -> Iterator[tuple[str, str, int]]:
    """(token, text, link characters): ``<label>``, ``</tag>`` with no text, or ``#`` with the decoded text of a block."""
    out: list[str] = []
    in_link, linked = False, 0
    at, end = 0, len(page)

    def text():
        nonlocal out, linked
        block = " ".join("".join(out).split())
        out, n, linked = [], linked, 0
        return [("#", block, min(n, len(block)))] if block else []

    while at < end:
        m = _TOKEN.search(page, at)
        run = page[at:m.start() if m else end]
        if run:
            run = html.unescape(run) if "&" in run else run
            out.append(run)
            linked += len(run) if in_link else 0
        if m is None:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0] == "<":  # no '>' follows
                break
            continue
        tag = tag.lower()
        if tag == "svg" and m[3].endswith("/"):
            continue
        if not m[1] and tag in _RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag == "br":
            out.append(" ")
        elif tag == "a":
            in_link = not m[1]
        elif tag in _CONTAINERS:
            yield from text()
            in_link = False
            yield (f"</{tag}>" if m[1] else f"<{_label(tag, m[3])}>"), "", 0
        elif tag in _LEAVES:
            yield from text()
            in_link = False
            if not m[1]:
                yield f"<{_label(tag, m[3])}>", "", 0
    yield from text()


# ---- folding into expressions --------------------------------------------------------------------------------


@dataclass
class _Part:
    """A token or a repeated group, and the texts of each of its slots."""

    key: str
    slots: list[list[int]]


def fold(stream: list[str]) -> tuple[str, list[list[int]]]:
    """The expression of a token stream, and for each of its slots the numbers of the texts in it."""
    parts, n, i = [], 0, 0
    while i < len(stream):
        token = stream[i]
        if token != "#" and not token.startswith("</") and i + 1 < len(stream) and stream[i + 1] == "#" and _tag(token) in _LEAVES:
            parts.append(_Part(f"( {token} # )+", [[n]]))
            n, i = n + 1, i + 2
            continue
        parts.append(_Part(token, [[n]] if token == "#" else []))
        n, i = n + (token == "#"), i + 1
    changed = True
    while changed:
        changed = False
        for period in range(1, MAX_PERIOD + 1):
            keys = [p.key for p in parts]
            out, i = [], 0
            while i < len(parts):
                again = i + period
                while keys[i:i + period] == keys[again:again + period] and again + period <= len(parts):
                    again += period
                if again == i + period or period == 1 and not keys[i].startswith("("):
                    out.append(parts[i])
                    i += 1
                    continue
                for j in range(i + period, again):
                    for mine, theirs in zip(parts[i + (j - i) % period].slots, parts[j].slots, strict=True):
                        mine += theirs
                group = parts[i:i + period]
                key = group[0].key if period == 1 else "( " + " ".join(p.key for p in group) + " )+"
                out.append(_Part(key, [s for p in group for s in p.slots]))
                i, changed = again, True
            parts = out
    return " ".join(p.key for p in parts), [s for p in parts for s in p.slots]


def _tag(token: str) -> str:
    return token.strip("</>").partition(".")[0]


# ---- wrappers ------------------------------------------------------------------------------------------------


@dataclass
class Node:
    """A tag, a text slot or a repeated group of a wrapper; ``pages`` and so on are a slot's sums."""

    token: str  # "" for a group
    optional: bool = False
    body: list[Node] = field(default_factory=list)
    pages: int = 0
    chars: int = 0
    links: int = 0
    low: int = 0
    high: int = 0
    seen: list[int] = field(default_factory=list)  # the least marks of distinct pages with it, at most TEMPLATE_PAGES

    @property
    def key(self) -> str:
        return self.token or "(" + self.body[0].key

    def plain(self) -> list:
        return [self.token, int(self.optional), [b.plain() for b in self.body], self.pages, self.chars, self.links, self.low, self.high, self.seen]

    @staticmethod
    def of(x: list) -> Node:
        return Node(x[0], bool(x[1]), [Node.of(b) for b in x[2]], *x[3:])

    def text(self) -> str:
        inner = self.token or "( " + " ".join(b.text() for b in self.body) + " )+"
        return f"( {inner} )?" if self.optional else inner


def parse(expression: str) -> list[Node]:
    stack: list[list[Node]] = [[]]
    for token in expression.split():
        if token == "(":
            stack.append([])
        elif token == ")+":
            body = stack.pop()
            stack[-1].append(Node("", body=body))
        else:
            stack[-1].append(Node(token))
    return stack[0]


def slots(nodes: list[Node]) -> Iterator[Node]:
    for node in nodes:
        if node.token == "#":
            yield node
        yield from slots(node.body)


def least(a: list[int], b: list[int]) -> list[int]:
    """The least distinct marks of both, at most TEMPLATE_PAGES."""
    return sorted({*a, *b})[:TEMPLATE_PAGES]


def _matches(a: list[Node], b: list[Node]):
    """Runs (start in a, start in b, length) of nodes that meet: common ends first, then the longest common runs."""
    ka, kb = [n.key for n in a], [n.key for n in b]
    head = 0
    while head < min(len(ka), len(kb)) and ka[head] == kb[head]:
        head += 1
    tail = 0
    while tail < min(len(ka), len(kb)) - head and ka[-1 - tail] == kb[-1 - tail]:
        tail += 1
    middle = SequenceMatcher(None, ka[head:len(ka) - tail], kb[head:len(kb) - tail], autojunk=False).get_matching_blocks()
    return [(0, 0, head), *((i + head, j + head, n) for i, j, n in middle if n), (len(a) - tail, len(b) - tail, tail)]


def merge(a: list[Node], b: list[Node]) -> list[Node]:
    """Align two wrappers: what meets is merged, what does not becomes optional."""
    out: list[Node] = []
    i = j = 0
    for mi, mj, n in [*_matches(a, b), (len(a), len(b), 0)]:
        for alone in (*a[i:mi], *b[j:mj]):
            alone.optional = True
            out.append(alone)
        for x, y in zip(a[mi:mi + n], b[mj:mj + n], strict=True):
            if x.token == "#":
                x.low, x.high = (min(x.low, y.low), max(x.high, y.high)) if x.pages and y.pages else (x.low, x.high) if x.pages else (y.low, y.high)
                x.pages, x.chars, x.links = x.pages + y.pages, x.chars + y.chars, x.links + y.links
                x.seen = least(x.seen, y.seen)
            elif not x.token:
                x.body = merge(x.body, y.body)
            x.optional |= y.optional
            out.append(x)
        i, j = mi + n, mj + n
    return out


def _hard(tag: str, inside: bool) -> bool:
    return tag in _BOILERPLATE and tag != "form" or tag == "header" and not inside


def _hints(words: str) -> Iterator[tuple[str, str]]:
    """The parts of class words that tell of boilerplate, each with the part before it."""
    for word in words.split("."):
        parts = ["", *re.split(r"[\-_]", word), ""]
        for before, part, after in zip(parts, parts[1:], parts[2:]):
            if _BOILERPLATE_HINT.fullmatch(part) and before not in _BEFORE_MENTION and not (before and after in _AFTER_MENTION):
                yield part, before


@lru_cache(maxsize=8192)
def _says_boilerplate(tag: str, words: str, inside: bool) -> bool:
    """Whether class words (or a form) say that what an element holds is no part of the article.

    A header inside an article or main element, or one named after an article, holds its title.
    """
    return tag == "form" or any(part != "header" or not (inside or before in _TITLE_OF) for part, before in _hints(words))


@lru_cache(maxsize=8192)
def _says_comments(label: str) -> bool:
    return any(part in _COMMENTS for part, _ in _hints(label.partition(".")[2]))


def _boilerplate(path: list[str], spared: frozenset[tuple] = frozenset()) -> bool:
    """Whether elements around a slot say that it is no part of the article; class words and forms of ``spared`` do not."""
    inside = False  # of an article: its own header holds its title
    for k, label in enumerate(path):
        tag, _, words = label.partition(".")
        if _hard(tag, inside) or tag not in ("body", "html", "main") and _says_boilerplate(tag, words, inside) and tuple(path[:k + 1]) not in spared:
            return True
        inside |= tag in ("article", "main")
    return False


def _paths(nodes: list[Node], path: list[str]) -> Iterator[tuple[Node, list[str]]]:
    """Each slot with the labels of the open elements around it, a leaf block's own label last."""
    own: list[str] = []
    for node in nodes:
        if not node.token:
            yield from _paths(node.body, path)
            own = []
        elif node.token == "#":
            yield node, path + own
        elif node.token.startswith("</"):
            own = []
            tag = node.token[2:-1]
            for k in range(len(path) - 1, -1, -1):
                if path[k].partition(".")[0] == tag:
                    del path[k:]
                    break
        elif _tag(node.token) in _LEAVES:
            own = [node.token[1:-1]]
        else:
            own = []
            path.append(node.token[1:-1])


def _in_tag(tag: str):
    return lambda path: any(label.partition(".")[0] == tag for label in path)


def _hinted(path: list[str]) -> bool:
    return any(_MAIN_HINT.search(label.partition(".")[2]) for label in path if "." in label)


def _weights(some: list[tuple[Node, list[str]]]) -> dict[tuple, float]:
    """By path of each element: the characters in it, as pages of the host have them on average."""
    weight: dict[tuple, float] = {}
    for n, p in some:
        for k in range(len(p) + 1):
            weight[tuple(p[:k])] = weight.get(tuple(p[:k]), 0) + n.chars / max(1, n.pages)
    return weight


def _live(some: list[tuple[Node, list[str]]]) -> list[tuple[Node, list[str]]]:
    """The slots that are neither mostly links nor, unless all are, constant over distinct pages."""
    free = [(n, p) for n, p in some if 2 * n.links <= n.chars]
    return [(n, p) for n, p in free if len(n.seen) < TEMPLATE_PAGES or n.low != n.high] or free


def _spared(found: list[tuple[Node, list[str]]]) -> tuple[frozenset[tuple], frozenset[tuple]]:
    """Elements that hold too much for their class words to count: for certain, and where nothing else is left.

    For certain: those around the main element; outside of main and article elements, those around 8 of 10 characters; and
    those that are or hold an article element with half of the characters. Else any around 8 of 10 characters or an article.
    What says that it holds comments is never spared.
    """
    around: dict[str, set[tuple]] = {"article": set(), "main": set()}
    within: set[tuple] = set()
    for _, p in found:
        for tag, prefixes in around.items():
            at = [k for k, label in enumerate(p) if label.partition(".")[0] == tag]
            if at:
                prefixes.update(tuple(p[:k + 1]) for k in range(at[-1] + 1))
                within.update(tuple(p[:k + 1]) for k in range(at[0] + 1, len(p)))
    weight = _weights(_live([(n, p) for n, p in found if not any(_hard(label.partition(".")[0], True) for label in p)]))
    total = weight.get((), 0)
    most = {k for k, v in weight.items() if 10 * v >= 8 * total > 0}
    half = {k for k in around["article"] if 2 * weight.get(k, 0) > total}
    certain, possible = around["main"] | half | most - within, around["main"] | around["article"] | most
    return tuple(frozenset(k for k in some if not k or not _says_comments(k[-1])) for some in (certain, possible))


def _articles(some: list[tuple[Node, list[str]]]) -> tuple[list[Node], set[int]]:
    """The slots of the article elements that make up the text: of those in one main element (or outside of any), the
    largest and any half as large; none if together they hold less than half of that element (or of the page). And the
    slots of articles with less than a quarter of it, which are cards or answers beside the text."""
    weight = _weights(some)
    of: dict[tuple, dict[tuple, list[Node]]] = {}
    for n, p in some:
        tags = [label.partition(".")[0] for label in p]
        if "article" in tags:
            main = tuple(p[:tags.index("main") + 1]) if "main" in tags else ()
            of.setdefault(main, {}).setdefault(tuple(p[:tags.index("article") + 1]), []).append(n)
    chosen, small = [], set()
    for main, articles in of.items():
        small.update(id(n) for a, nodes in articles.items() if 4 * weight[a] < weight[main] for n in nodes)
        most = max(weight[a] for a in articles)
        large = [a for a in articles if 2 * weight[a] >= most]
        if 2 * sum(weight[a] for a in large) >= weight[main]:
            chosen += [n for a in large for n in articles[a]]
    return chosen, small


def judge(found: list[tuple[Node, list[str]]]) -> list[bool]:
    """Whether each slot of one layout, given as what its host knows of it and the elements around it, is main text."""
    certain, possible = _spared(found)
    good = [(n, p) for n, p in found if not _boilerplate(p, certain)]
    wide = [(n, p) for n, p in found if not _boilerplate(p, possible)]
    main = _in_tag("main")
    chosen, small = _articles(good)
    if not chosen:
        good = [(n, p) for n, p in good if id(n) not in small] or good
        chosen = [n for n, p in good if main(p)] or _articles(wide)[0] or [n for n, p in wide if main(p)] or [n for n, p in good if _hinted(p)]
    if not chosen:
        live = _live(good)
        # the innermost element that holds most of what is left
        weight = _weights(live)
        total = weight.get((), 0)
        best = max((k for k, v in weight.items() if 10 * v >= 8 * total), key=len, default=()) if total else ()
        # the last label may be the leaf block itself; its like under the same parent belong to it
        best = best[:-1] if best and _tag(best[-1]) in _LEAVES else best
        chosen = [n for n, p in live if tuple(p[:len(best)]) == best]
    kept = {id(n) for n in chosen}
    return [id(n) in kept for n, _ in found]


def main_slots(expression: str, wrapper: list[Node]) -> list[bool]:
    """For each slot of an expression, whether it is main text, judged with its counterpart in the wrapper."""
    nodes = parse(expression)

    def meet(a: list[Node], b: list[Node]) -> None:
        for mi, mj, n in _matches(a, b):
            for x, y in zip(a[mi:mi + n], b[mj:mj + n], strict=True):
                if x.token == "#":
                    y.pages, y.chars, y.links, y.low, y.high, y.seen = x.pages, x.chars, x.links, x.low, x.high, x.seen
                elif not x.token:
                    meet(x.body, y.body)

    meet(wrapper, nodes)
    return judge([(node, list(path)) for node, path in _paths(nodes, [])])


# ---- Spark ---------------------------------------------------------------------------------------------------

_COUNTS = "host string, expression string, pages long, chars array<long>, links array<long>, low array<long>, high array<long>, seen array<long>"


def _read(page: str | None) -> tuple[str, list[list[int]], list[str], list[int]]:
    """The page's expression, the texts of its slots by number, the texts and their link characters."""
    stream = list(tokens(page or ""))
    expression, of = fold([t for t, _, _ in stream])
    return expression, of, [x for t, x, _ in stream if t == "#"], [n for t, _, n in stream if t == "#"]


def _count(batches):
    schema = pa.schema([("host", pa.string()), ("expression", pa.string()), ("pages", pa.int64()),
                        *((c, pa.list_(pa.int64())) for c in ("chars", "links", "low", "high", "seen"))])
    held: dict[tuple[str, str], list] = {}

    def flush():
        rows = [(h, e, n, *(x.tolist() for x in sums), seen) for (h, e), (n, *sums, seen) in held.items()]
        held.clear()
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        for some in slices(batch, "html"):
            for host, page in zip(some.column("host").to_pylist(), some.column("html").to_pylist(), strict=True):
                expression, of, found, linked = _read(page)
                chars = np.array([sum(len(found[i]) for i in s) for s in of], np.int64)
                links = np.array([sum(linked[i] for i in s) for s in of], np.int64)
                mark = np.array([zlib.crc32("\n".join(found[i] for i in s).encode()) for s in of], np.int64)
                page_mark = zlib.crc32("\n".join(found).encode(), zlib.crc32(expression.encode()))
                old = held.get((host, expression))
                if old is None:
                    held[host, expression] = [1, chars, links, mark, mark, [page_mark]]
                else:
                    old[0] += 1
                    old[1], old[2] = old[1] + chars, old[2] + links
                    old[3], old[4] = np.minimum(old[3], mark), np.maximum(old[4], mark)
                    old[5] = least(old[5], [page_mark])
            if len(held) > HELD_EXPRESSIONS:
                yield flush()
    yield flush()


def _partial_wrappers(batches):
    for table in grouped(batches, ["host_key", "salt"]):
        rows = table.to_pylist()
        for host in sorted({r["host"] for r in rows}):
            wrapper, pages = [], 0
            # frequent expressions first; the order is the same however the rows came
            for r in sorted((r for r in rows if r["host"] == host), key=lambda r: (-r["pages"], r["expression"], r["low"])):
                nodes = parse(r["expression"])
                for node, c, n, a, b in zip(slots(nodes), r["chars"], r["links"], r["low"], r["high"], strict=True):
                    node.pages, node.chars, node.links, node.low, node.high, node.seen = r["pages"], c, n, a, b, r["seen"]
                wrapper = merge(wrapper, nodes) if pages else nodes
                pages += r["pages"]
            yield pa.RecordBatch.from_pydict({"host": [host], "pages": [pages], "wrapper": [json.dumps([n.plain() for n in wrapper])]})


def _final_wrappers(batches):
    for table in grouped(batches, ["host_key"]):
        rows = table.to_pylist()
        for host in sorted({r["host"] for r in rows}):
            wrapper, pages = [], 0
            for r in sorted((r for r in rows if r["host"] == host), key=lambda r: (-r["pages"], r["wrapper"])):
                nodes = [Node.of(x) for x in json.loads(r["wrapper"])]
                wrapper = merge(wrapper, nodes) if pages else nodes
                pages += r["pages"]
            yield pa.RecordBatch.from_pydict({"host": [host], "pages": [pages], "expression": [" ".join(n.text() for n in wrapper)],
                                              "wrapper": [json.dumps([n.plain() for n in wrapper])]})


def _extract(batches):
    wrappers: dict[str, list[Node]] = {}
    verdicts: dict[tuple[str, str], list[bool]] = {}
    for batch in batches:
        for some in slices(batch, "html"):
            out = []
            for page, wrapper in zip(some.column("html").to_pylist(), some.column("wrapper").to_pylist(), strict=True):
                expression, of, found, _ = _read(page)
                if (wrapper, expression) not in verdicts:
                    if len(verdicts) > HELD_EXPRESSIONS:
                        verdicts.clear()
                        wrappers.clear()
                    if wrapper not in wrappers:
                        wrappers[wrapper] = [Node.of(x) for x in json.loads(wrapper)]
                    verdicts[wrapper, expression] = main_slots(expression, wrappers[wrapper])
                main = sorted(i for s, m in zip(of, verdicts[wrapper, expression], strict=True) if m for i in s)
                out.append(" ".join(found[i] for i in main))
            yield pa.RecordBatch.from_arrays([some.column("page_id"), some.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """``(host, pages, expression, wrapper)`` per host of ``pages(url, html)``; ``expression`` is readable."""
    spark = prepare(pages.sparkSession)
    n_part = shuffle_partitions(spark)
    seen = pages.select(host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")).mapInArrow(_count, _COUNTS)
    keyed = seen.select("*", F.xxhash64("host").alias("host_key"), F.pmod(F.xxhash64("expression"), F.lit(SALTS)).alias("salt"))
    partial = (keyed.repartition(n_part, "host_key", "salt").sortWithinPartitions("host_key", "salt")
               .mapInArrow(_partial_wrappers, "host string, pages long, wrapper string"))
    return (partial.withColumn("host_key", F.xxhash64("host")).repartition(n_part, "host_key").sortWithinPartitions("host_key")
            .mapInArrow(_final_wrappers, "host string, pages long, expression string, wrapper string"))


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text)`` per row of ``pages(page_id, url, html)``."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    wrappers = materialise(infer_wrappers(pages).select("host", "wrapper"), "wrappers")
    met = pages.withColumn("host", host_of(F.col("url"))).join(wrappers, "host", "left").select("page_id", "url", "html", "wrapper")
    return met.mapInArrow(_extract, f"page_id {dict(pages.dtypes)['page_id']}, url {dict(pages.dtypes)['url']}, text string")
