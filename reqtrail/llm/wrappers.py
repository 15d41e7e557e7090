"""HTML extraction by wrapper induction.

The pages of a host that share a layout (the containers where their tree first branches) are aligned with a wrapper tree, that of the page
with the least seeded hash among them, by simple tree matching; repeated siblings are one node, and a node that the wrapper lacks has its
labels below the last one that matches for a slot. Over all layouts, nodes with the same labels down from the root are one slot too, and
template found in one layout counts in all. A text that a slot has on nearly all pages, counted over pages with
different wordings (pages that differ only in digits are copies), is template; what varies is content of the node's slot. Menus, footers, asides, buttons and hidden
elements are not content either, nor are containers whose class or id is, as a whole, a name of such things (``DROPPED_WORDS``),
unless they hold an article or most of the page's text; inside an article only the names in ``AD_WORDS`` count, on containers
without headings or paragraphs. Where a page marks its article, and that holds enough of what varies on the page, only what is inside it is
content. Template is no content inside an article either, unless it is most of the article: such pages are copies with other surroundings.

Three passes, none of which moves pages between tasks: the tree of the least page of each layout (a minimum, taken in the map tasks); counts
of texts by slot; extraction. Wrappers and template slots are sorted hash arrays in the shared folder that
workers memory-map, so their own memory does not grow with the number of hosts and layouts.

Defined cases: null html is the empty page with empty text; pages without a host share a wrapper; broken markup is read on
like browsers do, unclosed elements end with their parents; texts of any length stay whole; repeated pages each give a row
and count once for the template; an empty table gives an empty result; other columns are not read.
"""
from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reqtrail.llm.common import materialize, mounted_path, offsets_of, shared_folder, slices
from reqtrail.llm.kneser_ney import Table, mixed, save, shard_of

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
LEAST_PAGES, SAME_SHARE = 3, 0.9  # pages with different wordings that a template needs; share of one text among them
MARKED = 1 / 3  # share of the varying text of a page that a marked article must hold to be all of the content
LAYOUTS, HELD = 20_000, 1 << 25  # wrappers in a shard; letters of trees that a map task holds
SMALL_TABLE = 1024  # cells of an alignment that is counted without arrays
DEEPEST = 100  # levels of the block tree; what lies deeper belongs to its ancestor there
LINKS = 0.5  # share of a block's letters in links, above which it is a menu on pages that mark no article

BLOCKS = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary "
                   "table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp template svg object canvas audio video".split())
DROPPED = frozenset("nav footer aside button select fieldset dialog menu head datalist".split())
DROPPED_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
                          "notice notices notification alert popup modal overlay newsletter subscribe subscription sidebar widget widgets related "
                          "recommended recommendations share sharing social comment comments commentlist disqus replies respond breadcrumb "
                          "breadcrumbs menu nav navbar navigation footer header masthead login signup search pagination pager toolbar "
                          "copyright legal disclaimer hidden".split())
#: Of these, what is no content inside an article either; and words that only say what part of a page a name is for.
AD_WORDS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo newsletter subscribe share sharing social "
                     "breadcrumb breadcrumbs navbar pagination pager".split())
PART_WORDS = frozenset("area block bottom box button buttons container footer group header icons inner items left link links list main navigation "
                       "outer page posts right section site top wrap wrapper".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())
LISTS = frozenset("ul ol menu dir dl li dt dd table hr figure legend caption".split())
MAIN_WORDS = frozenset("article content main post entry story".split())
#: Elements that a start tag closes, and those that stop the search for them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>?", re.S)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORD = re.compile(r"[A-Za-z]+")
DIGITS = re.compile(r"\d+")
NAME_PART = re.compile(r"[-_]+")


class Node:
    __slots__ = ("label", "children", "depth")

    def __init__(self, label: str, parent: Node | None):
        self.label, self.children, self.depth = label, [], parent.depth + 1 if parent else 0
        if parent is not None:
            parent.children.append(self)


def hashed(*parts) -> int:
    return xxhash.xxh64_intdigest("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"))


def attributes(raw: str) -> tuple[str, frozenset[str], frozenset[str], frozenset[str], str, bool]:
    """Class names as written, words of class and id, whole class names, these and the id, role, whether hidden."""
    classes, words, names, named, role, hidden = "", frozenset(), frozenset(), frozenset(), "", False
    for name, a, b, c in ATTRIBUTE.findall(raw):
        name, value = name.lower(), a or b or c
        if name in ("class", "id"):
            split = re.sub(r"([a-z])([A-Z])", r"\1 \2", value)
            classes += f".{value}" if name == "class" else ""
            words |= {w.lower() for w in WORD.findall(split)}
            if name == "class":
                names |= {n.lower() for n in value.split()}
            named |= {re.sub(r"([a-z])([A-Z])", r"\1-\2", n).lower() for n in value.split()}
        elif name == "role":
            role = value.lower()
        else:
            hidden |= name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and bool(re.search(r"display\s*:\s*none", value))
    return classes, words, names, named, role, hidden


@lru_cache(maxsize=10_000)
def names_chrome(name: str, inside: bool) -> bool:
    """Whether a class name or id is as a whole the name of something that is no content: such a word, alone or with words for parts."""
    words, wanted = NAME_PART.split(name), AD_WORDS if inside else DROPPED_WORDS
    return any(w in wanted for w in words) and all(w in wanted or w in PART_WORDS for w in words)


def parse(page: str) -> tuple[Node, list[tuple[str, Node, int, float]], str]:
    """Block tree; blocks (text, node, 2 inside an article element, 1 inside one named so, share in links) in order; title."""
    root = Node("", None)
    stack = [("", root, False, 0, ())]  # tag, block node, dropped, inside the article, containers named as no content around it
    blocks, buffer, links, title = [], [], 0, ""
    around: list[tuple[int, ...]] = []  # of each block, such containers
    inner: list[bool] = []  # of each such container, whether it is inside an article
    holds: list[bool] = []  # of each, whether it holds an article; or for one inside an article, prose
    state: list = [root, False, 0, ()]
    in_link = 0
    opened: Counter[str] = Counter()  # elements on the stack by tag

    def flush() -> None:
        nonlocal links
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                blocks.append((text, state[0], state[2], links / len(text)))
                around.append(state[3])
            buffer.clear()
        links = 0

    def pop(n: int) -> None:
        nonlocal in_link
        if any(s[0] in BLOCKS for s in stack[n:]):
            flush()
        in_link -= sum(s[0] == "a" for s in stack[n:])
        opened.subtract(s[0] for s in stack[n:])
        del stack[n:]
        state[:] = stack[-1][1:]

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        start = m.start() if m else size
        if start > at and not state[1]:
            text = page[at:start]
            text = html.unescape(text) if "&" in text else text
            buffer.append(text)
            if in_link:
                links += len(text.strip())
        if not m:
            break
        at = m.end()
        end, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    pop(i)
                    break
                if tag not in BLOCKS and stack[i][0] in BLOCKS:
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
            if tag == "title" and not title:
                title = " ".join(html.unescape(page[at:close.start() if close else size]).split())
            if not raw.rstrip().endswith("/"):
                at = close.end() if close else size
            continue
        if tag == "br":
            if not state[1]:
                buffer.append(" ")
            continue
        if tag in BLOCKS:
            closed, stop = CLOSES.get(tag, (frozenset(), frozenset()))
            closed = {*closed, "p"}
            stop = {*stop, "table", "td", "th", "button", "body", "article", "main", "section"} - {tag}
            for i in range(len(stack) - 1, 0, -1) if any(opened[t] for t in closed) else ():
                if stack[i][0] in stop and stack[i][0] not in closed:
                    break
                if stack[i][0] in closed:
                    pop(i)
                    if stack[-1][0] not in closed or tag not in CLOSES:
                        break
            flush()
        if tag in VOID:
            continue
        classes, words, names, named, role, hidden = attributes(raw) if raw.strip() else ("", frozenset(), frozenset(), frozenset(), "", False)
        node, dropped, inside, within = state
        own = tag not in ("html", "body", "article", "main")
        dropped = dropped or tag in DROPPED or hidden or tag == "header" and not inside \
            or own and role in ("navigation", "banner", "complementary", "contentinfo", "search") \
            or tag == "article" and bool(names & {"comment", "comments", "ad", "related"})
        if own and tag not in PROSE and len(within) < DEEPEST and (tag == "form" or any(names_chrome(n, inside == 2) for n in named)):
            within = (*within, len(holds))
            inner.append(inside == 2 and tag != "form")
            holds.append(False)
        elif within and not dropped and (tag in PROSE or tag in ("article", "main") or role == "main"):
            for i in within:
                holds[i] |= (tag in PROSE) == inner[i]
        if tag in ("article", "main") or role == "main":
            inside = 2
        elif tag in ("div", "section", "td") and words & MAIN_WORDS:
            inside = max(inside, 1)
        if tag in BLOCKS:
            node = Node(tag + classes, node) if node.depth < DEEPEST else node
        elif tag == "a":
            in_link += 1
        stack.append((tag, node, dropped, inside, within))
        opened[tag] += 1
        state[:] = stack[-1][1:]
    flush()
    if holds:
        letters = [0] * len(holds)
        for block, names in zip(blocks, around):
            for i in names:
                letters[i] += len(block[0])
        most = sum(len(block[0]) for block in blocks) / 2
        out = [not held and n <= most for held, n in zip(holds, letters)]
        blocks = [block for block, names in zip(blocks, around) if not any(out[i] for i in names)]
    return root, blocks, title


class Tree:
    """A block tree as nested lists [label, children, number]; runs of equal childless siblings are one node."""

    def __init__(self, root: Node):
        self.number: dict[int, int] = {}  # of a node by its identity
        self.labels: list[str] = []
        self.above: list[int] = []  # number of the parent
        self.paths: list[int] = []  # hash of the labels from the root
        self.top = self._fold(root, -1)

    def _fold(self, node: Node, above: int) -> list:
        out = [node.label, [], len(self.labels)]
        self.labels.append(node.label)
        self.above.append(above)
        self.paths.append(hashed(self.paths[above] if above >= 0 else "", node.label))
        self.number[id(node)] = out[2]
        for child in node.children:
            last = out[1][-1] if out[1] else None
            if not child.children and last is not None and last[0] == child.label and not last[1]:
                self.number[id(child)] = last[2]
            else:
                out[1].append(self._fold(child, out[2]))
        return out


def dumped(tree: list) -> str:
    return f"{tree[0]}\1{''.join(dumped(c) for c in tree[1])}\2"


def layout(tree: list) -> str:
    """The containers, without digits in their names, where a tree first has several."""
    while True:
        inner = [c for c in tree[1] if (tag := c[0].split(".")[0]) not in PROSE and tag not in LISTS and tag != "head"]
        if len(inner) != 1:
            return "\1".join(sorted({DIGITS.sub("", c[0]) for c in inner}))
        tree = inner[0]


def read_tree(text: str) -> list:
    stack, n = [["", [], -1]], 0
    for part in re.findall("[^\1\2]*\1|\2", text):
        if part == "\2":
            stack.pop()
        else:
            node = [part[:-1], [], n]
            n += 1
            stack[-1][1].append(node)
            stack.append(node)
    return stack[0][1][0] if stack[0][1] else ["", [], 0]


class Shapes:
    """A number for every different subtree, with its label, the shapes of its children and its count of nodes."""

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.label: list[str] = []
        self.children: list[list[int]] = []
        self.starts: list[np.ndarray] = []  # of the children's numbers, from the node's own
        self.nodes: list[int] = []

    def of(self, tree: list) -> int:
        children = [self.of(c) for c in tree[1]]
        key = (tree[0], *children)
        shape = self.known.setdefault(key, len(self.label))
        if shape == len(self.label):
            ends = 1 + np.cumsum([0] + [self.nodes[c] for c in children])
            self.label.append(tree[0])
            self.children.append(children)
            self.starts.append(ends[:-1])
            self.nodes.append(int(ends[-1]))
        return shape


def trimmed(x: list[int], y: list[int]) -> tuple[int, int]:
    """How many elements are equal in front, and behind among the others."""
    n, head, tail = min(len(x), len(y)), 0, 0
    while head < n and x[head] == y[head]:
        head += 1
    while tail < n - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    return head, tail


def next_row(above: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """A row of the alignment table from the one above and what its element gains with each of the other side."""
    row = above.copy()
    np.maximum(row[1:], above[:-1] + gains, out=row[1:])
    return np.maximum.accumulate(row, out=row)


def align(x: np.ndarray, y: np.ndarray, gain: np.ndarray) -> list[tuple[int, int]]:
    """Pairs in order with the most gain, where ``gain[x[i], y[j]]`` is that of a pair.

    The table is filled by rows, of which one in each block is kept; the way back fills the blocks again, from the last.
    """
    block = max(1, int(len(x) ** 0.5))
    row, kept = np.zeros(len(y) + 1, np.int32), []
    for i, e in enumerate(x):
        if i % block == 0:
            kept.append(row)
        row = next_row(row, gain[e][y])
    out, j = [], len(y)
    for n in range(len(kept) - 1, -1, -1):
        rows = [kept[n][:j + 1]]
        for e in x[n * block:(n + 1) * block]:
            rows.append(next_row(rows[-1], gain[e][y[:j]]))
        i = len(rows) - 1
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                out.append((n * block + i - 1, j - 1))
                i, j = i - 1, j - 1
    return out


def match(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the most nodes that match in order under matching parents, and their numbers (counted parents first).

    Equal subtrees match whole, in front and behind first; what is between is aligned once for each pair of different subtrees.
    Lists of any length take memory in proportion to their length times its root. Time is quadratic in what is between.
    """
    shapes = Shapes()
    tops = shapes.of(a), shapes.of(b)
    nodes, children = shapes.nodes, shapes.children
    counts: dict[tuple[int, int], int] = {}

    def between(s: int, t: int) -> tuple[int, int, list[int], list[int]]:
        x, y = children[s], children[t]
        head, tail = trimmed(x, y)
        return head, tail, x[head:len(x) - tail], y[head:len(y) - tail]

    def gains(x: list[int], y: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        kinds, i_x = np.unique(x, return_inverse=True)
        others, i_y = np.unique(y, return_inverse=True)
        return i_x, i_y, np.array([[count(k, o) for o in others.tolist()] for k in kinds.tolist()], np.int32)

    def count(s: int, t: int) -> int:
        """The most nodes that match in two subtrees."""
        if s == t:
            return nodes[s]
        if shapes.label[s] != shapes.label[t]:
            return 0
        if not children[s] or not children[t]:
            return 1
        if (s, t) not in counts:
            head, tail, x, y = between(s, t)
            most = 1 + sum(nodes[c] for c in children[s][:head]) + sum(nodes[c] for c in children[s][len(children[s]) - tail:])
            if x and y and len(x) * len(y) <= SMALL_TABLE:
                row = [0] * (len(y) + 1)
                for c in x:
                    above, row = row, [0]
                    for j, d in enumerate(y):
                        row.append(max(above[j + 1], row[j], above[j] + count(c, d)))
                most += row[-1]
            elif x and y:
                i_x, i_y, gain = gains(x, y)
                row = np.zeros(len(y) + 1, np.int32)
                for e in i_x:
                    row = next_row(row, gain[e][i_y])
                most += int(row[-1])
            counts[s, t] = most
        return counts[s, t]

    def pairs(s: int, t: int) -> np.ndarray:
        """Numbers of matching nodes, from those of the two roots, which match."""
        if s == t:
            return np.tile(np.arange(nodes[s]), (2, 1))
        head, tail, x, y = between(s, t)
        both = [(i, i) for i in range(head)]
        if x and y:
            both += [(head + i, head + j) for i, j in align(*gains(x, y))]
        both += [(len(children[s]) - i, len(children[t]) - i) for i in range(tail, 0, -1)]
        found = [np.zeros((2, 1), np.int64)]
        for i, j in both:
            found.append(pairs(children[s][i], children[t][j]) + np.array([[shapes.starts[s][i]], [shapes.starts[t][j]]]))
        return np.concatenate(found, axis=1)

    if a[0] != b[0]:
        return 0, []
    out = pairs(*tops) + np.array([[a[2]], [b[2]]])
    return out.shape[1], list(map(tuple, out.T.tolist()))


class Wrappers:
    """The wrapper tree of each layout of a host, memory-mapped."""

    def __init__(self, folder: str, shards: int):
        self.index = [(np.load(f"{folder}/host-{s:05d}.npy", mmap_mode="r"), np.load(f"{folder}/at-{s:05d}.npy", mmap_mode="r"),
                       np.load(f"{folder}/tree-{s:05d}.npy", mmap_mode="r")) for s in range(shards)]
        self.known: dict[int, list] = {}
        self.matched: dict[tuple[str, str], dict[int, int]] = {}

    def tree(self, key: int) -> list:
        if key not in self.known:
            if len(self.known) > 1000:
                self.known.clear()
            keys, at, data = self.index[key % len(self.index)]
            i = int(np.searchsorted(keys, np.uint64(key)))
            text = bytes(data[at[i]:at[i + 1]]).decode("utf-8") if i < len(keys) and keys[i] == key else ""
            self.known[key] = read_tree(text)
        return self.known[key]

    def slots(self, host: str, root: Node) -> tuple[dict[int, int], Tree]:
        """The slot hash of every block node of a page, by node number."""
        tree = Tree(root)
        shape = dumped(tree.top)
        if (host, shape) not in self.matched:
            if len(self.matched) > 10_000:
                self.matched.clear()
            key = hashed(host, layout(tree.top))
            pairs = dict(match(tree.top, self.tree(key))[1])
            slots: dict[int, int] = {}
            for n, (label, above) in enumerate(zip(tree.labels, tree.above)):  # parents first
                slots[n] = hashed(key, "w", pairs[n]) if n in pairs else hashed(slots.get(above, key), "p", label)
            self.matched[host, shape] = slots
        return self.matched[host, shape], tree


def write_wrappers(pages: DataFrame, folder: str, shards: int | None = None) -> int:
    """The tree of the page with the least hash of every layout of a host, as sorted arrays; returns the number of shards."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, bytes]] = {}
        held = 0

        def rows() -> pa.RecordBatch:
            keys = np.array(list(found), np.uint64).view(np.int64)
            order = np.array([o for o, _ in found.values()], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(order), pa.array([t for _, t in found.values()], pa.binary())], names=["key", "order", "tree"])

        for batch in slices(batches, 2):
            for host, url, page in zip(*(c.to_pylist() for c in batch.columns)):
                top = Tree(parse(page or "")[0]).top
                key, order = hashed(host, layout(top)), hashed(url, page)
                if key not in found or order < found[key][0]:
                    tree = dumped(top).encode("utf-8", "replace")
                    held += len(tree) - len(found[key][1] if key in found else b"")
                    found[key] = order, tree
            if held > HELD:
                yield rows()
                found.clear()
                held = 0
        if found:
            yield rows()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, done = None, [], []

        def store() -> None:
            rows.sort()
            data = [t for _, t in rows]
            save(folder, "host", now, np.array([k for k, _ in rows], np.uint64))
            save(folder, "at", now, offsets_of([len(t) for t in data]))
            save(folder, "tree", now, np.frombuffer(b"".join(data), np.uint8))
            done.append(now)

        for batch in slices(batches, 2):
            for shard, key, tree in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != now:
                    if now is not None:
                        store()
                    now, rows = shard, []
                if key is not None:
                    rows.append((key & (1 << 64) - 1, tree))
        if now is not None:
            store()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int32())], names=["shard"])

    trees = pages.select("host", "url", "html").mapInArrow(least, "key long, order long, tree binary")
    trees = materialize(trees.groupBy("key").agg(F.min_by("tree", F.struct("order", "tree")).alias("tree")), "wrapper-trees")
    shards = shards or 1 + trees.count() // LAYOUTS
    shard = F.udf(lambda k: (k & (1 << 64) - 1) % shards, "int")
    every = pages.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(None).cast("long").alias("key"), F.lit(None).cast("binary").alias("tree"))
    rows = trees.select(shard("key").alias("shard"), "key", "tree").unionByName(every)
    materialize(rows.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(run, "shard int"), "wrappers")
    return shards


def wording_of(blocks: list[tuple]) -> int:
    """The same for pages that differ only in digits and the order of their blocks. Pages with one text in common differ by it if their other texts do."""
    return hashed(*sorted({DIGITS.sub("", text) for text, *_ in blocks}))


def write_template(pages: DataFrame, folder: str, shards: int) -> None:
    """Texts that a slot has on nearly all pages with different wordings, as one sorted array of hashes for each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wrappers = Wrappers(folder, shards)
        for batch in slices(batches, 1):
            rows = set()
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                root, blocks, _ = parse(page or "")
                slots, tree = wrappers.slots(host, root)
                wording = wording_of(blocks)
                for text, node, *_ in blocks:
                    n, key = tree.number[id(node)], hashed(text)
                    path = hashed(host, tree.paths[n])
                    rows |= {(slots[n], key, wording, path), (path, key, wording, path)}
            columns = np.array(list(rows), np.uint64).reshape(-1, 4).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.ascontiguousarray(columns.T)], names=["slot", "text", "wording", "path"])

    seen = materialize(pages.select("host", "html").mapInArrow(run, "slot long, text long, wording long, path long").distinct(), "slot-texts")
    # wordings of a slot, and of each of its texts: counted in the map tasks first
    texts = seen.groupBy("slot", "text").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).where(F.col("n") >= LEAST_PAGES)
    slots = seen.select("slot", "wording").distinct().groupBy("slot").agg(F.count(F.lit(1)).alias("all"))
    template = texts.join(slots, "slot").where(F.col("n") >= SAME_SHARE * F.col("all"))
    # what is template in one layout is so at the same labels in all of a host, be they as rare as they may
    template = template.select(F.explode(F.array("slot", "path")).alias("slot"), "text").distinct()

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for shard in np.unique(batch.column(0)).tolist():
                keys = batch.column(1).to_numpy().view(np.uint64)[batch.column(0).to_numpy() == shard]
                held.setdefault(shard, []).append(keys)
        for shard, keys in held.items():
            save(folder, "slot", shard, np.sort(np.concatenate(keys)))
            save(folder, "slot-v", shard, np.ones(sum(map(len, keys)), np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32())], names=["shard"])

    def with_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = in_slot(*(c.to_numpy().view(np.uint64) for c in batch.columns))
            yield pa.RecordBatch.from_arrays([pa.array(shard_of(keys, shards).astype(np.int32)), pa.array(keys.view(np.int64))], names=["shard", "key"])

    materialize(template.mapInArrow(with_shard, "shard int, key long").repartition(shards, "shard").mapInArrow(store, "shard int"), "template-slots")


@lru_cache(maxsize=2)
def load(folder: str, shards: int) -> tuple[Wrappers, Table]:
    return Wrappers(folder, shards), Table(folder, "slot", "slot-v", shards)


def in_slot(slot: np.ndarray, text: np.ndarray) -> np.ndarray:
    return mixed(slot) + text


def main_text(page: str, host: str, wrappers: Wrappers, template: Table) -> str:
    root, blocks, _ = parse(page)
    if not blocks:
        return ""
    slots, tree = wrappers.slots(host, root)
    numbers = [tree.number[id(b[1])] for b in blocks]
    places = np.array([[slots[n] for n in numbers], [hashed(host, tree.paths[n]) for n in numbers]], np.uint64)
    texts = np.array([hashed(b[0]) for b in blocks], np.uint64)
    constant = template.find(in_slot(places.ravel(), np.tile(texts, 2)))[:, 0].reshape(2, -1).any(axis=0)
    sizes, marks = np.array([len(b[0]) for b in blocks]), np.array([b[2] for b in blocks])
    menu = np.array([b[3] > LINKS for b in blocks])
    for level in (2, 1):  # marked text that is mostly the same on other pages: they are copies
        here = marks == level
        if 2 * sizes[here & constant].sum() > sizes[here].sum():
            constant &= ~here
    mark = 0
    for level in (2, 1):
        inside, outside = sizes[(marks >= level) & ~constant].sum(), sizes[(marks < level) & ~constant & ~menu].sum()
        if (marks >= level).any() and inside >= MARKED * (inside + outside):
            mark = level
            break
    keep = (marks >= mark) & ~constant
    if not mark:
        keep &= ~menu
    return "\n\n".join(b[0] for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", shards: int | None = None) -> DataFrame:
    """(id, url, text) of every page."""
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    slim = slim.withColumn("host", F.lower(F.coalesce(F.regexp_extract("url", HOST, 1), F.lit(""))))
    folder = mounted_path(shared_folder(pages.sparkSession, "wrappers"))
    shards = write_wrappers(slim, folder, shards)
    write_template(slim, folder, shards)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load(folder, shards)
        for batch in slices(batches, 3):
            texts = [main_text(page, host, *known) for host, page in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = dict(pages.dtypes)[id_col]
    return slim.select("page_id", "url", "host", "html").mapInArrow(run, f"page_id {kind}, url string, text string").withColumnRenamed("page_id", id_col)
