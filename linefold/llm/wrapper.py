"""Main-text extraction by wrapper induction.

All pages of a host are parsed to DOM trees and aligned with its middle one by simple
tree matching.  Nodes that stay the same from page to page become template; the places
whose text varies are slots.  The wrapper of a host is the path of the element that
holds most of the varying text outside boilerplate; every page of the host is then
read through it.  Pages without a wrapper, or on which its path is missing, are read
by the same rule from their own tree alone.
"""

from __future__ import annotations

import functools
import hashlib
import html as html_module
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import measured, stable, table

#: Tenths of a host's different pages on which a constant block stands, and the least of them.
TENTHS, LEAST = 9, 3
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noframes", "xmp"}
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are never part of the main text.
SKIP = set("head script style noscript template iframe nav footer aside form button select option input textarea dialog menu svg canvas object audio video noframes".split())
#: Words in class, id or role that mark boilerplate.
MARKS = set(
    """ad ads adv advert adverts advertisement advertising banner banners sponsor sponsored promo promotion
    nav navbar navigation menu menus breadcrumb breadcrumbs sidebar aside rail widget widgets footer header masthead topbar
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login
    comment comments disqus discussion replies reply related recommended share sharing social toolbar search
    complementary contentinfo dialog alertdialog skip pagination pager""".split()
)
#: Opening one of these closes an open paragraph.
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Opening a key closes the nearest open one of the values, up to a boundary.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: Elements whose ids, in an article, are slugs of what they say.
TEXTUAL = set("section p h1 h2 h3 h4 h5 h6 blockquote figure table ul ol dl li pre".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    label: str = ""
    slug: str = ""
    parent: Node | None = None
    children: list = field(default_factory=list)  # of Node and str
    spared: bool = False  # whatever its class words are
    constant: bool = False  # the same text on nearly all pages of the host

    def signature(self) -> str:
        return f"{self.tag}.{self.label}" if self.label else self.tag


def parse(page: str | None) -> Node:
    """A forgiving tree of the page: implied ends of paragraphs, items and cells,
    stray and missing end tags, raw text in scripts and styles."""
    root = now = Node("#root")
    text, at = page or "", 0
    for m in iter(lambda: _TOKEN.search(text, at), None):
        if m.start() > at:
            now.children.append(html_module.unescape(text[at : m.start()]))
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                now.children.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            node = now
            while node is not root and node.tag != tag:
                # a stray end of inline markup does not close blocks around it
                if tag in INLINE and node.tag not in INLINE:
                    node = root
                    break
                node = node.parent
            if node is not root:
                now = node.parent
            continue
        if tag in CLOSES_P:
            node = now
            while node.tag in INLINE:
                node = node.parent
            if node.tag == "p":
                now = node.parent
        if tag in IMPLIED:
            closes, stop = IMPLIED[tag]
            node, last = now, None
            while node is not root and node.tag not in stop:
                if node.tag in closes:
                    last = node
                node = node.parent
            if last is not None:
                now = last.parent
        attrs = {k.lower(): a or b or c or "" for k, a, b, c in _ATTR.findall(m[3])} if m[3].strip("/ ") else {}
        label = " ".join(attrs.get(k, "").lower() for k in ("class", "id", "role") if attrs.get(k))
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
            label += " #hidden"
        node = Node(tag, label, attrs.get("id", "").lower(), now)
        now.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(text, at)
            node.children.append(text[at : end.start() if end else len(text)])
            at = end.end() if end else len(text)
        elif tag not in VOID and not m[0].endswith("/>"):
            now = node
    if at < len(text):
        now.children.append(html_module.unescape(text[at:]))
    return root


def _in_article(node: Node) -> bool:
    while (node := node.parent) is not None:
        if node.tag in ("article", "main"):
            return True
    return False


def never(node: Node) -> bool:
    """Whether the element itself, not a word in its label, keeps it from the text."""
    if node.tag in SKIP or "#hidden" in node.label or node.constant:
        return True
    return node.tag == "header" and not _in_article(node)  # an article's own header may hold its title


def marked(node: Node) -> bool:
    """Whether its class, id or role has a word of boilerplate.  In an article neither
    inline markup nor the ids of sections, headings and paragraphs are asked."""
    if not node.label or node.tag in ("html", "body", "article", "main"):
        return False
    label = node.label
    if not MARKS.isdisjoint(_SPLIT.split(label)) and _in_article(node):
        if node.tag in INLINE:
            return False
        if node.tag in TEXTUAL:
            label = label.replace(node.slug, "", 1) if node.slug else label
    return not MARKS.isdisjoint(_SPLIT.split(label))


def boilerplate(node: Node) -> bool:
    return never(node) or (not node.spared and marked(node))


def spare(root: Node) -> Node:
    """Spares the marked elements that hold the article: those around an <article> or
    <main> when none is elsewhere, else one that has most of the page's text."""
    named, held, stack = False, [], [(root, ())]
    while stack:
        node, around = stack.pop()
        if node.tag in ("article", "main"):
            named = named or not around
            held.append((node, around))
        for c in node.children:
            if isinstance(c, Node) and not never(c):
                stack.append((c, (*around, c) if marked(c) else around))
    if held and not named:
        for node in max(held, key=lambda x: sum(map(len, blocks(x[0]))))[1]:
            node.spared = True
    while not held:
        rest = sum(map(len, blocks(root)))
        outer, stack = [], [root]
        while stack:
            for c in stack.pop().children:
                if isinstance(c, Node) and not never(c):
                    (outer if not c.spared and marked(c) else stack).append(c)
        size, best = max(((sum(map(len, blocks(c))), c) for c in outer if c.tag not in INLINE), key=lambda x: x[0], default=(0, None))
        if size <= 4 * rest:
            break
        best.spared = True
    return root


def blocks(node: Node) -> list[str]:
    """The texts of the blocks under a node in page order, boilerplate left out."""
    out: list[str] = []
    now: list[str] = []

    def close() -> None:
        if text := _SPACE.sub(" ", "".join(now)).strip():
            out.append(text)
        now.clear()

    stack: list = [iter(node.children)]
    ends: list[bool] = [False]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
            if ends.pop():
                close()
        elif isinstance(child, str):
            now.append(child)
        elif child.tag == "br":
            now.append(" ")
        elif not boilerplate(child):
            block = child.tag not in INLINE
            if block:
                close()
            stack.append(iter(child.children))
            ends.append(block)
    close()
    return out


def _paths(root: Node) -> Iterator[tuple[str, Node]]:
    """(path, element) of all elements outside boilerplate, in page order."""
    stack = [("", root)]
    while stack:
        path, node = stack.pop()
        yield path, node
        stack += [(f"{path}/{c.signature()}", c) for c in reversed(node.children) if isinstance(c, Node) and not boilerplate(c)]


def _own_text(node: Node) -> int:
    """Characters of text whose nearest block is this node or a child block of it."""
    size = 0
    for c in node.children:
        if isinstance(c, str):
            size += len(c.strip())
        elif not boilerplate(c):
            size += sum(len(x.strip()) if isinstance(x, str) else len(" ".join(blocks(x))) if x.tag in INLINE and not boilerplate(x) else 0 for x in c.children)
    return size


def _folded(node: Node) -> tuple:
    """(signature, text, children) of the whole tree outside boilerplate, with
    runs of like leaf siblings as one node."""
    kids: list = []
    text = " ".join(c.strip() for c in node.children if isinstance(c, str)).strip()
    for c in node.children:
        if isinstance(c, Node) and boilerplate(c):
            continue
        if isinstance(c, Node) and c.tag not in INLINE:
            one = _folded(c)
            if kids and kids[-1][0] == one[0] and not kids[-1][2] and not one[2]:
                kids[-1] = (one[0], f"{kids[-1][1]} {one[1]}", [])
            else:
                kids.append(one)
        elif isinstance(c, Node) and c.tag in INLINE:
            text = f"{text} {' '.join(blocks(c))}".strip()
    return node.signature(), text, kids


def match(a: tuple, b: tuple, path: str, same: dict[str, list[int]]) -> int:
    """Simple tree matching: the size of the largest order-keeping match of two
    trees with equal roots, child lists aligned by dynamic programming.  ``same``
    gets, for each matched path, characters of equal and of varying text."""
    memo: dict = {}
    size = _size(a, b, memo)
    _trace(a, b, path, same, memo)
    return size


def _size(a: tuple, b: tuple, memo: dict) -> int:
    if a[0] != b[0]:
        return 0
    key = (id(a), id(b))
    if key not in memo:
        memo[key] = 1 + _table(a[2], b[2], memo)[-1][-1]
    return memo[key]


def _table(x: list, y: list, memo: dict) -> list[list[int]]:
    m = [[0] * (len(y) + 1)]
    for i, p in enumerate(x):
        row = [0]
        for j, q in enumerate(y):
            row.append(max(row[j], m[i][j + 1], m[i][j] + _size(p, q, memo)))
        m.append(row)
    return m


def _trace(a: tuple, b: tuple, path: str, same: dict[str, list[int]], memo: dict) -> None:
    got = same.setdefault(path, [0, 0])
    got[a[1] != b[1]] += len(a[1]) + len(b[1])
    m, i, j = _table(a[2], b[2], memo), len(a[2]), len(b[2])
    while i and j:
        s = _size(a[2][i - 1], b[2][j - 1], memo)
        if s and m[i][j] == m[i - 1][j - 1] + s:
            _trace(a[2][i - 1], b[2][j - 1], f"{path}/{a[2][i - 1][0]}", same, memo)
            i, j = i - 1, j - 1
        elif m[i][j] == m[i - 1][j]:
            i -= 1
        else:
            j -= 1


def _mark(page: str) -> str:
    return hashlib.md5(page.encode("utf-8", "surrogatepass")).hexdigest()


def _middle(pages: list[str]) -> str:
    """Of different pages the one of (lower) median length with the least digest."""
    size = sorted(map(len, pages))[(len(pages) - 1) // 2]
    return min((p for p in pages if len(p) == size), key=_mark)


def _tree(page: str) -> tuple:
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1 << 20))  # the depth of a page is its own
    return _folded(spare(parse(page)))


def credits(middle: tuple, page: str) -> dict[str, int]:
    """Characters of varying text of the slots that a page's tree shares with that of the
    middle page, by the path of their parent."""
    same: dict[str, list[int]] = {}
    match(middle, _tree(page), "", same)
    credit: dict[str, int] = {}
    for path, (_, varying) in same.items():
        if varying:
            up = path.rpartition("/")[0]
            credit[up] = credit.get(up, 0) + varying
    return credit


def chosen(credit: dict[str, int]) -> str | None:
    """The content element's path by the credits of all pages."""
    best = {p: c for p, c in credit.items() if re.search(r"/(article|main)\b", p)} or credit
    if not best:
        return None
    path = max(best, key=lambda p: (best[p], p))
    top = re.match(r".*?/article[^/]*|.*?/main[^/]*", path)
    return top[0] if top else path


def induce(pages: list[str | None]) -> str | None:
    """The wrapper of all pages of one host: the path of its content element.

    Varying text of matched slots is credited to the parents of the slots' blocks;
    <article> and <main> win over others that are not within them.  None if no text
    varies (a lone page, or copies of one page).
    """
    different = {p for p in pages if p}
    if len(different) < 2:
        return None
    middle = _middle(list(different))
    tree, credit = _tree(middle), {}
    for p in different - {middle}:
        for path, c in credits(tree, p).items():
            credit[path] = credit.get(path, 0) + c
    return chosen(credit)


def _walk(root: Node) -> Iterator[tuple[str, Node]]:
    """(path, element) of all elements that class words alone may drop."""
    stack = [("", root)]
    while stack:
        path, node = stack.pop()
        yield path, node
        stack += [(f"{path}/{c.signature()}", c) for c in node.children if isinstance(c, Node) and not never(c)]


def _whole(node: Node) -> str:
    """The text of a block with no blocks in it, "" for others."""
    if node.tag in INLINE or any(isinstance(c, Node) and c.tag not in INLINE for c in node.children):
        return ""
    return "\n".join(blocks(node))


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()[:8], "little", signed=True)


def seen(page: str, wrapper: str | None) -> tuple[dict[int, int], list[tuple[str, int]]]:
    """Within the content element of a page: digest and size of each block (path, tab,
    text), and (path, digest of the text) of the marked elements."""
    own: dict[int, int] = {}
    said: list[tuple[str, int]] = []
    for path, node in _walk(spare(parse(page))):
        inside = bool(wrapper and path.startswith(wrapper + "/")) or _in_article(node)
        if inside and (text := _whole(node)):
            own[_digest(f"{path}\t{text}")] = len(text)
        if inside and marked(node):
            said.append((path, _digest("\n".join(blocks(node)))))
    return own, said


def template(pages: list[str | None], wrapper: str | None) -> tuple[list[int], list[str]]:
    """(constant, varying) within the content element of all pages of one host: the
    digests of blocks (path, tab, text) that are the same on nine tenths of at least three
    different pages, and the paths of marked elements whose text varies.

    If constant blocks are most of the content of a page, the pages are near copies and
    none is taken for template.
    """
    counts: dict[int, list[int]] = {}
    said: dict[str, set[int]] = {}
    different = {p for p in pages if p}
    least = None
    for p in different:
        own, marks = seen(p, wrapper)
        least = min(sum(own.values()), sum(own.values()) if least is None else least)
        for key, size in own.items():
            counts.setdefault(key, [0, size])[0] += 1
        for path, text in marks:
            said.setdefault(path, set()).add(text)
    constant = [k for k, (n, _) in counts.items() if len(different) >= LEAST and 10 * n >= TENTHS * len(different)]
    if 2 * sum(counts[k][1] for k in constant) > (least or 0):
        constant = []
    return sorted(constant), sorted(p for p, texts in said.items() if len(texts) > 1)


def extract(page: str | None, wrapper: str | None = None, constant: list[int] = (), varying: list[str] = ()) -> str:
    """The main text of a page: blocks joined by newlines, "" if there is none.
    ``constant`` and ``varying`` are those of :func:`template`."""
    root = spare(parse(page))
    if constant or varying:
        for path, node in list(_walk(root)):
            node.spared = node.spared or path in varying
            if constant and (text := _whole(node)) and _digest(f"{path}\t{text}") in constant:
                node.constant = True
    found: list[Node] = []
    named: list[Node] = []
    for path, node in _paths(root):
        if wrapper is not None and path == wrapper:
            found.append(node)
        if node.tag in ("article", "main") and not any(_within(node, n) for n in named):
            named.append(node)
    if named and not any(_within(n, f) or _within(f, n) for n in named for f in found):
        found = []  # a path outside the article does not win over it
    nodes = [n for n in found if not any(o is not n and _within(n, o) for o in found)] or named
    if not nodes:
        best = max(((_own_text(n), n) for _, n in _paths(root)), key=lambda x: x[0])
        nodes = [best[1]] if best[0] else []
    if len(nodes) == 1 and nodes[0].tag == "main" and not found:
        inner = [n for _, n in _paths(nodes[0]) if n.tag == "article"]
        nodes = [n for n in inner if not any(o is not n and _within(n, o) for o in inner)] or nodes
    return "\n".join(b for n in nodes for b in blocks(n))


def _within(node: Node, other: Node) -> bool:
    while node is not None:
        if node is other:
            return True
        node = node.parent
    return False


def host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _summed(rows: DataFrame, fn: Callable[..., Iterator[tuple]], schema: str) -> DataFrame:
    """``fn`` over the rows' values, which yields (host, ...) rows of the schema."""
    fields = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [{"string": pa.string(), "long": pa.int64()}[f.split()[1]] for f in schema.split(", ")]
        for batch in batches:
            out = list(fn(zip(*([x.as_py() for x in c] if k != 1 else c for k, c in enumerate(batch.columns)))))
            columns = zip(*out) if out else [()] * len(fields)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], fields)

    return rows.mapInArrow(run, schema)


def _beside(rows: DataFrame, few: DataFrame, *on: str) -> DataFrame:
    """``rows`` joined with a materialised table that is broadcast if its size allows."""
    longest = few.agg(F.max(F.length(F.to_json(F.struct(*few.columns))))).first()[0] or 0
    return rows.join(measured(few, max(64, 4 * longest)), list(on))


def wrappers(pages: DataFrame) -> DataFrame:
    """``host, wrapper, constant, varying`` of each host with several different pages, from
    all of them.

    Each page gives its credits, blocks and marked elements alone, beside the middle page
    of its host; they are sums, least and greatest values, so no host is gathered.
    """
    keyed = pages.where("html <> ''").select(host(F.col("url")).alias("host"), "html", F.md5("html").alias("mark"))
    light = stable(keyed.groupBy("host", "mark").agg(F.count("*").alias("k"), F.max(F.length("html")).alias("size")))
    hosts = stable(light.groupBy("host").agg(F.count("*").alias("pages"), F.expr("percentile_disc(0.5) within group (order by size)").cast("long").alias("mid")).where("pages > 1"))
    middle = stable(_beside(light, hosts, "host").where("size = mid").groupBy("host", "pages").agg(F.min("mark").alias("mark")))
    middle = stable(_beside(keyed, middle, "host", "mark").dropDuplicates(["host"]).select("host", "pages", F.col("mark").alias("own"), F.col("html").alias("middle")))
    copies = measured(stable(light.where("k > 1").select("host", "mark")), 128)
    alone = keyed.join(copies, ["host", "mark"], "left_anti")
    different = alone.unionByName(keyed.join(copies, ["host", "mark"], "left_semi").dropDuplicates(["host", "mark"]))
    rows = _beside(different, middle, "host")

    def credit(rows):
        tree = functools.lru_cache(64)(_tree)
        sums: dict = {}
        for h, page, mid in rows:
            for path, c in credits(tree(mid), page.as_py()).items():
                sums[h, path] = sums.get((h, path), 0) + c
        return ((*key, c) for key, c in sums.items())

    given = _summed(rows.where("mark <> own").select("host", "html", "middle"), credit, "host string, path string, credit long")
    given = given.groupBy("host", "path").agg(F.sum("credit").alias("credit"))

    def choose(key, batch):
        way = chosen(dict(zip(batch.column("path").to_pylist(), batch.column("credit").to_pylist())))
        return pa.table({"host": pa.array([key[0].as_py()], pa.string()), "wrapper": pa.array([way], pa.string())})

    ways = given.groupBy("host").applyInArrow(choose, "host string, wrapper string")
    ways = stable(middle.select("host", "pages").join(ways, "host", "left"))

    def parts(rows):
        found: dict = {}
        for h, page, wrapper, pages in rows:
            own, marks = seen(page.as_py(), wrapper)
            if pages >= LEAST:
                for key, size in own.items():
                    found.setdefault((h, None, key), [0, size, size])[0] += 1
                whole = found.setdefault((h, None, None), [0, sum(own.values()), 0])
                whole[1] = min(whole[1], sum(own.values()))
            for path, text in marks:
                at = found.setdefault((h, path, None), [0, text, text])
                at[1], at[2] = min(at[1], text), max(at[2], text)
        return ((*key, *x) for key, x in found.items())

    found = _summed(_beside(different, ways, "host").select("host", "html", "wrapper", "pages"), parts, "host string, path string, key long, n long, low long, high long")
    found = found.groupBy("host", "path", "key").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    found = stable(_beside(found, ways.select("host", "pages"), "host").where(f"key is null and (path is null or low <> high) or 10 * n >= {TENTHS} * pages"))
    made = found.groupBy("host").agg(
        F.collect_list("key").alias("constant"), F.sum(F.expr("if(key is not null, low, 0)")).alias("size"),
        F.min(F.expr("if(key is null and path is null, low, null)")).alias("least"), F.collect_list("path").alias("varying"),
    )
    none = F.array().cast("array<long>")
    made = made.select("host", F.when(F.expr("2 * size > least"), none).otherwise(F.col("constant")).alias("constant"), "varying")
    return ways.join(made, "host", "left").select("host", "wrapper", "constant", "varying")


SCHEMA = "page_id long, url string, text string, n_chars long"


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; a null page has the text "".

    Pages without url or without host share one wrapper under the empty host.
    """
    own = pages.select("page_id", "url", "html")
    ways = stable(wrappers(own))
    longest = ways.agg(F.max(F.length(F.to_json(F.struct(*ways.columns))))).first()[0] or 0
    ways = measured(ways, max(512, 4 * longest))
    rows = own.withColumn("host", host(F.col("url"))).join(ways, "host", "left").select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html", "wrapper", "constant", "varying")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p, w, frozenset(c or ()), frozenset(v or ())) for p, w, c, v in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
