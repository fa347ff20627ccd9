"""HTML extraction with inferred wrappers.

The pages of a host are taken as samples of one union-free regular
expression.  A page is tokenised into a tree; repeated siblings are folded
into iterated groups ``(...)+``; then trees of the same host are aligned one
after another: matched elements merge, elements only one side has become
optional ``?``, a repeat on either side stays iterated, and text that differs
becomes a slot (text that never differs stays a constant of the template).
The result is the host's wrapper.  From it the host's region is chosen:
its ``article`` or ``main`` elements if there are any, else the deepest
element that still holds most of the slot text outside links.  A region is a
list of tag paths, tried in order on a page; each step of a path admits
several keys.  A page's main text is the text of that region in page order,
without menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments; in a region without a name, constants of the
template are left out too.

Elements align by tag and by those class names that recur over the host's
pages (counted first, by host, class and hash of the html, so that neither a
page's own ids nor copies of a page count).  A text is a constant if it stands
at its place on ``TEMPLATE_PAGES`` different pages and most text of the region
varies around it.

Wrappers are merged in three steps (per batch, per host and salt, per host),
read as streams, so a host with a third of all pages is reduced where its
pages are.  An element keeps ``MAX_PARTS`` parts at most: beyond that, parts
of one key are taken together in any order.  A wrapper's size thus follows the
template, not the number of pages.  Class names and regions (short lists per
host) are broadcast when they are small, after a sum of their lengths, and
joined by a shuffle otherwise.

Defined cases: a null or empty html has no text; a page without its host's
region is read whole, without the parts named above.  A null url belongs to
the empty host.  Below ``MAX_DEPTH`` levels a wrapper names only articles and
mains and adds up the other text, so that regions keep their weight however
deep they lie; extraction reads elements of any depth.  A region without a
name that holds little of a page's text (under one part in ``LITTLE``) is not
that page's: the page is read whole.  Very long pages are read whole.  Repeated
rows give repeated results, an empty table an empty one; extra columns are not
carried.
"""

from __future__ import annotations

import difflib
import html as references
import json
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwise.functions.materialize import materialize
from rankwise.llm.tables import pick
from rankwise.llm.url_filter import host_of

#: depth to which a wrapper describes elements one by one
MAX_DEPTH = 40
#: an unnamed region is a page's own if it holds one part in so many of the page's text
LITTLE = 5
#: regions are broadcast up to this many characters in all
BROADCAST_CHARS = 32 << 20
#: pages that must agree before a text counts as a constant of the template
TEMPLATE_PAGES = 3
#: parts of an element that a wrapper tells apart by their order
MAX_PARTS = 64
#: a class name recurs if it is on one of so many pages of the host, and on TEMPLATE_PAGES (or all) of them
CLASS_SHARE = 10
#: tag paths of named regions kept per host; pages with none of them are searched for the name
MAX_PATHS = 8

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z) | <[!?][^>]*> | <(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>
                        | <(/?)([a-zA-Z][^\s/>]*)([^>]*)> | [^<]+ | <""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# fixed values: element names of HTML
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp noembed noframes".split())
BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td
tfoot th thead tr ul""".split())
SKIP = set("""aside button dialog footer form head header iframe input label menu nav noembed noframes noscript object
option script select style svg template textarea title""".split())
SKIP_WORDS = set("""ad ads advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment comments
consent cookie cookies disqus footer header login menu modal nav navbar navigation newsletter notice notices popup
promo promoted related respond search share sharing sidebar social sponsor sponsored subscribe widget""".split())
SKIP_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
CLOSE_LIMIT = {"ul", "ol", "dl", "table", "select", "article", "section", "div", "body", "main"}


class Node:
    """An element with its children (elements and texts)."""

    __slots__ = ("tag", "key", "skip", "children")

    def __init__(self, tag: str, attributes: str = "", names: frozenset[str] | None = None):
        self.tag, self.children = tag, []
        named = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
        words = set(re.split(r"[^a-z0-9]+", f"{named.get('class', '')} {named.get('id', '')}".lower())) - {""}
        role = named.get("role", "").lower()
        self.skip = tag in SKIP or role in SKIP_ROLES or (bool(words & SKIP_WORDS) and tag not in ("html", "body"))
        classes = named.get("class", "").lower().split()
        if names is not None:
            classes = sorted(names.intersection(classes))
        self.key = ".".join([tag, *classes[:3], *(["main"] if role == "main" else [])])


def parse(page: str, names: frozenset[str] | None = None) -> Node:
    """The tree of a page; unclosed and stray tags are put right as they come.

    Keys hold the class names in ``names``, or all of them if there is no such set.
    """
    root = Node("#root")
    stack, pos, size = [root], 0, len(page)
    while pos < size:
        m = _TOKEN.match(page, pos)
        pos = m.end()
        tag = m[2] or m[5]
        if tag is None:
            if m[0][0] != "<" or m[0] == "<":
                stack[-1].children.append(m[0])
            continue
        tag, closing, attributes = tag.lower(), bool(m[1] or m[4]), m[3] or m[6] or ""
        if closing:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
            if depth:
                del stack[depth:]
            continue
        if tag in BLOCK:    # a block ends an open paragraph
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK:
                    break
        if tag in CLOSED_BY:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in CLOSED_BY[tag]:
                    del stack[k:]
                    break
                if stack[k].tag in CLOSE_LIMIT:
                    break
        node = Node(tag, attributes, names)
        stack[-1].children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, pos)
            node.children.append(page[pos:end.start() if end else size])
            pos = end.end() if end else size
        elif tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
    return root


# -- wrappers: nested lists [key, quantifier, constant text or None, text mass, children, occurrences, pages]
# pages: the least hashes, up to TEMPLATE_PAGES, of the pages of a constant text or of the root

def _fold(parts: list[list]) -> list[list]:
    """Fold repeats of one to three neighbouring elements into iterated groups."""
    for width in (1, 2, 3):
        out, i = [], 0
        while i < len(parts):
            group = parts[i:i + width]
            keys = [p[0] for p in group]
            n = 1
            while len(group) == width and [p[0] for p in parts[i + n * width:i + (n + 1) * width]] == keys:
                group = [merge(a, b) for a, b in zip(group, parts[i + n * width:i + (n + 1) * width])]
                n += 1
            if n == 1:
                out.append(parts[i])
                i += 1
                continue
            if width == 1:
                group[0][1] = "+" if group[0][1] in "1+" else "*"
                out.append(group[0])
            else:
                out.append(["(" + " ".join(keys) + ")", "+", None, sum(p[3] for p in group), group, 0, []])
            i += n * width
        parts = out
    return _bounded(parts)


def _bounded(parts: list[list]) -> list[list]:
    """At most MAX_PARTS parts: of longer lists, those of one key together, the ones with least text as one."""
    if len(parts) <= MAX_PARTS:
        return parts
    held: dict[str, list] = {}
    todo = parts[::-1]
    while todo:
        part = todo.pop()
        if part[0].startswith("("):
            todo += reversed(part[4])
        else:
            held[part[0]] = merge(held[part[0]], part) if part[0] in held else part
    out = [[p[0], "*", *p[2:]] for p in held.values()]
    if len(out) > MAX_PARTS:
        out.sort(key=lambda p: (p[0] == "#other", -p[3], p[0]))
        rest = out[MAX_PARTS - 1:]
        out[MAX_PARTS - 1:] = [["#other", "*", None, sum(p[3] for p in rest), [], sum(p[5] for p in rest), []]]
    return out


def skeleton(node: Node, depth: int = 0, linked: bool = False, page: int = 0) -> list:
    """The wrapper of one page (``page``: its hash): every text is a constant so far."""
    parts, linked = [], linked or node.tag == "a"
    if node.tag not in RAW and depth < MAX_DEPTH:
        for child in node.children:
            if isinstance(child, Node):
                parts.append(skeleton(child, depth + 1, linked, page))
            elif text := " ".join(child.split()):
                parts.append(["#text", "1", f"{xxhash.xxh3_64_intdigest(text):x}", 0 if linked or node.skip else len(text), [], 1, [page]])
    elif node.tag not in RAW:
        parts = _deep_parts(node, linked)
    parts = _fold(parts)
    return [node.key + ("!" if node.skip else ""), "1", None, 0 if node.skip else sum(p[3] for p in parts), parts, 1,
            [] if depth else [page]]


def _mass(tops: list[Node], linked: bool = False) -> int:
    """Characters of the text below, without links and parts to skip."""
    total, todo = 0, [(top, linked) for top in tops]
    while todo:
        node, link = todo.pop()
        if isinstance(node, str):
            total += 0 if link else len(" ".join(node.split()))
        elif not node.skip and node.tag not in RAW:
            todo += [(child, link or node.tag == "a") for child in node.children]
    return total


def _deep_parts(node: Node, linked: bool) -> list[list]:
    """Articles and mains below a node, however deep, with their text; the rest as one text slot."""
    named, todo = [], [child for child in reversed(node.children) if isinstance(child, Node)]
    while todo:
        child = todo.pop()
        if child.skip:
            continue
        if _named(child.key):
            named.append([child.key, "1", None, _mass([child], linked), [], 1, []])
        else:
            todo += [c for c in reversed(child.children) if isinstance(c, Node)]
    rest = _mass([node], linked) - sum(part[3] for part in named)
    return named + ([["#text", "1", None, rest, [], 1, []]] if rest > 0 else [])


def merge(a: list, b: list) -> list:
    """Align two wrappers of one key."""
    if a[0] == "#text":
        same = a[2] if a[2] == b[2] else None
        return ["#text", _both(a[1], b[1]), same, a[3] + b[3], [], a[5] + b[5], [] if same is None else _pages(a, b)]
    parts = []
    match = difflib.SequenceMatcher(None, [p[0] for p in a[4]], [p[0] for p in b[4]], autojunk=False)
    for how, a0, a1, b0, b1 in match.get_opcodes():
        if how == "equal":
            parts += [merge(x, y) for x, y in zip(a[4][a0:a1], b[4][b0:b1])]
        else:   # only one side has them: optional
            parts += [[x[0], "*" if x[1] in "+*" else "?", *x[2:]] for x in a[4][a0:a1] + b[4][b0:b1]]
    return [a[0], _both(a[1], b[1]), None, a[3] + b[3], _fold(parts), a[5] + b[5], _pages(a, b)]


def _pages(a: list, b: list) -> list[int]:
    return a[6] if a[6] == b[6] else sorted({*a[6], *b[6]})[:TEMPLATE_PAGES]


def _both(a: str, b: str) -> str:
    many, optional = a in "+*" or b in "+*", a in "?*" or b in "?*"
    return ("*" if optional else "+") if many else ("?" if optional else "1")


def region_of(wrapper: list) -> dict:
    """The tag paths of the main region, best first, and the constants to leave out of an unnamed one.

    A path is a list of steps, a step the keys it admits.
    """
    found: defaultdict[tuple, list] = defaultdict(lambda: [0, []])

    def walk(node: list, path: list[str]):
        for child in node[4]:
            if child[0].startswith("("):
                walk(child, path)
            elif child[0][0] != "#" and not child[0].endswith("!"):
                here = [*path, child[0]]
                if (name := _named(child[0])) and child[3] > 0:
                    place = found[name != "article", tuple(key.split(".")[0] for key in here)]
                    place[0] -= child[3]
                    place[1].append(here)
                walk(child, here)

    walk(wrapper, [])
    if found:
        best = sorted((kind, mass, tags) for (kind, tags), (mass, _) in found.items())[:MAX_PATHS]
        return {"path": [[sorted(set(step)) for step in zip(*found[kind, tags][1])] for kind, _, tags in best],
                "constants": [], "named": True}
    path, level = [], [wrapper]
    while True:
        groups: defaultdict[str, list] = defaultdict(list)
        for child in (c for node in level for c in _elements(node) if not c[0].endswith("!")):
            groups[child[0]].append(child)
            groups[child[0].split(".")[0] + " "].append(child)     # by its tag alone, too
        heavy = [g for _, g in sorted(groups.items(), key=lambda x: x[0].endswith(" "))
                 if sum(c[3] for c in g) > 0.6 * max(1, wrapper[3])]
        # the first: one key, else one tag; never several elements of a page
        if not heavy or any(c[1] in "+*" for c in heavy[0]) or sum(c[5] for c in heavy[0]) > sum(n[5] for n in level):
            break
        level = heavy[0]
        path.append(sorted({c[0] for c in level}))
    constants: set[str] = set()
    if len(wrapper[6]) >= TEMPLATE_PAGES:
        texts = [t for node in level for t in _constants(node)]
        if 2 * sum(t[3] for t in texts) < sum(n[3] for n in level):     # most of the region varies
            constants = {t[2] for t in texts}
    return {"path": [path], "constants": sorted(constants), "named": False}


def _named(key: str) -> str | None:
    """Which name of a main region an element's key has."""
    tag = key.split(".")
    return "article" if tag[0] == "article" else "main" if "main" in tag else None


def _elements(node: list) -> list[list]:
    out = []
    for child in node[4]:
        out += _elements(child) if child[0].startswith("(") else [child] if child[0][0] != "#" else []
    return out


def _constants(node: list) -> list[list]:
    if node[0] == "#text":
        return [node] if node[2] is not None and len(node[6]) >= TEMPLATE_PAGES else []
    return [t for child in node[4] for t in _constants(child)]


# -- extraction

def _regions(root: Node, region: dict) -> list[Node]:
    """Elements at the first path that the page has; repeated ones all count."""
    for path in region["path"]:
        level = [root]
        for keys in path:
            level = [c for node in level for c in node.children if isinstance(c, Node) and not c.skip and c.key in keys]
        if level:
            return level
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [root] if region.get("named") else []
    while todo:
        node = todo.pop()
        if name := _named(node.key):
            found[name].append(node)
        else:
            todo += [c for c in reversed(node.children) if isinstance(c, Node) and not c.skip]
    return found["article"] or found["main"]


def main_text(page: str, region: dict) -> str:
    """The text of the region, block by block."""
    root = parse(page, region.get("names"))
    tops = _regions(root, region)
    if tops and not region.get("named") and LITTLE * _mass(tops) < _mass([root]):
        tops = []
    constants = set(region["constants"]) if tops else set()
    done, block = [], []

    def flush() -> None:
        if text := " ".join(references.unescape("".join(block)).split()):
            done.append(text)
        block.clear()

    stack: list = [*reversed(tops or [root])]
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if constants and f"{xxhash.xxh3_64_intdigest(' '.join(item.split())):x}" in constants:
                continue
            block.append(item)
        elif not item.skip:
            if item.tag in ("br", "wbr"):
                block.append(" " if item.tag == "br" else "")
                continue
            if item.tag in BLOCK:
                flush()
                stack.append(None)
            stack += reversed(item.children)
    flush()
    return "\n".join(done)


# -- the Spark job

def recurring_classes(pages: DataFrame) -> DataFrame:
    """host, names: the class names that recur over the host's different pages, from (host, html)."""
    value = F.regexp_extract_all("html", F.lit(r"""(?i)\bclass\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""), F.lit(1))
    names = F.array_distinct(F.split(F.lower(F.regexp_replace(F.array_join(value, " "), "[\"']", " ")), r"\s+"))
    # the empty name counts the pages
    counts = materialize(
        pages.select("host", F.xxhash64("html").alias("page"), F.explode(F.array_union(names, F.array(F.lit("")))).alias("name"))
        .groupBy("host", "name").agg(F.count_distinct("page").alias("n")), "html-classes")
    totals = counts.filter("name = ''").select("host", F.col("n").alias("pages"))
    named = counts.filter("name <> ''")
    often = named.filter(F.col("n") >= TEMPLATE_PAGES).join(totals, "host").filter(F.col("n") * CLASS_SHARE >= F.col("pages"))
    # names of single pages matter to small hosts only; a large host's are spread
    spread = named.filter(F.col("n") < TEMPLATE_PAGES).withColumn("salt", F.crc32(F.col("name").cast("binary")) % 32)
    small = totals.filter(F.col("pages") < TEMPLATE_PAGES).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(31)).cast("array<bigint>")))
    seldom = spread.join(small, ["host", "salt"]).filter("n = pages")
    return (often.select("host", "name").unionByName(seldom.select("host", "name"))
            .groupBy("host").agg(F.array_sort(F.collect_list("name")).alias("names")))


def _by_host(pages: DataFrame, told: DataFrame, value: str) -> DataFrame:
    """``pages`` with the column ``value`` of their host; small tables are broadcast."""
    if (told.agg(F.sum(F.length("host") + F.length(F.col(value).cast("string")))).first()[0] or 0) <= BROADCAST_CHARS:
        told = F.broadcast(told)
    return pages.join(told, "host", "left")


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, names, wrapper (JSON) from (host, html, names)."""
    def batch_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list] = {}
            known: dict[str, frozenset] = {}
            for host, page, at in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), range(batch.num_rows)):
                if host not in known:
                    known[host] = frozenset(batch.column("names")[at].as_py() or ())
                own = skeleton(parse(page or "", known[host]), page=xxhash.xxh3_64_intdigest(page or ""))
                held[host] = merge(held[host], own) if host in held else own
            yield _wrapper_rows(held, {h: sorted(n) for h, n in known.items()})

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, names, whole = None, None, None
        for batch in batches:
            done: dict[str, list] = {}
            of: dict[str, list[str]] = {}
            for row in batch.to_pylist():
                own = json.loads(row["wrapper"])
                if whole is not None and row["host"] == host:
                    whole = merge(whole, own)
                    continue
                if whole is not None:
                    done[host], of[host] = whole, names
                host, names, whole = row["host"], row["names"], own
            yield _wrapper_rows(done, of)
        if whole is not None:
            yield _wrapper_rows({host: whole}, {host: names})

    kinds = "host string, names array<string>, wrapper string"
    parts = pages.select("host", "html", "names").mapInArrow(batch_wrappers, kinds)
    salt = F.crc32(F.col("wrapper").cast("binary")) % 64
    return (parts.repartition("host", salt).sortWithinPartitions("host", "wrapper").mapInArrow(merged, kinds)
            .repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(merged, kinds))


def _wrapper_rows(held: dict[str, list], names: dict[str, list[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()), pa.array([names[h] for h in held], pa.list_(pa.string())),
         pa.array([json.dumps(w) for w in held.values()], pa.string())], ["host", "names", "wrapper"])


@lru_cache(maxsize=256)
def _read_region(region: str | None) -> dict:
    if region is None:
        return {"path": [], "constants": []}
    read = json.loads(region)
    return read | {"names": frozenset(read["names"])}


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per input row."""
    slim = pick(pages, page_id=id_col, url=url_col, html=html_col)
    hosted = slim.select("page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions = [json.dumps(region_of(json.loads(w)) | {"names": n or []})
                       for w, n in zip(batch.column("wrapper").to_pylist(), batch.column("names").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(regions, pa.string())], ["host", "region"])

    classes = materialize(recurring_classes(hosted), "html-names")
    regions = materialize(infer_wrappers(_by_host(hosted.select("host", "html"), classes, "names"))
                          .mapInArrow(choose, "host string, region string"), "html-regions")
    joined = _by_host(hosted, regions, "region").select("page_id", "url", "html", "region")
    kind = joined.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, _read_region(region))
                     for page, region in zip(batch.column("html").to_pylist(), batch.column("region").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
