"""HTML extraction by union-free wrappers.

The pages of a host are aligned into one wrapper, a regular expression without
unions: elements in order, of which some are optional and some repeat, with slots
for text. Runs of equal neighbours fold into a repeated element or group; two
sequences are aligned on their longest common part and what only one has becomes
optional; differing texts become a variable slot, equal ones stay template. All
pages take part: each task aligns the pages of a batch by host, equal partial
wrappers are counted together, and the rest of a host is aligned in two steps, so
that a host with a third of all pages is spread over many tasks too.

The main text lies where the wrapper has its mass of variable text outside links
and outside elements named as boilerplate; `main_path` descends to the smallest
element that holds all of it, or to the one whose tag names the article. A page is
then read once: elements on the path give their blocks, boilerplate inside left out;
a text there stays, on however many pages it is. A page without host, or one its wrapper doesn't fit, is
read by a wrapper of its own. The wrappers are written to the shared folder, so
Spark knows their size when it decides how to bring them to the pages.

Defined cases: a null or blank html gives an empty text; text without any element
is one block; a comment, tag or script left open ends with the page; unclosed
elements end where HTML says they do. A null url has no host. Repeated rows give
repeated rows; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import html
import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratepanel.sources.shared import fresh_path

#: Element groups of HTML that decide how a page is read, fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover mspace semantics".split()
)
HIDDEN = frozenset("script style noscript template head title iframe svg object canvas select textarea button input".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "iframe"))
CLOSES = {
    "p": frozenset(("p",)),
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "td", "th")),
    "td": frozenset(("td", "th")),
    "th": frozenset(("td", "th")),
    "option": frozenset(("option",)),
    "body": frozenset(("head",)),
}
#: What an element of its kind doesn't end beyond.
SCOPES = {
    "li": frozenset(("ul", "ol", "menu")),
    "dt": frozenset(("dl",)),
    "dd": frozenset(("dl",)),
    "tr": frozenset(("table", "tbody", "thead", "tfoot")),
    "td": frozenset(("tr", "table")),
    "th": frozenset(("tr", "table")),
}
#: Block elements whose start ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section table ul".split()
)
BOILERPLATE = frozenset("nav aside footer form header dialog menu".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in a class, id or role that name boilerplate, fixed values.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "widget footer header masthead topbar cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup login "
    "share sharing social related recommended comment comments disqus reply replies pagination pager skip toolbar alert".split()
)
#: Tags that say what the article is, and blocks of text that are never all of it.
ARTICLES = frozenset(("article", "main"))
BLOCKS = frozenset(("p", "li", "td", "tr", "pre", "blockquote"))
#: The share of the variable text that elements marked as the article must hold to be all of it.
SHARE = 0.4
#: A text that is the same on at least so many pages doesn't tell where the article is.
TEMPLATE_PAGES = 20
GROUP = 4
#: Steps in which the partial wrappers of a host meet.
SALTS = 64

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


class Node:
    """An element of a page."""

    __slots__ = ("names", "symbol", "tag", "kids")

    def __init__(self, tag: str, symbol: str, names: frozenset[str]):
        self.tag, self.symbol, self.names = tag, symbol, names
        self.kids: list[Node | str] = []


_heads: dict[tuple[str, str], tuple[str, frozenset[str]]] = {}


def _head(tag: str, attributes: str) -> tuple[str, frozenset[str]]:
    """An element's symbol and the words that name it; numbers in names don't count."""
    known = _heads.get((tag, attributes))
    if known is None:
        named = [(m[1].lower(), (m[2] or m[3] or m[4] or "").lower()) for m in _ATTRIBUTE.finditer(attributes)]
        words = frozenset(w for _, value in named for w in _WORD.findall(value))
        marks = sorted({re.sub(r"\d+", "#", w) for kind, value in named for w in value.split() if kind != "role"})
        known = (tag + "".join("." + m for m in marks), words)
        if len(_heads) >= 100_000:
            _heads.clear()
        _heads[tag, attributes] = known
    return known


def parse(page: str) -> Node:
    """The tree of a page, texts unescaped."""
    top = Node("", "", frozenset())
    path, at = [top], 0
    while at < len(page):
        found = _TOKEN.match(page, at)
        at = found.end()
        token = found.group()
        name = found.group(2)
        if name is None:
            if not token.startswith(("<!", "<?")):
                path[-1].kids.append(html.unescape(token))
            continue
        tag = name.lower()
        if found.group(1):
            for depth in range(len(path) - 1, 0, -1):
                if path[depth].tag == tag:
                    del path[depth:]
                    break
            continue
        closes = CLOSES.get(tag, frozenset())
        if tag in ENDS_P:
            closes = closes | {"p"}
        if closes:
            scope = SCOPES.get(tag, frozenset())
            for depth in range(len(path) - 1, 0, -1):
                open_tag = path[depth].tag
                if open_tag in closes:
                    del path[depth:]
                    if tag != "tr":
                        break
                elif open_tag in scope or (open_tag not in INLINE and open_tag not in closes and not scope):
                    break
        node = Node(tag, *_head(tag, found.group(3)))
        path[-1].kids.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not token.endswith("/>"):
            path.append(node)
    return top


def is_boilerplate(tag: str, names: frozenset[str], inside: bool) -> bool:
    if tag in HIDDEN or bool(names & BOILERPLATE_WORDS):
        return True
    return tag in BOILERPLATE and not (inside and tag == "header")


# A wrapper node is [symbol, pages, optional, repeated, variable chars, link chars, text hash or None, kids]; a
# group's symbol begins with "(". Kids are wrapper nodes.


def _text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) >> 1


def _flat(node: Node, in_link: bool, text: list[str], links: list[int], kids: list) -> None:
    """Texts of inline elements belong to the block around them."""
    for kid in node.kids:
        if isinstance(kid, str):
            text.append(kid)
            if in_link:
                links[0] += len(kid.strip())
        elif kid.tag in INLINE and not any(isinstance(k, Node) and k.tag not in INLINE for k in kid.kids):
            text.append(" " if kid.tag == "br" else "")
            _flat(kid, in_link or kid.tag == "a", text, links, kids)
        elif kid.tag in INLINE:
            _flat(kid, in_link or kid.tag == "a", text, links, kids)
        else:
            kids.append(kid)


def wrapper_of(node: Node) -> list:
    """The wrapper of one page's element."""
    text, links, blocks = [], [0], []
    if node.tag not in HIDDEN:
        _flat(node, False, text, links, blocks)
    said = " ".join("".join(text).split())
    return [node.symbol, 1, False, False, len(said), links[0], _text_hash(said), fold([wrapper_of(k) for k in blocks])]


def merge(a: list, b: list, pages: bool = True) -> list:
    """One node for two that stand at the same place."""
    count = a[1] + b[1] if pages else max(a[1], b[1])
    text = a[6] if a[6] == b[6] else None
    return [a[0], count, a[2] or b[2], a[3] or b[3] or not pages, a[4] + b[4], a[5] + b[5], text, align(a[7], b[7], a[1] if pages else 0, b[1])]


def fold(kids: list) -> list:
    """Runs of equal neighbours, single or in groups, become one repeated node."""
    changed = True
    while changed:
        changed = False
        for size in range(1, GROUP + 1):
            out, i = [], 0
            while i < len(kids):
                run = 1
                symbols = [k[0] for k in kids[i : i + size]]
                while len(symbols) == size and [k[0] for k in kids[i + run * size : i + (run + 1) * size]] == symbols:
                    run += 1
                if run > 1:
                    parts = kids[i : i + size]
                    for r in range(1, run):
                        parts = [merge(p, k, False) for p, k in zip(parts, kids[i + r * size : i + (r + 1) * size], strict=True)]
                    if size == 1:
                        out.append(parts[0])
                    else:
                        for p in parts:
                            p[3] = False
                        out.append(["(" + " ".join(symbols) + ")", max(p[1] for p in parts), False, True, 0, 0, 0, parts])
                    i += run * size
                    changed = changed or size > 1
                else:
                    out.append(kids[i])
                    i += 1
            kids = out
    return kids


def align(a: list, b: list, pages_a: int, pages_b: int) -> list:
    """Two sequences on their longest common part; the rest is optional."""
    if [k[0] for k in a] == [k[0] for k in b]:
        return [merge(x, y, pages_a > 0) for x, y in zip(a, b, strict=True)]
    longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            longest[i][j] = longest[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(longest[i + 1][j], longest[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            out.append(merge(a[i], b[j], pages_a > 0))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and longest[i + 1][j] >= longest[i][j + 1]):
            out.append([*a[i][:2], True, *a[i][3:]])
            i += 1
        else:
            out.append([*b[j][:2], True, *b[j][3:]])
            j += 1
    return fold(out)


def expression(node: list) -> str:
    """The wrapper as a regular expression over elements; # is a text slot."""
    inner = " ".join([expression(k) for k in node[7]])
    slot = "#" if node[6] is None else ""
    body = f"({inner})" if node[0].startswith("(") else f"<{node[0]}>{slot}{' ' + inner if inner else ''}</>"
    return body + ("*" if node[3] and node[2] else "+" if node[3] else "?" if node[2] else "")


def _named(symbol: str) -> tuple[str, frozenset[str]]:
    tag, *marks = symbol.split(".")
    return tag, frozenset(w for m in marks for w in _WORD.findall(m))


def _mass(node: list, template: bool = True) -> float:
    """Characters of variable text outside links and boilerplate; without `template`, of all such text."""
    if not node[0].startswith("(") and is_boilerplate(*_named(node[0]), False):
        return 0
    own = 0 if template and node[6] is not None and node[1] >= TEMPLATE_PAGES else max(0, node[4] - node[5])
    for kid in node[7]:
        own += _mass(kid, template)
    return own


def _marked(node: list, template: bool) -> float:
    """The part of the mass inside elements whose tag says that they are the article."""
    tag, names = _named(node[0])
    if not node[0].startswith("(") and is_boilerplate(tag, names, False):
        return 0
    if tag in ARTICLES:
        return _mass(node, template)
    marked = 0
    for kid in node[7]:
        marked += _marked(kid, template)
    return marked


def main_path(wrapper: list) -> list[str]:
    """Symbols from the top to the smallest element that holds all of the main text."""
    # Where all pages say the same, nothing is template.
    template = _mass(wrapper) > 0
    path, node = [], wrapper
    while True:
        total = _mass(node, template)
        by_symbol: dict[str, list[list]] = {}
        for kid in node[7]:
            for k in kid[7] if kid[0].startswith("(") else [kid]:
                by_symbol.setdefault(k[0], []).append(k)
        if total == 0 or (path and _named(path[-1])[0] == "article"):
            return path
        headed = [symbol for symbol, kids in by_symbol.items() if _named(symbol)[0] in HEADINGS and any(_mass(k, template) for k in kids)]
        chosen = None
        for symbol, kids in by_symbol.items():
            if _named(symbol)[0] in HEADINGS or _named(symbol)[0] in BLOCKS:
                continue
            # All of the text, or the element that is the article by its tag, unless a title stands beside it.
            if sum(_mass(k, template) for k in kids) == total or (not headed and sum(_marked(k, template) for k in kids) >= SHARE * total):
                chosen = symbol
                break
        if chosen is None:
            return path
        path.append(chosen)
        kids = by_symbol[chosen]
        # Elements of one symbol are all on the path.
        node = kids[0] if len(kids) == 1 else [*kids[0][:7], [g for k in kids for g in k[7]]]


def _find(node: Node, path: list[str]) -> list[Node]:
    """All elements on a path, in page order."""
    if not path:
        return [node]
    out: list[Node] = []
    for kid in node.kids:
        if isinstance(kid, Node):
            if kid.symbol == path[0]:
                out += _find(kid, path[1:])
            elif kid.tag in INLINE:
                out += _find(kid, path)
    return out


def _blocks(node: Node, inside: bool, out: list[list[str]]) -> None:
    """Texts by block, boilerplate left out."""
    for kid in node.kids:
        if isinstance(kid, str):
            out[-1].append(kid)
        elif kid.tag in INLINE:
            if not (kid.tag in HIDDEN or kid.names & BOILERPLATE_WORDS):
                out[-1].append(" " if kid.tag == "br" else "")
                _blocks(kid, inside, out)
        elif not is_boilerplate(kid.tag, kid.names, inside):
            out.append([])
            _blocks(kid, inside, out)
            out.append([])


def extract(page: Node, path: list[str]) -> str | None:
    """The main text, or None when the path doesn't lead anywhere."""
    roots = _find(page, path)
    if not roots:
        return None
    lines = []
    for root in roots:
        blocks: list[list[str]] = [[]]
        _blocks(root, True, blocks)
        said = (" ".join("".join(b).split()) for b in blocks)
        lines += [s for s in said if s]
    return "\n".join(lines)


_PARTIAL = "host string, wrapper string"
_RULES = "host string, path string, wrapper string"


#: Elements within elements that a page may have; the interpreter's own bound is far lower.
DEEPEST = 100_000


def _allow_depth() -> None:
    """Functions here call themselves for each level of a page."""
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 4 * DEEPEST))


def _partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One wrapper for the pages of each host in a batch."""
    _allow_depth()
    for batch in batches:
        hosts: dict[str, list] = {}
        for host, page in zip(batch.column("host"), batch.column("html"), strict=True):
            own = wrapper_of(parse(page.as_py() or ""))
            before = hosts.get(host.as_py())
            hosts[host.as_py()] = own if before is None else merge(before, own)
        yield pa.RecordBatch.from_pydict(
            {"host": list(hosts), "wrapper": [json.dumps(w, separators=(",", ":")) for w in hosts.values()]},
            pa.schema([("host", pa.string()), ("wrapper", pa.string())]),
        )


def _times(node: list, n: int) -> list:
    """The same pages counted n times."""
    return [node[0], node[1] * n, node[2], node[3], node[4] * n, node[5] * n, node[6], [_times(k, n) for k in node[7]]]


def _united(table: pa.Table) -> tuple[str, list]:
    _allow_depth()
    whole = None
    for wrapper, n in sorted(zip(table["wrapper"].to_pylist(), table["n"].to_pylist(), strict=True)):
        own = _times(json.loads(wrapper), n)
        whole = own if whole is None else merge(whole, own)
    return table["host"][0].as_py(), whole


def _meet(table: pa.Table) -> pa.Table:
    host, whole = _united(table)
    return pa.table({"host": [host], "wrapper": [json.dumps(whole, separators=(",", ":"))]})


def _conclude(table: pa.Table) -> pa.Table:
    host, whole = _united(table)
    return pa.table({"host": [host], "path": [json.dumps(main_path(whole))], "wrapper": [expression(whole)]})


def _hosted(pages: DataFrame, url: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.col(f"`{url}`").cast("string"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    return pages.withColumn("host", F.when(host != "", host))


def infer(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """`host, path, wrapper`: the wrapper of every host and what follows from it."""
    narrow = _hosted(pages.select(F.col(f"`{url}`").alias("url"), F.col(f"`{page}`").cast("string").alias("html")), "url").where("host is not null")
    partial = narrow.select("host", "html").mapInArrow(_partials, _PARTIAL)
    counted = partial.groupBy("host", "wrapper").agg(F.count(F.lit(1)).alias("n"))
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)))
    met = salted.groupBy("host", "salt").applyInArrow(_meet, _PARTIAL)
    return met.groupBy("host", "wrapper").agg(F.count(F.lit(1)).alias("n")).groupBy("host").applyInArrow(_conclude, _RULES)


def _read(pages: pa.Array, paths: pa.Array) -> pa.Array:
    _allow_depth()
    out = []
    for page, path in zip(pages, paths.to_pylist(), strict=True):
        tree = parse(page.as_py() or "")
        text = None if path is None else extract(tree, json.loads(path))
        if not text:
            # No wrapper, or one that doesn't fit: the page is its own sample.
            text = extract(tree, main_path(wrapper_of(tree)))
        out.append(text or "")
    return pa.array(out, pa.string())


def main_text(pages: DataFrame, id_column: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Id, url, `text` and `n_chars` of every page."""
    spark = pages.sparkSession
    where = fresh_path(spark, "wrappers")
    infer(pages, url, page).select("host", "path").write.parquet(where)
    rules = spark.read.parquet(where).withColumnRenamed("host", "of")
    columns = [F.col(f"`{id_column}`").alias("id"), F.col(f"`{url}`").alias("url"), F.col(f"`{page}`").cast("string").alias("html")]
    narrow = _hosted(pages.select(*columns), "url")
    told = narrow.join(rules, narrow.host == rules["of"], "left")
    read = F.arrow_udf(_read, "string")("html", "path")
    done = told.select("id", "url", read.alias("text"))
    return done.select(F.col("id").alias(id_column), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
