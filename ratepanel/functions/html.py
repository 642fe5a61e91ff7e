"""HTML tables as arrays of text, in built-in expressions only.

All functions take and give SQL text; ``pyspark.sql.functions.expr`` makes a
column of it.

Tables may hold tables. Where one does, the marks that open and close an element
are folded with a stack, so that each element ends at its own closing tag; rows
and cells then come at every depth, in the order in which they begin. Pages
without such tables, the usual ones, are read by patterns alone. A table,
section, row or cell that is never closed runs to the end of its parent.

The patterns take inner HTML in possessive runs up to a "<" that may close the
element. They never backtrack and do not recurse, so a page of any length costs
time in proportion to it. A quoted attribute may hold a ">", but no "<".
"""

from __future__ import annotations

import re
import zlib
from html.entities import html5

from ratepanel.functions.sql import text

# An open comment or script hides the rest of the page. Each body is scanned once, without going back.
_HIDDEN = r"(?i)<(?:!--(?:[^-]++|-(?!->))*+(?:-->|\z)|script\b(?:[^<]++|<(?!/script\b))*+(?:</script\s*+>|\z))"
# What follows a tag's name: a ">" in a quoted attribute doesn't end the tag.
_ATTRIBUTE = r"""(?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])"""
_TAG = rf"<{_ATTRIBUTE}++>"


def _attribute(name: str, tag: str = "[a-z][a-z0-9]*+") -> str:
    """An opening tag up to the value of one of its attributes, sought attribute by attribute; group 1 is its name."""
    other = rf"""[\s/]++(?!{name}[\s=])[^\s=<>"'/]++(?:\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+'|[^\s"'<>]++))?+"""
    return rf"(?i)<({tag})(?:{other})*+[\s/]++{name}\s*+=\s*+"


_CLASS = rf"""^{_attribute("class")}("[^"<]*+"|'[^'<]*+'|[^\s"'<>]++)"""

# Fixed value: white space by the Unicode standard.
_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_REFERENCE = "&(?:#[0-9]++|#[xX][0-9a-fA-F]++|[A-Za-z][A-Za-z0-9]*+);"

# Names of characters, dealt out by checksum, so that a name is looked for among a few.
_BUCKETS = 2048
# Separators that no name or character contains.
_PAIR, _IS, _BUCKET = "\x01", "\x02", "\x03"


def _names() -> str:
    """Names with their characters, by the remainder of the name's checksum."""
    dealt: list[list[str]] = [[] for _ in range(_BUCKETS)]
    for plain, letters in html5.items():
        if plain.endswith(";"):
            reference = f"&{plain}"
            dealt[zlib.crc32(reference.encode()) % _BUCKETS].append(f"{reference}{_IS}{letters}")
    return _BUCKET.join(_PAIR.join(pairs) for pairs in dealt)


_NAMES = _names()

# By the HTML standard, references to C1 controls mean the characters of Windows-1252.
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_C1_MEANT = "".join(bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0))


def let(value: str, variable: str, body: str) -> str:
    """``body`` with ``variable`` for a value that is computed once.

    The optimizer may copy an expression into each place that names it, inside
    a lambda even once per element; a lambda's own variable it leaves alone.
    """
    return f"element_at(transform(array({value}), {variable} -> {body}), 1)"


def _inner(tag: str) -> str:
    return rf"(?i)<{tag}\b{_ATTRIBUTE}*+>((?:[^<]++|<(?!/{tag}\b))*+)"


def _pieces(html: str, tag: str) -> str:
    """The HTML as tags that open or close an element of this kind, and what stands between them."""
    return f"regexp_extract_all({html}, {text(rf'(?i)</?{tag}\b{_ATTRIBUTE}*+>|(?:[^<]++|<(?!/?{tag}\b))++')}, 0)"


def _kind(piece: str, tag: str) -> str:
    """1 for a tag that opens, -1 for one that closes, 0 for what stands between."""
    return (
        f"CASE WHEN NOT startswith({piece}, '<') THEN 0 WHEN {piece} RLIKE {text(rf'(?i)^<{tag}\b')} THEN 1"
        f" WHEN {piece} RLIKE {text(rf'(?i)^</{tag}\b')} THEN -1 ELSE 0 END"
    )


def _deep(html: str, tag: str) -> str:
    """Opening tag and inner HTML of every element, at any depth, by where it begins."""
    state = "STRUCT<open: ARRAY<INT>, ended: ARRAY<STRUCT<begin: INT, end: INT>>>"
    marks = f"filter(transform(pieces, (piece, at) -> named_struct('kind', {_kind('piece', tag)}, 'at', at + 1)), mark -> mark.kind != 0)"
    opened = "named_struct('open', array_append(had.open, mark.at), 'ended', had.ended)"
    ended = "array_append(had.ended, named_struct('begin', element_at(had.open, -1), 'end', mark.at))"
    closed = f"named_struct('open', slice(had.open, 1, size(had.open) - 1), 'ended', {ended})"
    step = f"CASE WHEN mark.kind = 1 THEN {opened} WHEN size(had.open) > 0 THEN {closed} ELSE had END"
    none = f"CAST(named_struct('open', array(), 'ended', array()) AS {state})"
    rest = "transform(had.open, begin -> named_struct('begin', begin, 'end', size(pieces) + 1))"
    spans = f"aggregate({marks}, {none}, (had, mark) -> CAST({step} AS {state}), had -> array_sort(concat(had.ended, {rest})))"
    inner = "array_join(slice(pieces, span.begin + 1, span.end - span.begin - 1), '')"
    told = f"transform({spans}, span -> named_struct('tag', element_at(pieces, span.begin), 'inner', {inner}))"
    return let(_pieces(html, tag), "pieces", told)


def deep_elements(html: str, tag: str) -> str:
    """Inner HTML of every ``tag`` element, those inside others too, by where they begin."""
    return f"transform({_deep(html, tag)}, found -> found.inner)"


def without_tables(html: str) -> str:
    """The HTML outside of tables."""
    state = "STRUCT<depth: INT, kept: ARRAY<STRING>>"
    kind = _kind("piece", "table")
    kept = "CASE WHEN had.depth = 0 AND kind = 0 THEN array_append(had.kept, piece) ELSE had.kept END"
    step = f"CAST({let(kind, 'kind', f'named_struct({text("depth")}, greatest(had.depth + kind, 0), {text("kept")}, {kept})')} AS {state})"
    none = f"CAST(named_struct('depth', 0, 'kept', array()) AS {state})"
    return f"aggregate({_pieces(html, 'table')}, {none}, (had, piece) -> {step}, had -> array_join(had.kept, ''))"


def _holds_table(html: str) -> str:
    return f"contains(lower({html}), '<table')"


def elements(html: str, tag: str) -> str:
    """Inner HTML of every ``tag`` element, in document order."""
    return f"regexp_extract_all({html}, {text(_inner(tag))}, 1)"


def element(html: str, tag: str) -> str:
    """Inner HTML of the first ``tag`` element, empty when there is none."""
    return f"regexp_extract({html}, {text(_inner(tag))}, 1)"


def visible(html: str) -> str:
    """The page without comments and scripts."""
    return f"regexp_replace({html}, {text(_HIDDEN)}, '')"


def first_table(html: str) -> str:
    """Inner HTML of the first table, up to its own closing tag."""
    deep = f"element_at({deep_elements('page', 'table')}, 1)"
    whole = let(element("page", "table"), "flat", f"CASE WHEN {_holds_table('flat')} THEN {deep} ELSE flat END")
    return let(visible(html), "page", whole)


def table_with_class(html: str, css: str) -> str:
    """Inner HTML of the first table, at any depth, whose class list is ``css``."""
    words = r"\s++".join(map(re.escape, css.split()))
    listed = rf"""(?:"\s*+{words}\s*+"|'\s*+{words}\s*+'|{words}(?=[\s>]))"""
    one = rf"""{_attribute("class", "table")}{listed}{_ATTRIBUTE}*+>((?:[^<]++|<(?!/table\b))*+)"""
    value = f"regexp_extract(found.tag, {text(_CLASS)}, 2)"
    classes = f"trim(regexp_replace(trim(BOTH {text(chr(34) + chr(39))} FROM {value}), {text(chr(92) + 's+')}, ' '))"
    tables = f"filter({_deep('page', 'table')}, found -> {classes} = {text(' '.join(css.split()))})"
    deep = f"coalesce(try_element_at({tables}, 1).inner, '')"
    nested = text(rf"(?i)<table\b{_ATTRIBUTE}*+>(?:[^<]++|<(?!/?table\b))*+<table\b")
    whole = f"CASE WHEN page RLIKE {nested} THEN {deep} ELSE regexp_extract(page, {text(one)}, 2) END"
    return let(visible(html), "page", whole)


def section(table: str, tag: str) -> str:
    """Inner HTML of the first section of a table, empty when there is none."""
    deep = f"coalesce(try_element_at({deep_elements('tbl', tag)}, 1), '')"
    return let(table, "tbl", f"CASE WHEN {_holds_table('tbl')} THEN {deep} ELSE {element('tbl', tag)} END")


def named_text(html: str, name: str) -> str:
    """Text inside the first element with this ``name``, up to the closing tag."""
    head = rf"""{_attribute("name")}["']?{re.escape(name)}["'\s/>]"""
    inner = rf"{head}(?:[^<>]*+>)?+((?:[^<]++|<(?!/\1\b))*+)"
    return clean_text(f"regexp_extract({html}, {text(inner)}, 2)")


def strip_tags(html: str) -> str:
    return f"regexp_replace({html}, {text(_TAG)}, '')"


def trim_text(plain: str) -> str:
    """Trim whitespace of any kind, non-breaking space included."""
    return f"trim(BOTH {text(_SPACE)} FROM {plain})"


def _code_point() -> str:
    """Code point of the numeric reference ``ref``; 0 for one that is too large."""
    digits = "ltrim('0', regexp_extract(ref, '([0-9a-fA-F]+);$', 1))"
    hexadecimal = f"IF(length({digits}) > 6, 0, CAST(conv(concat('0', {digits}), 16, 10) AS INT))"
    decimal = f"IF(length({digits}) > 7, 0, CAST(concat('0', {digits}) AS INT))"
    return f"IF(lower(substring(ref, 3, 1)) = 'x', {hexadecimal}, {decimal})"


def unescape(plain: str) -> str:
    """Undo all character references in one pass, so that none is undone twice."""
    character = f"translate(decode(unhex(lpad(hex(code), 8, '0')), 'UTF-32'), {text(_C1)}, {text(_C1_MEANT)})"
    known = "code BETWEEN 1 AND 1114111 AND code NOT BETWEEN 55296 AND 57343"
    numeric = let(_code_point(), "code", f"IF({known}, {character}, {text(chr(0xFFFD))})")
    # Splitting a constant is done once, when the plan is made.
    names = f"element_at(split({text(_NAMES)}, {text(_BUCKET)}, -1), CAST(crc32(ref) % {_BUCKETS} AS INT) + 1)"
    named = f"coalesce(try_element_at(str_to_map({names}, {text(_PAIR)}, {text(_IS)}), ref), ref)"
    read = f"transform(regexp_extract_all({plain}, {text(_REFERENCE)}, 0), ref -> IF(startswith(ref, '&#'), {numeric}, {named}))"
    between = f"split({plain}, {text(_REFERENCE)}, -1)"
    return f"array_join(zip_with({between}, {read}, (said, letters) -> concat(said, coalesce(letters, ''))), '')"


def _shown(html: str) -> str:
    return f"CASE WHEN contains({html}, '<') THEN {strip_tags(html)} ELSE {html} END"


def _reveal(plain: str) -> str:
    return trim_text(f"CASE WHEN contains({plain}, '&') THEN {unescape(plain)} ELSE {plain} END")


def clean_text(html: str) -> str:
    """Tag-free, unescaped and trimmed text of one cell."""
    return let(_shown(html), "shown", _reveal("shown"))


def clean_texts(cells: str) -> str:
    """``clean_text`` of every cell."""
    return f"transform(transform({cells}, cell -> {_shown('cell')}), shown -> {_reveal('shown')})"


def row_cells(part: str, tag: str = "td") -> str:
    """Rows of a table section, as structs of clean cell texts.

    ``cells`` are all cells inside the row, those of inner tables too; ``own``
    are the row's own. Rows of inner tables are rows as well.
    """
    plain = f"transform({elements('part', 'tr')}, line -> array({elements('line', tag)}))"
    both = f"array({elements(without_tables('line'), tag)}, {deep_elements('line', tag)})"
    deep = f"transform({deep_elements('part', 'tr')}, line -> {both})"
    # Cleaned in one place: the names of characters make the expression large.
    cleaned = f"transform(CASE WHEN {_holds_table('part')} THEN {deep} ELSE {plain} END, line -> transform(line, cells -> {clean_texts('cells')}))"
    told = f"transform({cleaned}, line -> named_struct('own', element_at(line, 1), 'cells', element_at(line, -1)))"
    return let(part, "part", told)


def row_texts(part: str, tag: str = "td") -> str:
    """Rows of a table section as arrays of clean cell texts, inner tables included."""
    return f"transform({row_cells(part, tag)}, line -> line.cells)"
