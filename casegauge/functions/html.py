"""HTML -> text (F7) and HTML list -> numbered lines (F8) as native Spark expressions.

The fast path is built from regex/split/transform/filter/array_join built-ins and stays in
whole-stage codegen:

1. drop ``script``/``style``/``template`` blocks, comments, declarations, processing
   instructions (their text is never part of the visible text);
2. replace every remaining tag by a separator (tags only delimit text nodes);
3. split, decode entities per node (``&amp;`` last), strip Python-style whitespace,
   drop blank nodes, join.

Rows the regex form cannot decide exactly -- an entity outside the small table below,
CDATA, or nested / unclosed ``<li>`` -- are sent (one column, NULL for every other row)
to an Arrow-batched pandas UDF built on the standard-library ``html.parser``.
"""

from __future__ import annotations

import html.entities as _html_entities
import io
from collections import Counter
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

# --- Fixed values: HTML named entities decoded natively (HTML standard). ---
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&amp;", "&"),
]
# Elements whose text is never part of the visible text (script, style and template
# content, ruby annotations), and HTML void elements.
HIDDEN_TAGS = ("script", "style", "template", "rt", "rp")
VOID_TAGS = frozenset({"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen",
                       "link", "menuitem", "meta", "param", "source", "track", "wbr"})
# --- end of fixed values ---

SEP = "\u0001"
COMMENT_RE = "<!--.*?-->"
HIDDEN_RE = "|".join(f"<{t}\\b[^>]*>.*?</{t}\\s*>" for t in HIDDEN_TAGS)
DECL_RE = "<![^>]*>|<\\?[^>]*>"
# Everything that is not text: one alternation, so the construct that starts first wins
# (a comment holding "<script>", a script holding "<!--"). Each is replaced by a node
# separator -- the text on its two sides stays two text nodes.
REMOVED_RE = f"(?is){COMMENT_RE}|{HIDDEN_RE}|{DECL_RE}"
TAG_RE = "</?[A-Za-z][^>]*>"
LI_RE = "(?is)<li\\b[^>]*>(.*?)</li\\s*>"
# The characters Python's str.strip() removes: every code point with str.isspace().
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
# The same set as a regex class (Java and RE2 both read \x{h}), for regex contexts.
PY_SPACE = "[" + "".join(f"\\x{{{ord(ch):X}}}" for ch in PY_WHITESPACE) + "]"
STRIP_RE = f"^{PY_SPACE}+|{PY_SPACE}+$"


def py_strip(c: Column) -> Column:
    """Python ``str.strip()`` (Unicode whitespace), unlike Spark ``trim`` (spaces only).
    ``btrim`` with the character set walks the ends of the string -- no regex."""
    return F.btrim(c, F.lit(PY_WHITESPACE))

_KNOWN = "|".join(e[1:-1] for e, _ in ENTITIES)
# the names among them that HTML also accepts without the semicolon (by the standard
# library's entity table), decoded natively when a non-alphanumeric character follows
LEGACY_ENTITIES = [(e, ch) for e, ch in ENTITIES if e[1:-1] in _html_entities.html5]
_LEGACY = "|".join(e[1:-1] for e, _ in LEGACY_ENTITIES)
# numeric references with their semicolon are decoded natively (code point -> character;
# 128-159 as windows-1252, the code page's bytes taken from the standard codec)
NUM_REF_RE = "&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"
CP1252_HIGH = {}
for _n in range(0x80, 0xA0):
    try:
        CP1252_HIGH[_n] = bytes([_n]).decode("windows-1252")
    except UnicodeDecodeError:
        pass
ODD_ENTITY_RE = (f"&(?!(?:{_KNOWN});|(?:{_LEGACY})(?=[^-.A-Za-z0-9])|"
                 f"#(?:[0-9]{{1,7}}|[xX][0-9a-fA-F]{{1,6}});)[#A-Za-z]")
_HID = "|".join(HIDDEN_TAGS)
_CONTAINERS = "|".join(t for t in HIDDEN_TAGS if t not in ("script", "style"))
# a hidden element that is never closed, or (template / ruby parts, which hold markup)
# one opened again before it closes: the regex form cannot tell where its text ends
UNCLOSED_HIDDEN_RE = f"<(?<u>{_HID})\\b(?![^>]*>.*?</\\k<u>\\s*>)"
NESTED_HIDDEN_RE = f"<(?<n>{_CONTAINERS})\\b[^>]*>(?:(?!</\\k<n>\\s*>).)*?<\\k<n>\\b"
# a quoted attribute value holding ">": the tag does not end there
QUOTED_GT_RE = "<[A-Za-z][^>]*?=\\s*(?:\"[^\"]*>|'[^']*>)"
# raw text (script / style), a comment, CDATA or another element's end tag inside a
# template / ruby part: where the container really ends depends on that construct (an
# end tag of an element opened outside closes the container with it)
RAW_IN_CONTAINER_RE = (f"<(?<r>{_CONTAINERS})\\b[^>]*>(?:(?!</\\k<r>\\s*>).)*?"
                       f"<(?:script\\b|style\\b|!--|!\\[CDATA\\[|/(?!\\k<r>\\s*>))")
# a self-closing hidden element or list item (``<script/>``, ``<li/>``) is an empty
# element for the parser, not the start of a block
SELF_CLOSING_RE = f"<(?:{_HID}|li)\\b[^>]*/\\s*>"
# markup the regex form cannot decide (checked on the document as it is)
NEEDS_PARSER_MARKUP_RE = (f"{QUOTED_GT_RE}|(?is:<!\\[CDATA\\[|"
                          f"{UNCLOSED_HIDDEN_RE}|{NESTED_HIDDEN_RE}|{RAW_IN_CONTAINER_RE}|"
                          f"{SELF_CLOSING_RE})")
# an item whose text runs into another <li> or the end before its </li> (nested or
# unclosed items: the parser nests them); a stray </li> is ignored by both paths
OPEN_LI_RE = "<li\\b(?![^>]*>(?:(?!<li\\b).)*?</li\\s*>)"
# a list item inside a template / ruby part is still an item, with no visible text
HIDDEN_LI_RE = f"<(?<h>{_CONTAINERS})\\b[^>]*>(?:(?!</\\k<h>\\s*>).)*?<li\\b"
# a list item holding raw text, a comment or a hidden container before its </li>: that
# end tag may be raw text itself, and then the item stays open
REMOVED_IN_LI_RE = (f"<li\\b[^>]*>(?:(?!</li\\s*>).)*?"
                    f"<(?:script\\b|style\\b|!--|{_CONTAINERS}\\b)")
NEEDS_PARSER_LIST_RE = (f"{NEEDS_PARSER_MARKUP_RE}|(?is:{OPEN_LI_RE}|{HIDDEN_LI_RE}|"
                        f"{REMOVED_IN_LI_RE})")


def _clean(c: Column) -> Column:
    return F.regexp_replace(c, REMOVED_RE, SEP)


def _unescape(c: Column) -> Column:
    """Decode the entity table (``&amp;`` last, so ``&amp;lt;`` stays ``&lt;``); a legacy
    name without its semicolon is decoded when no name character (letter, digit, ``-``,
    ``.``) follows (the end of a text node is followed by markup). A node without ``&``
    (most of them) skips the whole chain."""
    return F.when(F.instr(c, "&") > 0, _decode_entities(c)).otherwise(c)


def _code_point(ref: Column) -> Column:
    """The number of a numeric reference ``&#233;`` / ``&#xE9;``."""
    body = F.regexp_extract(ref, "^&#([0-9A-Za-z]+);$", 1)
    hex_digits = F.regexp_extract(body, "^[xX]([0-9a-fA-F]+)$", 1)
    return (F.when(hex_digits != "", F.conv(hex_digits, 16, 10).try_cast("long"))
            .otherwise(body.try_cast("long")))


def _char_of(n: Column) -> Column:
    """The character of code point ``n`` (1..0x10FFFF, no surrogates), via its UTF-16;
    128-159 as windows-1252."""
    bmp = F.decode(F.unhex(F.lpad(F.hex(n), 4, "0")), "UTF-16BE")
    m = n - F.lit(0x10000)
    pair = F.decode(F.unhex(F.concat(F.hex(F.lit(0xD800) + F.shiftright(m, 10)),
                                     F.hex(F.lit(0xDC00) + m.bitwiseAND(F.lit(0x3FF))))),
                    "UTF-16BE")
    cp = F.create_map(*[x for k, v in sorted(CP1252_HIGH.items()) for x in (F.lit(k), F.lit(v))])
    return (F.when((n >= 0x80) & (n <= 0x9F), F.coalesce(F.try_element_at(cp, n.cast("int")), bmp))
            .when(n <= 0xFFFF, bmp).otherwise(pair))


def _numbered_char(name: str) -> str:
    """The character of a numeric reference (``65``, ``x41``): 128-159 by the table; a number
    that is no code point stands for U+FFFD (text must be UTF-8)."""
    digits = name.lstrip("xX").lstrip("0") or "0"
    n = int(digits, 16 if name[0] in "xX" else 10) if len(digits) <= 8 else 0x110000
    known = n <= 0x10FFFF and not 0xD800 <= n <= 0xDFFF
    return CP1252_HIGH.get(n) or (chr(n) if known else "\ufffd")


def valid_code_point(n: Column) -> Column:
    return (n >= 1) & (n <= 0x10FFFF) & ~((n >= 0xD800) & (n <= 0xDFFF))


def _decode_numeric(c: Column) -> Column:
    """Numeric references (with ``;``) by splitting the node around them and joining the
    pieces with the decoded characters -- built-ins only."""
    pieces = F.split(c, NUM_REF_RE, -1)
    chars = F.transform(F.regexp_extract_all(c, F.lit(NUM_REF_RE), 0),
                        lambda r: _char_of(_code_point(r)))
    joined = F.array_join(F.transform(pieces, lambda p, i: F.concat(
        p, F.coalesce(F.try_element_at(chars, i + 1), F.lit("")))), "")
    return F.when(F.instr(c, "&#") > 0, joined).otherwise(c)


def _decode_entities(c: Column) -> Column:
    c = _decode_numeric(c)
    for ent, ch in ENTITIES:
        c = F.replace(c, F.lit(ent), F.lit(ch))
        if (ent, ch) in LEGACY_ENTITIES:
            c = F.regexp_replace(c, f"{ent[:-1]}(?![-.A-Za-z0-9])", ch.replace("\\", "\\\\")
                                 .replace("$", "\\$"))
    return c


def _joined_nodes(c: Column, sep: str) -> Column:
    """The tag-delimited text nodes of ``c`` -- decoded, stripped, blanks dropped --
    joined by ``sep``. Decoding and stripping run per node (measured faster than the
    same steps as whole-document string passes, which copy the document each time)."""
    parts = F.split(F.regexp_replace(c, TAG_RE, SEP), SEP)
    stripped = F.transform(parts, lambda p: py_strip(_unescape(p)))
    return F.array_join(F.filter(stripped, lambda p: p != ""), sep)


def html_to_text_native(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("")).otherwise(_joined_nodes(_clean(c), "\n"))


def numbered_list_native(c: Column) -> Column:
    """F8 + W3: the list items with 1-based ordinals (``transform`` with the index)."""
    items = F.regexp_extract_all(_clean(c), F.lit(LI_RE), 1)
    lines = F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "),
                                                     _joined_nodes(x, " ")))
    return F.when(c.isNull(), F.lit("")).otherwise(F.array_join(lines, "\n"))


# ---------------------------------------------------------------- parser fallback --------

# Entity names (without ';') -> characters, from the standard library's HTML5 table; a
# reference is resolved by its whole name, as an HTML tree builder does.
_NAMED = {}
for _k, _v in sorted(_html_entities.html5.items()):
    _NAMED.setdefault(_k[:-1] if _k.endswith(";") else _k, _v)


class _TextCollector(HTMLParser):
    """Text nodes in document order, and of each list item which of them it holds: an item is
    open for one stretch of the document, so it is two places among the nodes, however many
    items are open at once.

    Consecutive character data is one node until the next markup event (tag, comment,
    declaration, processing instruction): the parser may report one run of text in
    several pieces (``1<2`` comes as ``1``, ``<``, ``2``), a document tree does not.
    References are resolved as a tree builder does: a named one by its whole name (an
    unknown name stays literal), a numeric one below 256 as windows-1252.
    """

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.stack: list[tuple[str, int | None]] = []   # (tag, li index or None)
        self.hidden = 0
        self.open: Counter[str] = Counter()  # tags on the stack
        self.nodes: list[str] = []
        self.items: list[list[int]] = []     # first node, node after the last
        self.buf: list[str] = []

    def _flush(self):
        if not self.buf:
            return
        text = "".join(self.buf).strip()
        self.buf = []
        if self.hidden or not text:
            return
        self.nodes.append(text)

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in VOID_TAGS:
            return
        li = None
        if tag == "li":
            li = len(self.items)
            self.items.append([len(self.nodes)] * 2)
        if tag in HIDDEN_TAGS:
            self.hidden += 1
        self.open[tag] += 1
        self.stack.append((tag, li))

    def handle_startendtag(self, tag, attrs):
        self._flush()
        if tag == "li":
            self.items.append([len(self.nodes)] * 2)

    def _leave(self) -> str:
        tag, li = self.stack.pop()
        self.open[tag] -= 1
        if li is not None:
            self.items[li][1] = len(self.nodes)
        if tag in HIDDEN_TAGS:
            self.hidden -= 1
        return tag

    def handle_endtag(self, tag):
        self._flush()
        if self.open[tag]:
            while self._leave() != tag:
                pass

    def handle_data(self, data):
        self.buf.append(data)

    def handle_entityref(self, name):
        ch = _NAMED.get(name)
        self.buf.append(ch if ch is not None else f"&{name}")

    def handle_charref(self, name):
        self.buf.append(_numbered_char(name))

    def handle_comment(self, data):
        self._flush()

    def handle_decl(self, decl):
        self._flush()

    def handle_pi(self, data):
        self._flush()

    def unknown_decl(self, data):
        self._flush()
        if data.upper().startswith("CDATA["):      # a CDATA section is a string of its own
            self.buf.append(data[6:])
            self._flush()

    def close(self):
        super().close()
        self._flush()
        while self.stack:
            self._leave()


def _parse(doc: str) -> _TextCollector:
    p = _TextCollector()
    p.feed(doc)
    p.close()
    return p


def html_to_text_py(doc: str | None) -> str | None:
    if doc is None:
        return None
    return "\n".join(_parse(doc).nodes) if doc else ""


def numbered_list_py(doc: str | None) -> str | None:
    if doc is None:
        return None
    if not doc:
        return ""
    parsed = _parse(doc)
    # every item is a slice of one text: the result is as long as nested items make it, but
    # nothing beside it is
    text = " ".join(parsed.nodes)
    at = [0, *accumulate(len(n) + 1 for n in parsed.nodes)]
    out = io.StringIO()
    for i, (a, b) in enumerate(parsed.items, start=1):
        out.write(f"{chr(10) if i > 1 else ''}{i}. ")
        out.write(text[at[a]:max(at[a], at[b] - 1)])
    return out.getvalue()


@pandas_udf(T.StringType())
def _html_to_text_udf(s: pd.Series) -> pd.Series:
    return s.map(html_to_text_py, na_action="ignore")


@pandas_udf(T.StringType())
def _numbered_list_udf(s: pd.Series) -> pd.Series:
    return s.map(numbered_list_py, na_action="ignore")


def _odd_entity_in_text(c: Column) -> Column:
    """An entity the native table cannot decode, looked for in the text only: tags are
    replaced by separators first, so ``&`` in attribute values (URLs with query strings)
    never sends a page to the parser. The cheap check on the document as it is runs
    first; only a page that fails it pays for stripping its tags."""
    return c.rlike(ODD_ENTITY_RE) & F.regexp_replace(c, TAG_RE, SEP).rlike(ODD_ENTITY_RE)


def _bad_numeric(c: Column) -> Column:
    """A numeric reference with a code point that is not a character (0, a surrogate,
    beyond U+10FFFF): the parser decides what it shows."""
    refs = F.regexp_extract_all(c, F.lit(NUM_REF_RE), 0)
    return (F.instr(c, "&#") > 0) & F.exists(refs, lambda r: ~valid_code_point(_code_point(r)))


def needs_parser_text(c: Column) -> Column:
    return F.coalesce(c.rlike(NEEDS_PARSER_MARKUP_RE) | _odd_entity_in_text(c) | _bad_numeric(c),
                      F.lit(False))


def needs_parser_list(c: Column) -> Column:
    return F.coalesce(c.rlike(NEEDS_PARSER_LIST_RE) | _odd_entity_in_text(c) | _bad_numeric(c),
                      F.lit(False))


def html_to_text(c: Column) -> Column:
    """visible text, one stripped node per line; NULL/empty -> ''.

    The parser UDF gets the document only where the regex form cannot decide (NULL
    elsewhere) and answers non-NULL exactly there, so ``coalesce`` picks its answer or
    the native one without evaluating the routing test a second time."""
    return F.coalesce(_html_to_text_udf(F.when(needs_parser_text(c), c)), html_to_text_native(c))


def numbered_list(c: Column) -> Column:
    """F8: every ``<li>`` as ``n. text`` (its text nodes joined by one space); no list -> ''."""
    return F.coalesce(_numbered_list_udf(F.when(needs_parser_list(c), c)),
                      numbered_list_native(c))
