"""Layout-aware rendering of text that holds HTML, Markdown, wiki or LaTeX markup.

One scanner turns the four notations into events; a tree builder with implied end tags nests them; visibility rules drop
what a reader would not see (comments, templates, scripts, anchors, spacing commands); a renderer walks the tree and
emits all visible text with block spacing, list marks, fenced code, delimited formulas and aligned table cells.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerlot.plans.parallelism import spread


@dataclass
class Node:
    tag: str
    children: list[Node | str] = field(default_factory=list)
    source: str = ""  # content of code and formulas, as it stands
    hidden: bool = False  # by its attributes


# Names of HTML and wiki elements, by what the tree builder does with them.
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form header html main nav ol p section summary table tbody tfoot thead tr ul caption".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup td th tt u var li nowiki gallery includeonly noinclude".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr references".split())
HIDDEN = frozenset("script style head title template noscript ref comment".split())
RAW = ("pre", "syntaxhighlight", "sourcecode", "xmp", "listing")
HEADINGS = frozenset(f"h{i}" for i in range(1, 7))
KNOWN = BLOCKS | INLINE | VOID | HIDDEN | HEADINGS | frozenset((*RAW, "math", "textarea"))
#: A start tag on the left ends an open element on the right, up to the nearest of the boundary elements.
IMPLIED_END = {
    "li": ({"li", "p"}, {"ul", "ol"}),
    "p": ({"p"}, {"td", "th", "li", "div", "table", "blockquote"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    "dd": ({"dd", "dt"}, {"dl"}),
    "dt": ({"dd", "dt"}, {"dl"}),
    **{tag: ({"p"}, {"td", "th", "li", "div"}) for tag in (*sorted(HEADINGS), "ul", "ol", "table", "pre", "div", "hr", "blockquote")},
}
FORMULA_ENVIRONMENTS = "equation|align|displaymath|math|eqnarray|gather|multline"
CODE_ENVIRONMENTS = "verbatim|Verbatim|lstlisting|minted"
#: LaTeX commands whose argument is visible text; the arguments of all others are layout, labels and notes.
VISIBLE_COMMANDS = frozenset("textbf emph textit textsc textsf texttt textrm textmd textup textsl underline uline mbox hbox text enquote uppercase href caption".split())

_ARG = r"\{((?:[^{}]|\{[^{}]*\})*)\}"
_BLOCK_TOKENS = [
    ("fence", r"^[ \t]*(?P<fence_mark>`{3,}|~{3,})[^\n`~]*\n(?P<fence_code>(?:.*?\n)??)[ \t]*(?:(?P=fence_mark)[`~]*[ \t]*$|\Z)"),
    ("wikitable", r"^[ \t]*\{\|(?P<wikitable_rows>.*?)^[ \t]*\|\}"),
    ("wikihead", r"^(?P<wikihead_mark>={1,6})[ \t]*(?P<wikihead_text>[^=\n](?:[^\n]*?[^=\n])?)[ \t]*(?P=wikihead_mark)[ \t]*$"),
    ("mdhead", r"^ {0,3}#{1,6}[ \t]+(?P<mdhead_text>[^\n]*?\S)[ \t]*#*[ \t]*$"),
    ("setext", r"^(?P<setext_text>[^\s|<\\{*+~`#=-][^\n]*)\n(?:-{3,}|={3,})[ \t]*$"),
    ("pipes", r"^(?P<pipes_rows>[ \t]*\|[^\n]*\n[ \t]*\|?[ \t]*:?-{2,}:?[ \t]*(?:\|[ \t]*:?-{2,}:?[ \t]*)*\|?[ \t]*(?:\n[ \t]*\|[^\n]*)*)$"),
    ("rule", r"(?:(?<=\n\n)|\A)[ \t]*(?:(?:-[ \t]?){3,}|(?:\*[ \t]?){3,}|(?:_[ \t]?){3,})$(?=\n\s*\n|\s*\Z)|^-{4,}[ \t]*$"),
    ("bullet", r"^[ \t]*(?P<bullet_mark>[*+]{1,6}|-)[ \t]+(?P<bullet_text>\S[^\n]*)$"),
    ("texnote", r"^[ \t]*%[^\n]*$"),
    ("footdef", r"^\[\^[^\]\n]+\]:[^\n]*$"),
]
_INLINE_TOKENS = [
    ("comment", r"<!--.*?(?:-->|\Z)"),
    ("raw", rf"<(?P<raw_tag>(?i:{'|'.join(RAW)}))\b[^<>]*>(?P<raw_code>.*?)(?:</(?P=raw_tag)\s*>|\Z)"),
    ("mathtag", r"<(?i:math)\b[^<>]*>(?P<mathtag_code>.*?)(?:</(?i:math)\s*>|\Z)"),
    ("mathspan", r"<(?i:span)\b[^<>]*\bclass\s*=\s*[\"']?(?:[\w-]+ )*math\b[^<>]*>(?P<mathspan_code>.*?)</(?i:span)\s*>"),
    ("texcode", rf"\\begin\{{(?P<texcode_env>{CODE_ENVIRONMENTS})\*?\}}(?P<texcode_code>.*?)(?:\\end\{{(?P=texcode_env)\*?\}}|\Z)"),
    ("texmath", rf"\\begin\{{(?P<texmath_env>{FORMULA_ENVIRONMENTS})\*?\}}(?P<texmath_code>.*?)(?:\\end\{{(?P=texmath_env)\*?\}}|\Z)"),
    ("display", r"\$\$(?P<display_code>.+?)\$\$|\\\[(?P<display_code2>.+?)\\\]|\\\((?P<display_code3>.+?)\\\)"),
    ("dollar", r"(?<![\\$\w])\$(?P<dollar_code>[^\s$](?:[^$\n]*?[^\s$\\])?)\$(?![\w$])"),
    ("tag", r"<(?P<tag_end>/?)(?P<tag_name>[A-Za-z][A-Za-z0-9]*)\b(?P<tag_attrs>[^<>]*)>"),
    ("entity", r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"),
    ("textable", r"\\begin\{(?P<textable_env>tabular|array|tabularx|longtable)\*?\}(?:\{[^{}]*\}){0,2}(?P<textable_rows>.*?)(?:\\end\{(?P=textable_env)\*?\}|\Z)"),
    ("texhead", rf"\\(?:part|chapter|(?:sub){{0,2}}section|(?:sub)?paragraph|title)\*?(?:\[[^\]]*\])?{_ARG}"),
    ("texlist", r"\\(?P<texlist_end>begin|end)\{(?:itemize|enumerate|description|compactitem)\*?\}(?:\[[^\]]*\])?"),
    ("texitem", r"\\item\b(?:\[[^\]\n]*\])?[ \t]*"),
    ("texenv", r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]]*\])?"),
    ("texgroup", r"\{\\(?:it|bf|em|sc|tt|sl|rm|sf|itshape|bfseries|scshape|small|large)\b[ \t]*(?P<texgroup_text>[^{}]*)\}"),
    ("texcmd", r"\\(?P<texcmd_name>[A-Za-z]+)\*?(?:\[[^\]\n]*\])?(?P<texcmd_args>(?:\{(?:[^{}]|\{[^{}]*\})*\})*)"),
    ("texbreak", r"\\\\(?:\[[^\]]*\])?|\\(?=\n)"),
    ("texescape", r"\\(?P<texescape_char>[%&_$#{}])"),
    ("template", r"\{\{(?:[^{}]|\{\{[^{}]*\}\})*\}\}"),
    ("wikilink", r"\[\[(?P<wikilink_text>[^\[\]]*)\]\]"),
    ("magic", r"__[A-Z]{3,}__"),
    ("weblink", r"\[(?:https?|ftp)://[^\s\]]+(?P<weblink_text>[^\]]*)\]"),
    ("mdimage", r"!\[[^\[\]]*\]\([^()\s]*(?:[ \t]+[^()]*)?\)"),
    ("mdlink", r"\[(?P<mdlink_text>[^\[\]\n]*)\]\([^()\s]+(?:[ \t]+[^()]*)?\)"),
    ("footref", r"\[\^[^\]\n]+\]"),
    ("strong", r"(?<![\w*])(?P<strong_mark>\*{1,3})(?P<strong_text>(?![\s*.,;:!?)])[^*\n]*(?:\n(?!\s*\n)[^*\n]*){0,3}(?<![\s*]))(?P=strong_mark)(?!\*)"),
    ("under", r"(?<![\w_])(?P<under_mark>_{1,3})(?P<under_text>(?![\s_])[^_\n]*(?<![\s_]))(?P=under_mark)(?![\w_])"),
    ("quotes", r"(?P<quotes_mark>'{2,5})(?P<quotes_text>[^'\n](?:[^\n]*?[^'\n])?)(?P=quotes_mark)(?!')"),
    ("tick", r"(?<!`)`(?P<tick_text>[^`\n]+)`(?!`)"),
    ("strike", r"(?<!~)~~(?P<strike_text>[^~\n]+)~~(?!~)"),
]


def _tokens(tokens: list[tuple[str, str]]) -> re.Pattern[str]:
    alternatives = "|".join(f"(?P<{name}>{pattern})" for name, pattern in tokens)
    return re.compile(rf"(?=[<&\\$`~\[{{|_'*=#+%! \t-])(?:{alternatives})", re.S | re.M)


_INLINE = _tokens(_INLINE_TOKENS)
_WITHOUT_SETEXT = [_INLINE_TOKENS[0], *(t for t in _BLOCK_TOKENS if t[0] != "setext"), *_INLINE_TOKENS[1:]]
_ALL = _tokens(_WITHOUT_SETEXT)
_SETEXT = re.compile("|".join(f"(?P<{n}>{p})" for n, p in [_INLINE_TOKENS[0], *_BLOCK_TOKENS, *_INLINE_TOKENS[1:]]), re.S | re.M)
_UNDERLINE = re.compile(r"(?m)^(?:-{3,}|={3,})[ \t]*$")
_MAYBE = re.compile(r"[<&\\$`\[{|~]|__|==|''|(?m:^[ \t]*[#*+%_-])|(?<![\w*])\*+\w|(?<!\w)_\w|\n---")


def in_capitals(line: str) -> bool:
    """Whether a line is set in capitals; one or two misread letters in it do not count."""
    letters = [c for c in line if c.isalpha()]
    return bool(letters) and sum(c.isupper() for c in letters) >= 0.8 * len(letters)


class _Builder:
    """Stack of open elements; implied end tags follow ``IMPLIED_END``."""

    def __init__(self) -> None:
        self.root = Node("root")
        self.stack = [self.root]

    def add(self, child: Node | str) -> None:
        if child:
            self.stack[-1].children.append(child)

    def open(self, tag: str) -> Node:
        if tag in IMPLIED_END:
            ended, boundary = IMPLIED_END[tag]
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in boundary:
                    break
                if self.stack[i].tag in ended:
                    del self.stack[i:]
        node = Node(tag)
        self.add(node)
        self.stack.append(node)
        return node

    def close(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return
            if self.stack[i].tag in ("td", "th", "table") and tag not in ("td", "th", "tr", "table"):
                return


@dataclass
class Parsed:
    root: Node
    residue: bool


def parse(text: str | None) -> Parsed:
    """Tree of ``text`` and whether it holds markup. The first line is the lot line: its leading marks are plain text."""
    builder = _Builder()
    if not text:
        return Parsed(builder.root, False)
    first, newline, rest = text.partition("\n")
    residue = False
    for part, pattern in ((first, _INLINE), (newline, _INLINE), (rest, _SETEXT if _UNDERLINE.search(rest) else _ALL)):
        if _MAYBE.search(part):
            residue |= _scan(part, builder, pattern)
        else:
            builder.add(part)
    return Parsed(builder.root, residue)


def _text_node(builder: _Builder, tag: str, content: str) -> None:
    node = builder.open(tag)
    _scan(content, builder, _INLINE)
    if node in builder.stack:
        del builder.stack[builder.stack.index(node) :]


def _scan(text: str, builder: _Builder, pattern: re.Pattern[str]) -> bool:
    residue, at, i = False, 0, 0
    while m := pattern.search(text, i):
        kind = m.lastgroup or ""  # the token's own group closes last
        builder.add(text[at : m.start()])
        at, i = m.start(), max(m.end(), m.start() + 1)
        if _event(kind, m, builder):
            residue, at = True, m.end()
        elif kind in ("mdhead", "bullet", "setext", "pipes", "rule"):
            # Plain text after all: go on behind the mark, where inline markup may still stand.
            line_end = text.find("\n", m.start())
            line_end = len(text) if line_end < 0 else line_end
            residue |= _scan(text[m.start() : line_end], builder, _INLINE)
            at = i = line_end
        if i > len(text):
            break
    builder.add(text[at:])
    return residue


def _event(kind: str, m: re.Match[str], builder: _Builder) -> bool:  # noqa: C901
    """Feed one token to the tree; False if it is plain text after all."""
    g = m.groupdict()
    if kind == "tag":
        return _tag(g["tag_end"], g["tag_name"].lower(), g["tag_attrs"], builder)
    if kind == "entity":
        decoded = html.unescape(m.group())
        if decoded == m.group():
            return False
        builder.add(" " if decoded == "\xa0" else decoded)
    elif kind in ("raw", "fence", "texcode"):
        code = g.get("raw_code") or g.get("fence_code") or g.get("texcode_code") or ""
        if kind == "raw":
            code = re.sub(r"\A\s*<code\b[^<>]*>|</code>\s*\Z", "", code, flags=re.I)
        builder.add(Node("codeblock", source=html.unescape(code).strip()))
    elif kind in ("mathtag", "mathspan", "texmath", "display", "dollar"):
        code = next((g[k] for k in g if k.startswith(kind + "_code") and g[k] is not None), "")
        builder.add(Node("formula", source=html.unescape(code).strip()))
    elif kind in ("mdhead", "setext"):
        content = g["mdhead_text"] if kind == "mdhead" else g["setext_text"]
        if in_capitals(content) or not re.search(r"\w", content) or kind == "setext" and content.rstrip().endswith((".", ",", ";")):
            return False
        _text_node(builder, "heading", content)
    elif kind == "wikihead":
        _text_node(builder, "heading", g["wikihead_text"])
    elif kind == "texhead":
        _text_node(builder, "heading", _braced(m.group()))
    elif kind == "bullet":
        content = g["bullet_text"]
        if g["bullet_mark"] == "-" and (in_capitals(content) or re.match(r"\d", content) or re.fullmatch(r"[\W\d]*", content)):
            return False
        if set(content) <= set("*+- "):
            return False
        _text_node(builder, "li", content)
    elif kind in ("wikitable", "pipes", "textable"):
        _table(kind, g, builder)
    elif kind == "texlist":
        if g["texlist_end"] == "begin":
            builder.open("ul")
        else:
            builder.close("ul")
    elif kind == "texitem":
        builder.open("li")
    elif kind in ("texgroup", "weblink", "mdlink", "strong", "under", "quotes", "strike"):
        _scan(g[kind + "_text"].strip(" ") if kind == "weblink" else g[kind + "_text"], builder, _INLINE)
    elif kind == "tick":
        builder.add(html.unescape(g["tick_text"]))
    elif kind == "texcmd":
        if g["texcmd_name"] in VISIBLE_COMMANDS and g["texcmd_args"]:
            _scan(_braced(g["texcmd_args"]), builder, _INLINE)
    elif kind == "texescape":
        builder.add(g["texescape_char"])
    elif kind == "texbreak":
        builder.add("\n")
    elif kind == "wikilink":
        target, _, shown = g["wikilink_text"].partition("|")
        if not re.match(r"(?i)\s*(?:category|kategorie|catégorie|categoria|file|image|datei|fichier)\s*:", target):
            _scan(shown or target, builder, _INLINE)
    elif kind == "rule":
        builder.add(Node("hr"))
    # comment, template, magic, mdimage, footref, footdef, texnote, texenv: not visible
    return True


def _braced(text: str) -> str:
    """Content of the last braced argument of a command."""
    found = re.findall(_ARG, text)
    return found[-1] if found else ""


def _tag(end: str, name: str, attrs: str, builder: _Builder) -> bool:
    if name not in KNOWN:
        return False
    if name in VOID:
        builder.add("\n" if name == "br" else Node("hr") if name == "hr" else "")
        return True
    tag = "heading" if name in HEADINGS else name
    if end:
        builder.close(tag)
    elif attrs.rstrip().endswith("/"):
        builder.add("")
    else:
        node = builder.open(tag)
        if re.search(r"(?i)\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|visibility\s*:\s*hidden", attrs):
            node.hidden = True
    return True


def _table(kind: str, g: dict[str, str], builder: _Builder) -> None:
    if kind == "wikitable":
        rows = [re.split(r"\|\||!!|\n\s*[|!](?![-}+])", "\n" + r)[1:] for r in re.split(r"(?m)^\s*\|-.*$", g["wikitable_rows"])]
        rows = [[re.sub(r"\A[^\[\]|{}\n]*(?<!\|)\|(?!\|)", "", c) for c in r] for r in rows]
    elif kind == "pipes":
        rows = [re.split(r"(?<!\\)\|", line.strip().strip("|")) for line in g["pipes_rows"].split("\n") if not re.fullmatch(r"[\s|:-]+", line)]
    else:
        rows = [re.split(r"(?<!\\)&", r) for r in re.split(r"\\\\(?:\[[^\]]*\])?|\\hline|\\(?:top|mid|bottom)rule", g["textable_rows"])]
    builder.open("table")
    for row in rows:
        if any(c.strip() for c in row):
            builder.open("tr")
            for cell in row:
                builder.open("td")
                _scan(cell.strip(), builder, _INLINE)
                builder.close("td")
            builder.close("tr")
    builder.close("table")


def plain(node: Node | str) -> str:
    """Visible text of a node on one line."""
    if isinstance(node, str):
        return node
    if node.tag in HIDDEN or node.hidden:
        return ""
    if node.tag in ("codeblock", "formula"):
        return node.source
    return "".join(plain(c) for c in node.children)


def one_line(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def elements(parsed: Parsed) -> list[tuple[str, str]]:
    """Distinct ``(elem, elem_text)`` in reading order: heading, list_item, code, formula."""
    out: dict[tuple[str, str], None] = {}

    def walk(node: Node) -> None:
        if node.tag in HIDDEN or node.hidden:
            return
        if node.tag == "heading":
            out[("heading", one_line(plain(node)))] = None
        elif node.tag == "li":
            own = [c for c in node.children if isinstance(c, str) or c.tag not in ("ul", "ol", "codeblock", "table", "p") or c.tag == "p" and c is node.children[0]]
            out[("list_item", one_line("".join(plain(c) for c in own)))] = None
        elif node.tag == "codeblock":
            out[("code", node.source)] = None
        elif node.tag == "formula":
            out[("formula", node.source)] = None
        for child in node.children:
            if isinstance(child, Node):
                walk(child)

    walk(parsed.root)
    return [k for k in out if k[1]]


def render(parsed: Parsed) -> str:
    """Visible text with its layout: headings ``# ``, items ``- ``, fenced code, ``$`` formulas, aligned cells."""
    blocks: list[str] = []
    line: list[str] = []
    items: set[int] = set()  # blocks that end with a list item

    def flush() -> None:
        text = "".join(line)
        line.clear()
        if text.strip():
            blocks.append(re.sub(r"[ \t]+\n", "\n", re.sub(r"\n{3,}", "\n\n", text)).strip("\n"))

    def walk(node: Node | str, depth: int) -> None:
        if isinstance(node, str):
            line.append(node)
        elif node.tag in HIDDEN or node.hidden:
            pass
        elif node.tag == "heading":
            flush()
            blocks.append("# " + one_line(plain(node)))
        elif node.tag == "codeblock":
            flush()
            blocks.append(f"```\n{node.source}\n```")
        elif node.tag == "formula":
            line.append(f"${node.source}$")
        elif node.tag == "hr":
            flush()
        elif node.tag == "table":
            flush()
            rows = [[one_line(plain(c)) for c in _cells(r)] for r in _rows(node)]
            widths = [max((len(r[i]) for r in rows if i < len(r)), default=0) for i in range(max(map(len, rows), default=0))]
            blocks.append("\n".join("  ".join(c.ljust(w) for c, w in zip(r, widths, strict=False)).rstrip() for r in rows))
        elif node.tag == "li":
            flush()
            kept = len(blocks)
            inner = [c for c in node.children if isinstance(c, str) or c.tag not in ("ul", "ol")]
            blocks.append("  " * depth + "- " + one_line("".join(plain(c) for c in inner if isinstance(c, str) or c.tag != "codeblock")))
            for child in node.children:
                if isinstance(child, Node) and child.tag in ("ul", "ol", "codeblock"):
                    walk(child, depth + 1)
                    flush()
            if kept - 1 in items:
                blocks[kept - 1 : kept + 1] = [blocks[kept - 1] + "\n" + blocks[kept]]
            items.add(len(blocks) - 1)
        elif node.tag in BLOCKS:
            flush()
            for child in node.children:
                walk(child, depth)
            flush()
        else:
            for child in node.children:
                walk(child, depth)

    for child in parsed.root.children:
        walk(child, 0)
    flush()
    return "\n\n".join(b for b in blocks if b.strip())


def _rows(table: Node) -> list[Node]:
    out = []
    for child in table.children:
        if isinstance(child, Node):
            out += [child] if child.tag == "tr" else _rows(child) if child.tag in ("tbody", "thead", "tfoot") else []
    return out


def _cells(row: Node) -> list[Node]:
    return [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]


def markup_elements(df: DataFrame, text: str = "text", key: str = "chunk_id") -> DataFrame:
    """``(key, elem, elem_text)``: the distinct structural elements of every text that holds markup.

    A text with markup but without such an element gives one row ``("none", "")``; one without markup, a null or an
    empty text gives none. One Arrow pass over the two columns; other columns are not read. Repeated rows with one key
    give repeated rows.
    """
    key_type = df.schema[key].dataType.simpleString()
    source = spread(df.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull()))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, body in zip(batch["key"], batch["text"], strict=True):
                parsed = parse(body)
                if parsed.residue:
                    rows += [(k, e, t) for e, t in elements(parsed)] or [(k, "none", "")]
            if rows:
                yield pd.DataFrame(rows, columns=["key", "elem", "elem_text"])

    return source.mapInPandas(extract, f"key {key_type}, elem string, elem_text string").withColumnRenamed("key", key)


def render_markup(df: DataFrame, text: str = "text", key: str = "chunk_id") -> DataFrame:
    """``(key, clean_text, had_markup)`` for every row; a null text stays null, a text without markup stays as it is."""
    key_type = df.schema[key].dataType.simpleString()
    source = spread(df.select(F.col(key).alias("key"), F.col(text).alias("text")))

    def clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, flags = [], []
            for body in batch["text"]:
                parsed = parse(body)
                flags.append(parsed.residue)
                texts.append(render(parsed) if parsed.residue else body)
            yield pd.DataFrame({"key": batch["key"], "clean_text": texts, "had_markup": flags})

    return source.mapInPandas(clean, f"key {key_type}, clean_text string, had_markup boolean").withColumnRenamed("key", key)
