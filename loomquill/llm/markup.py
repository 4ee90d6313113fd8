"""HTML, Markdown, wiki and LaTeX residue to clean text that keeps headings, lists, code blocks and formulas.

A text is taken apart into flat blocks. Each block has a mark (what its syntax claims to be), a number of words and a link
density, and is classified with those of the blocks before and after it by a decision tree, which is grown from the small
labelled table below. The tree decides what is content, what is furniture of a web page, and which claims are to be
believed. Dialects may change from block to block within one text. Whole texts are read; there is no shuffle.

Defined results: null, empty and blank texts have no blocks; a text without markup is paragraphs; unclosed tags end with
the next block, an unclosed fence with the text; indented lines are not taken for code (scanned pages are full of them);
rows repeated under one key give the same blocks again.
"""

from __future__ import annotations

import html
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("heading", "list_item", "code", "formula", "paragraph", "table", "furniture")
MARKS = ("none", "heading", "list", "code", "formula", "quote", "table", "aside")
SPACE = regex.compile(r"\s+")


@lru_cache(maxsize=None)
def rx(pattern: str) -> regex.Pattern:
    """A compiled pattern; the library's own cache takes longer than most of the matches here."""
    return regex.compile(pattern)



@dataclass
class Block:
    mark: str
    text: str
    links: int = 0  # words inside links
    formulas: list[str] = field(default_factory=list)  # inline ones
    level: int = 0

    @property
    def words(self) -> int:
        return len(self.text.split())

    @property
    def density(self) -> float:
        return self.links / max(1, self.words)


# --- inline syntax ---------------------------------------------------------------------------------------------------

FORMULA = regex.compile(
    r"""\$\$(?P<a>.+?)\$\$ | \\\[(?P<b>.+?)\\\] | \\\((?P<c>.+?)\\\)
      | <math\b[^>]*>(?P<d>.*?)</math> | <span\b[^>]*class=["'][^"']*\bmath\b[^"']*["'][^>]*>(?P<e>.*?)</span>
      | (?<![\\$\w])\$(?=[^\s$])(?P<f>[^$\n]*?(?<=[^\s\\$]))\$(?![\d$])""",
    regex.X | regex.S | regex.I,
)
LINK = regex.compile(r"!?\[(?P<t>[^\]\[]*)\]\([^()\s]*(?:\([^()]*\)[^()\s]*)?(?:\s+[\"'][^\"']*[\"'])?\)")
WIKI_DROP = regex.compile(r"\[\[(?:Category|File|Image|Kategorie|Datei)\s*:[^\[\]]*\]\]|<ref\b[^>]*/>|<ref\b[^>]*>.*?</ref>|\{\{[^{}]*\}\}", regex.I | regex.S)
WIKI_LINK = regex.compile(r"\[\[(?:[^\[\]|]*\|)?(?P<t>[^\[\]|]*)\]\]|\[https?://\S+ (?P<u>[^\]]*)\]")
TEX_DROP = regex.compile(r"~?\\(?:cite[tp]?|label|ref|eqref|footnote|index|vspace|hspace)\*?(?:\[[^\]]*\])*\{[^{}]*\}|\\(?:maketitle|tableofcontents|noindent|centering|newpage|clearpage|bigskip|medskip|smallskip)\b")
TEX_LINK = regex.compile(r"\\href\{[^{}]*\}\{(?P<t>[^{}]*)\}")
TEX_KEEP = regex.compile(r"\\(?:textbf|textit|texttt|textsc|textrm|textsf|text|emph|underline|mbox|caption|url)\{([^{}]*)\}")
TAG = regex.compile(r"<!--.*?-->|</?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?/?>", regex.S)
STRONG = regex.compile(r"(?<![\w*])(\*{1,3})(?=[^\s*])([^*]+)(?<=[^\s*])\1(?![\w*])|(?<![\w_])(_{1,3})(?=[^\s_])([^_]+)(?<=[^\s_])\3(?![\w_])|~~(?=\S)([^~]+)(?<=\S)~~")
KEPT = "\ue000{}\ue001"
PLACE = regex.compile("\ue000(\\d+)\ue001")


def inline(raw: str, dialect: str) -> Block:
    """The text of a block without inline markup, its formulas, and how many of its words are links."""
    kept: list[str] = []
    formulas: list[str] = []

    def keep(text: str) -> str:
        kept.append(text)
        return KEPT.format(len(kept) - 1)

    def formula(m: regex.Match) -> str:
        body = SPACE.sub(" ", html.unescape(next(x for x in m.groups() if x is not None))).strip()
        if body:
            formulas.append(body)
        return keep(body)

    s = raw
    if dialect in ("markdown", "none"):
        s = rx(r"(?s)(?<!`)(`+)(?!`)(.+?)(?<!`)\1(?!`)").sub(lambda m: keep(m.group(2).strip()), s)
    s = FORMULA.sub(formula, s)
    links = [0]

    def link(m: regex.Match) -> str:
        t = next((x for x in m.groups() if x is not None), "")
        links[0] += len(t.split())
        return t

    s = WIKI_DROP.sub("", s)
    if dialect == "tex":
        s = rx(r"(?<!\\)%.*").sub("", s)
        s = TEX_LINK.sub(link, TEX_DROP.sub("", s))
        for _ in range(4):  # nested commands
            s, n = TEX_KEEP.subn(r"\1", s)
            if not n:
                break
        s = rx(r"\\([&%$#_{}])").sub(lambda m: keep(m.group(1)), s)
        s = s.replace("~", " ").replace("\\\\", " ").replace("``", '"').replace("''", '"')
    else:
        s = rx(r"(?is)<a\b[^>]*>(.*?)</a>").sub(lambda m: link(m), s)
        if dialect != "html":
            s = WIKI_LINK.sub(link, LINK.sub(link, s))
            s = rx(r"'{2,5}").sub("", s)
            s = rx(r"\\([\\`*_{}\[\]()#+.!|>~-])").sub(lambda m: keep(m.group(1)), s)
            for _ in range(3):
                s, n = STRONG.subn(lambda m: m.group(2) or m.group(4) or m.group(5), s)
                if not n:
                    break
        s = TAG.sub(lambda m: " " if rx(r"(?i)<br|</?(?:p|div|li|td|tr)\b").match(m.group()) else "", s)
        s = html.unescape(s)
    for _ in range(3):
        s, n = PLACE.subn(lambda m: kept[int(m.group(1))], s)
        if not n:
            break
    return Block("none", SPACE.sub(" ", s).strip(), links[0], formulas)


# --- HTML ------------------------------------------------------------------------------------------------------------

BREAKING = frozenset("p div section article header footer nav main aside blockquote ul ol dl dt dd table thead tbody tr td th body html form figure figcaption hr".split())
UNSEEN = frozenset("script style head title template noscript".split())


class Html(HTMLParser):
    """Flat blocks of a piece of HTML."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.mark, self.level, self.links, self.in_link, self.unseen, self.math = "none", 0, 0, False, 0, False

    def flush(self, mark: str = "none", level: int = 0) -> None:
        raw = "".join(self.parts)
        if raw.strip():
            if self.mark == "code":
                self.blocks.append(Block("code", raw.strip("\n")))
            else:
                b = inline(html.escape(raw, quote=False), "html")
                b.mark, b.level, b.links = self.mark, self.level, self.links
                self.blocks.append(_formula_only(b))
        self.parts, self.links, self.mark, self.level = [], 0, mark, level

    def handle_starttag(self, tag, attrs):
        if tag in UNSEEN:
            self.unseen += 1
        elif self.mark == "code":
            if tag == "br":
                self.parts.append("\n")
        elif rx(r"h[1-6]").fullmatch(tag):
            self.flush("heading", int(tag[1]))
        elif tag == "li":
            self.flush("list")
        elif tag == "pre":
            self.flush("code")
        elif tag in BREAKING:
            inside = self.mark == "list" and tag in ("p", "div") and not "".join(self.parts).strip()
            self.flush("list" if inside else "table" if tag in ("td", "th", "tr", "table") else "quote" if tag == "blockquote" else "none")
        elif tag == "a":
            self.in_link = True
        elif tag == "br":
            self.parts.append(" ")
        elif tag == "math" or tag == "span" and "math" in (dict(attrs).get("class") or "").split():
            self.parts.append("$$")
            self.math = True

    def handle_endtag(self, tag):
        if tag in UNSEEN:
            self.unseen = max(0, self.unseen - 1)
        elif self.mark == "code":
            if tag == "pre":
                self.flush()
        elif tag in BREAKING or tag == "li" or rx(r"h[1-6]").fullmatch(tag):
            self.flush()
        elif tag == "a":
            self.in_link = False
        elif self.math and tag in ("math", "span"):
            self.parts.append("$$")
            self.math = False

    def handle_data(self, data):
        if not self.unseen:
            self.parts.append(data)
            if self.in_link:
                self.links += len(data.split())


def _formula_only(b: Block) -> Block:
    """A paragraph that is nothing but one formula is a formula block."""
    if b.mark == "none" and len(b.formulas) == 1 and SPACE.sub(" ", b.text) == b.formulas[0]:
        return Block("formula", b.formulas[0])
    return b


# --- lines -----------------------------------------------------------------------------------------------------------

FENCE = regex.compile(r"\s{0,3}(`{3,}|~{3,})[^`]*$")
HTML_START = regex.compile(r"\s*<(?:!DOCTYPE|!--|/?(?:h[1-6]|p|div|ul|ol|li|pre|table|tr|td|script|style|span|html|body|head|blockquote|section|article|nav|footer|header|main|aside|dl|dt|dd|br|hr|form|figure|title)\b)", regex.I)
HTML_HOLD = regex.compile(r"<(pre|script|style|!--)", regex.I)
TEX_START = regex.compile(r"\s*\\(?:(?:sub){0,2}section|chapter|part|paragraph|begin|end|item|documentclass|usepackage|title|author|date|maketitle|\[)")
TEX_HEAD = regex.compile(r"\s*\\(chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?(?:\[[^\]]*\])?\{")
TEX_CODE = frozenset(("verbatim", "lstlisting", "minted", "alltt", "Verbatim"))
TEX_MATH = frozenset(("equation", "align", "gather", "displaymath", "math", "multline", "eqnarray"))
WIKI_HEAD = regex.compile(r"\s*(={1,6})\s*([^=\s].*?)\s*\1\s*$")
MD_HEAD = regex.compile(r"\s{0,3}(#{1,6})\s+(\S.*?)\s*#*\s*$")
BULLET = regex.compile(r"\s*(?:[-+•]|\*{1,3})\s+(?=\S*\p{L}|\S+.*\p{L}.*)(.*)$")
NUMBER = regex.compile(r"\s*\d{1,3}[.)]\s+(?=.*\p{L})(.*)$")
HASHES = regex.compile(r"\s*#{1,4}[*:]?\s+(\S.*)$")
RULE = regex.compile(r"\s*(?:-{3,}|={3,}|\*{3,}|_{3,}|(?:[-*_] ){2,}[-*_])\s*$")
WIKI_SIGN = regex.compile(r"'''|\[\[|\{\{|<ref\b|<syntaxhighlight|\{\||^={2,6}[^=].*={2,6}\s*$", regex.M)


def _group(text: str, at: int) -> tuple[str, int]:
    """What stands in the braces that open at ``at``, and the place after them."""
    depth = 0
    for i in range(at, len(text)):
        depth += {"{": 1, "}": -1}.get(text[i], 0)
        if not depth:
            return text[at + 1 : i], i + 1
    return text[at + 1 :], len(text)


class Reader:
    """Reads a text line by line into blocks; ``dialect`` is that of the latest sign that only one dialect has."""

    def __init__(self, text: str):
        self.lines = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        self.blocks: list[Block] = []
        self.dialect = "none"
        self.held: list[str] = []  # lines of the paragraph or list item being read
        self.mark = "none"

    def flush(self) -> None:
        if self.held:
            b = inline("\n".join(self.held), self.dialect)
            b.mark = self.mark
            if b.text:
                self.blocks.append(_formula_only(b))
        self.held, self.mark = [], "none"

    def add(self, mark: str, raw: str, level: int = 0) -> None:
        self.flush()
        if mark in ("code", "aside", "table"):
            self.blocks.append(Block(mark, raw))
            return
        b = inline(raw, self.dialect)
        b.mark, b.level = mark, level
        if b.text:
            self.blocks.append(b)

    def until(self, i: int, end: regex.Pattern) -> int:
        """The first line from ``i`` on that has ``end``, or the number of lines."""
        return next((k for k in range(i, len(self.lines)) if end.search(self.lines[k])), len(self.lines))

    def read(self) -> list[Block]:
        i = 0
        while i < len(self.lines):
            i = self.step(i)
        self.flush()
        return self.blocks

    def step(self, i: int) -> int:
        line = self.lines[i]
        if not line.strip():
            self.flush()
            return i + 1
        if m := FENCE.match(line):
            self.dialect = "markdown"
            end = self.until(i + 1, rx(rf"^\s*{regex.escape(m.group(1)[0])}{{{len(m.group(1))},}}\s*$"))
            self.add("code", "\n".join(self.lines[i + 1 : end]))
            return end + 1
        if m := rx(r"(?is)\s*<(syntaxhighlight|source|code|nowiki)\b[^>]*>(.*)").match(line):
            if m.group(1).lower() in ("syntaxhighlight", "source"):
                self.dialect = "wiki"
                end = self.until(i, rx(rf"(?i)</{m.group(1)}>"))
                body = "\n".join([m.group(2), *self.lines[i + 1 : end + 1]])
                self.add("code", rx(rf"(?is)</{m.group(1)}>.*$").sub("", body))
                return end + 1
        if rx(r"\s*\{\|").match(line):
            self.dialect = "wiki"
            end = self.until(i, rx(r"^\s*\|\}"))
            self.add("table", "\n".join(self.lines[i : end + 1]))
            return end + 1
        if rx(r"(?i)\s*\{\{[^{}]*\}\}\s*$|\s*\[\[(?:Category|File|Image)\s*:[^\]]*\]\]\s*$").match(line):
            self.dialect = "wiki"
            self.add("aside", line.strip())
            return i + 1
        if m := rx(r"\s*(\$\$|\\\[)").match(line):
            close = r"\$\$" if m.group(1) == "$$" else r"\\\]"
            rest = line[m.end() :]
            end = i if rx(close).search(rest) else self.until(i + 1, rx(close))
            body = "\n".join(self.lines[i : end + 1])
            if (n := rx(rf"(?s)\s*(?:\$\$|\\\[)(.*?){close}\s*$").match(body)) is not None:
                self.flush()
                self.blocks.append(Block("formula", SPACE.sub(" ", html.unescape(n.group(1))).strip()))
                return end + 1
        if TEX_START.match(line):
            return self.tex(i)
        if HTML_START.match(line):
            return self.html(i)
        if m := WIKI_HEAD.match(line):
            self.dialect = "wiki"
            self.add("heading", m.group(2), len(m.group(1)))
            return i + 1
        if line.lstrip().startswith("#") and (m := HASHES.match(line)) and self.hash_is_item(i):
            self.dialect = "wiki"
            self.flush()
            self.held, self.mark = [m.group(1)], "list"
            return i + 1
        if m := MD_HEAD.match(line):
            self.dialect = "markdown"
            self.add("heading", m.group(2), len(m.group(1)))
            return i + 1
        under = self.lines[i + 1] if i + 1 < len(self.lines) else ""
        if not self.held and rx(r"\s{0,3}(={3,}|-{3,})\s*").fullmatch(under) and rx(r"\p{L}").search(line) and not line.rstrip().endswith((".", "|")) and len(line.split()) <= 20 and not BULLET.match(line):
            self.dialect = "markdown"
            self.add("heading", line, 1 if "=" in under else 2)
            return i + 2
        if RULE.match(line):
            self.flush()
            return i + 1
        if line.lstrip().startswith("|"):
            end = next((k for k in range(i, len(self.lines)) if not self.lines[k].lstrip().startswith("|")), len(self.lines))
            self.add("table", "\n".join(self.lines[i:end]))
            return end
        m = BULLET.match(line) or NUMBER.match(line)
        if m and (not self.held or self.mark == "list" or self.listed(i)):
            self.flush()
            self.held, self.mark = [m.group(1)], "list"
            return i + 1
        if m := rx(r"\s{0,3}>\s?(.*)$").match(line):
            if self.mark != "quote":
                self.flush()
            self.held.append(m.group(1))
            self.mark = "quote"
            return i + 1
        if WIKI_SIGN.search(line):
            self.dialect = "wiki"
        elif LINK.search(line) or rx(r"(?<!\w)\*\*\w").search(line):
            self.dialect = "markdown"
        self.held.append(line)
        return i + 1

    def hash_is_item(self, i: int) -> bool:
        """Whether a line that starts with # is a numbered item of a wiki text rather than a heading."""
        near = [self.lines[k] for k in (i - 1, i + 1) if 0 <= k < len(self.lines)]
        if any(rx(r"\s*#{1,4}[*:]?\s+\S").match(x) for x in near):
            return True
        return self.dialect == "wiki"

    def listed(self, i: int) -> bool:
        """A bullet directly under a paragraph counts if another one follows."""
        after = self.lines[i + 1] if i + 1 < len(self.lines) else ""
        return bool(BULLET.match(after) or NUMBER.match(after))

    def html(self, i: int) -> int:
        end, until = i, ""
        while end < len(self.lines):
            line, at = self.lines[end].lower(), 0
            while True:  # what a line opens and closes; inside pre, script, style and comments blank lines are text
                if until:
                    at = line.find(until, at)
                    if at < 0:
                        break
                    at, until = at + len(until), ""
                if not (m := HTML_HOLD.search(line, at)):
                    break
                at, until = m.end(), "-->" if m.group(1) == "!--" else f"</{m.group(1)}>"
            if end + 1 >= len(self.lines) or not until and (not self.lines[end + 1].strip() or MD_HEAD.match(self.lines[end + 1])):
                break
            end += 1
        self.flush()
        self.dialect = "html"
        parser = Html()
        parser.feed("\n".join(self.lines[i : end + 1]))
        parser.close()
        parser.flush()
        self.blocks += parser.blocks
        return end + 1

    def tex(self, i: int) -> int:
        line = self.lines[i].strip()
        self.dialect = "tex"
        if m := TEX_HEAD.match(line):
            body, _ = _group(line, m.end() - 1)
            self.add("heading", body, 1 + m.group(1).count("sub"))
            rest = rx(r"\\label\{[^{}]*\}").sub("", line[m.end() + len(body) + 1 :]).strip()
            if rest and not rest.startswith("%"):
                self.held = [rest]
            return i + 1
        if m := rx(r"(?s)\\begin\{([^}]*)\}(?:\[[^\]]*\])?(?:\{[^}]*\})*(.*)$").match(line):
            name = m.group(1).rstrip("*")
            if name in TEX_CODE or name in TEX_MATH or name in ("tabular", "table", "figure", "tikzpicture"):
                close = regex.compile(rf"\\end\{{{regex.escape(m.group(1))}\}}")
                end = self.until(i, close)
                body = close.split("\n".join([m.group(2), *self.lines[i + 1 : end + 1]]))[0]
                self.flush()
                if name in TEX_MATH:
                    body = rx(r"\\label\{[^{}]*\}|\\nonumber\b").sub("", body)
                    self.blocks.append(Block("formula", SPACE.sub(" ", body).strip()))
                else:
                    self.blocks.append(Block("code" if name in TEX_CODE else "table", body.strip("\n")))
                return end + 1
            self.flush()
            return i + 1
        if m := rx(r"\\item\b\s*(?:\[([^\]]*)\])?\s*(.*)$").match(line):
            self.flush()
            self.held, self.mark = [" ".join(x for x in m.groups() if x)], "list"
            return i + 1
        self.flush()
        if not line.startswith(("\\end", "\\documentclass", "\\usepackage", "\\maketitle", "\\author", "\\date", "\\[")):
            self.held = [line]
        return i + 1


# --- decision tree ---------------------------------------------------------------------------------------------------

FEATURES = (*(f"is_{m}" for m in MARKS), "words", "density", "words_before", "density_before", "words_after", "density_after")
#: The labelled table: mark, words and link density of a block, the same two of the one before and the one after, label.
LABELLED = (
    ("heading", 5, 0.0, 0, 0.0, 30, 0.0, "heading"), ("heading", 3, 0.0, 40, 0.0, 25, 0.1, "heading"), ("heading", 1, 0.0, 8, 0.0, 60, 0.0, "heading"), ("heading", 14, 0.0, 5, 0.0, 12, 0.0, "heading"), ("heading", 4, 0.5, 30, 0.0, 40, 0.0, "heading"), ("heading", 2, 1.0, 50, 0.0, 33, 0.0, "heading"),
    ("heading", 1, 1.0, 2, 1.0, 1, 1.0, "furniture"), ("heading", 2, 1.0, 1, 1.0, 2, 1.0, "furniture"),
    ("list", 7, 0.0, 20, 0.0, 7, 0.0, "list_item"), ("list", 6, 0.2, 7, 0.0, 8, 0.2, "list_item"), ("list", 1, 0.0, 4, 0.0, 2, 0.0, "list_item"), ("list", 45, 0.05, 30, 0.0, 0, 0.0, "list_item"), ("list", 5, 0.4, 6, 0.2, 3, 0.0, "list_item"), ("list", 3, 0.34, 4, 0.25, 5, 0.4, "list_item"), ("list", 4, 1.0, 30, 0.0, 25, 0.0, "list_item"), ("list", 9, 0.9, 7, 0.1, 8, 0.0, "list_item"),
    ("list", 1, 1.0, 0, 0.0, 1, 1.0, "furniture"), ("list", 2, 1.0, 15, 0.0, 2, 1.0, "furniture"), ("list", 1, 1.0, 1, 1.0, 0, 0.0, "furniture"), ("list", 2, 1.0, 2, 1.0, 20, 0.0, "furniture"),
    ("list", 1, 1.0, 1, 1.0, 1, 1.0, "furniture"), ("list", 2, 1.0, 2, 1.0, 1, 1.0, "furniture"), ("list", 3, 1.0, 1, 1.0, 3, 1.0, "furniture"), ("list", 2, 0.9, 3, 1.0, 2, 1.0, "furniture"),
    ("code", 3, 0.0, 20, 0.0, 30, 0.0, "code"), ("code", 1, 0.0, 5, 0.0, 5, 0.0, "code"), ("code", 60, 0.0, 0, 0.0, 4, 0.0, "code"), ("code", 9, 0.0, 9, 0.2, 0, 0.0, "code"),
    ("formula", 5, 0.0, 25, 0.0, 5, 0.0, "formula"), ("formula", 1, 0.0, 4, 0.0, 30, 0.0, "formula"), ("formula", 20, 0.0, 0, 0.0, 0, 0.0, "formula"), ("formula", 7, 0.0, 3, 1.0, 3, 1.0, "formula"),
    ("none", 30, 0.0, 4, 0.0, 7, 0.0, "paragraph"), ("none", 12, 0.1, 5, 0.0, 40, 0.0, "paragraph"), ("none", 3, 0.0, 20, 0.0, 20, 0.0, "paragraph"), ("none", 80, 0.2, 0, 0.0, 0, 0.0, "paragraph"), ("none", 15, 0.5, 40, 0.0, 35, 0.0, "paragraph"), ("quote", 25, 0.0, 4, 0.0, 5, 0.0, "paragraph"), ("quote", 6, 0.2, 30, 0.0, 30, 0.0, "paragraph"),
    ("none", 2, 1.0, 2, 1.0, 3, 1.0, "furniture"), ("none", 5, 0.9, 1, 1.0, 2, 1.0, "furniture"), ("none", 8, 0.8, 3, 1.0, 0, 0.0, "furniture"), ("none", 3, 1.0, 0, 0.0, 2, 1.0, "furniture"),
    ("table", 4, 0.0, 4, 0.0, 4, 0.0, "table"), ("table", 1, 0.0, 30, 0.0, 1, 0.0, "table"), ("table", 2, 0.5, 2, 0.0, 2, 0.0, "table"), ("table", 30, 0.0, 20, 0.0, 5, 0.0, "table"),
    ("aside", 3, 0.0, 0, 0.0, 5, 0.0, "furniture"), ("aside", 1, 0.0, 30, 0.0, 0, 0.0, "furniture"), ("aside", 12, 0.0, 4, 0.0, 40, 0.0, "furniture"),
)


def _vector(mark: str, *numbers: float) -> list[float]:
    return [float(m == mark) for m in MARKS] + [float(x) for x in numbers]


def _impurity(labels: list[str]) -> float:
    n = len(labels)
    return n - sum(c * c for c in Counter(labels).values()) / n if n else 0.0


def grow(rows: list[list[float]], labels: list[str], depth: int = 12):
    """A binary decision tree by Gini impurity: a label, or (feature, threshold, tree up to it, tree above it)."""
    if len(set(labels)) == 1 or not depth:
        return Counter(labels).most_common(1)[0][0]
    best = None
    for f in range(len(rows[0])):
        values = sorted({r[f] for r in rows})
        for low, high in zip(values, values[1:], strict=False):
            cut = (low + high) / 2
            under = [y for r, y in zip(rows, labels, strict=True) if r[f] <= cut]
            over = [y for r, y in zip(rows, labels, strict=True) if r[f] > cut]
            score = _impurity(under) + _impurity(over)
            if best is None or score < best[0] - 1e-12:
                best = (score, f, cut)
    if best is None:
        return Counter(labels).most_common(1)[0][0]
    _, f, cut = best
    sides = [([r for r in rows if (r[f] <= cut) == s], [y for r, y in zip(rows, labels, strict=True) if (r[f] <= cut) == s]) for s in (True, False)]
    return (f, cut, *(grow(r, y, depth - 1) for r, y in sides))


def decide(tree, row: list[float]) -> str:
    while not isinstance(tree, str):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


TREE = grow([_vector(r[0], *r[1:7]) for r in LABELLED], [r[7] for r in LABELLED])


def blocks(text: str | None) -> list[tuple[str, Block]]:
    """(kind, block) of a text in order."""
    if not text or not text.strip():
        return []
    found = Reader(text).read()
    sizes = [(0, 0.0), *((b.words, b.density) for b in found), (0, 0.0)]
    return [(decide(TREE, _vector(b.mark, *sizes[i + 1], *sizes[i], *sizes[i + 2])), b) for i, b in enumerate(found)]


def parts(text: str | None) -> list[tuple[str, str]]:
    """(part_kind, piece) of the headings, list items, code blocks and formulas of a text."""
    out = []
    for kind, b in blocks(text):
        if kind in ("heading", "list_item", "code", "formula"):
            piece = SPACE.sub(" ", b.text).strip()
            if piece:
                out.append((kind, piece))
        out += [("formula", f) for f in b.formulas if kind != "furniture"]
    return out


def clean(text: str | None) -> str | None:
    """The text with its structure in one plain notation: # headings, - items, fenced code, $$ formulas."""
    if text is None:
        return None
    out = []
    for kind, b in blocks(text):
        if kind == "heading":
            out.append("#" * max(1, b.level) + " " + b.text)
        elif kind == "list_item":
            out.append("- " + b.text)
        elif kind == "code":
            out.append("```\n" + b.text.strip("\n") + "\n```")
        elif kind == "formula":
            out.append("$$" + b.text + "$$")
        elif kind in ("paragraph", "table"):
            out.append(b.text)
    return "\n\n".join(out)


def _parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rows = [(k, *p) for k, t in zip(f["key"], f["text"], strict=True) for p in parts(t)]
        yield pd.DataFrame(rows, columns=["key", "part_kind", "piece"])


def _clean(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield pd.DataFrame({"key": f["key"], "text": [clean(t) for t in f["text"]]})


def structure(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, part_kind, piece), one row per distinct piece of a text."""
    kind = texts.schema[key].dataType.simpleString()
    found = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("key").isNotNull()).mapInPandas(_parts, f"key {kind}, part_kind string, piece string")
    return found.distinct().withColumnRenamed("key", key)


def cleaned(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text) without markup, one row per input row that has a key."""
    kind = texts.schema[key].dataType.simpleString()
    return texts.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("key").isNotNull()).mapInPandas(_clean, f"key {kind}, text string").withColumnRenamed("key", key)
