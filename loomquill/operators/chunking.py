"""Splitting documents: word windows, Markdown sections, recursive splitting, sentence packing, token windows.

Windows are SQL array functions. The sequential splitters run in Arrow batches over single texts; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomquill.config import EngineConfig
from loomquill.functions.text import heading_tag, regex_tokens, words

Tokens = Callable[[str], list[str]]
TOKEN = re.compile(r"\w+|[^\w\s]")
SENTENCE_END = re.compile(r"(?<=[.!?])[\"')\]]*\s+(?=\S)")
EMBEDDER_CAP = 512


def regex_tokenizer(text: str) -> list[str]:
    """The default tokenizer; a real one gives its subwords without special tokens."""
    return TOKEN.findall(text)


def split_sentences(text: str) -> list[str]:
    """The default sentence splitter: after . ! ? and white space."""
    return [s for s in (x.strip() for x in SENTENCE_END.split(text)) if s]


# --- windows ---------------------------------------------------------------------------------------------------------


def windows(items: Column, size: int, overlap: int) -> Column:
    """Overlapping slices of an array; the last one reaches its end. An empty array has none."""
    step = max(1, size - overlap)
    n = F.size(items)
    starts = F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(step)), lambda i: (i == 0) | (i + (size - step) < n))
    return F.when(n > 0, F.transform(starts, lambda i: F.slice(items, i + 1, size)))


def word_windows(text: Column, size: int = 500, overlap: int = 100) -> Column:
    """A text of up to ``size`` words unchanged; a longer one as windows of words joined by blanks."""
    w = words(text)
    return F.when(F.size(w) <= size, F.array(text)).otherwise(F.transform(windows(w, size, overlap), lambda x: F.array_join(x, " ")))


def token_windows(text: Column, size: int, overlap: int = 0) -> Column:
    """Windows of tokens of the default tokenizer, joined by blanks."""
    return F.transform(windows(regex_tokens(text), size, overlap), lambda x: F.array_join(x, " "))


def token_windows_with_prefix(prefix: str, body: Column, size: int, overlap: int) -> Column:
    """Windows that all start with the prefix, a blank line and what fits beside them; a long prefix is clamped.

    The blank line counts as no token of the default tokenizer.
    """
    head = TOKEN.findall(prefix)[: max(0, size)]
    room = max(1, size - len(head))
    lead = " ".join(head) + "\n\n" if head else ""
    cut = windows(regex_tokens(body), room, min(max(0, overlap), room - 1))
    return F.transform(cut, lambda x: F.concat(F.lit(lead), F.array_join(x, " ")))


def token_count(text: Column) -> Column:
    return F.size(regex_tokens(text))


# --- single texts ----------------------------------------------------------------------------------------------------


def protect_tables(text: str) -> str:
    """Runs of lines that start with a pipe or a code fence become one line."""
    out: list[str] = []
    run: list[str] = []
    for line in [*text.splitlines(), None]:
        if line is not None and line.strip().startswith(("```", "|")):
            run.append(line)
            continue
        if run:
            out.append(" ".join(run))
            run = []
        if line is not None:
            out.append(line)
    return "\n".join(out)


def markdown_sections(text: str) -> list[tuple[str | None, str | None, str | None, str]]:
    """(h1, h2, h3, body) by headings of three levels; a higher heading resets lower ones, code fences are left alone."""
    heads: list[str | None] = [None, None, None]
    out: list[tuple] = []
    body: list[str] = []
    fence = ""

    def close() -> None:
        joined = "\n".join(body).strip()
        if joined:
            out.append((*heads, joined))
        body.clear()

    for line in text.split("\n"):
        s = line.strip()
        mark = s[:3] if s[:3] in ("```", "~~~") else ""
        if mark and (not fence or mark == fence):
            fence = "" if fence else mark
        m = None if fence or mark else re.match(r"(#{1,3})\s+(.*)$", s)
        if m:
            close()
            level = len(m.group(1)) - 1
            heads[level:] = [m.group(2).strip(), *[None] * (2 - level)]
        else:
            body.append(line)
    close()
    return out


def recursive_split(text: str, size: int, overlap: int, separators: tuple[str, ...] = ("\n\n", "\n", " ", "")) -> list[str]:
    """Pieces of up to ``size`` characters at the strongest separator that helps, merged greedily with an overlap."""
    sep = next(s for s in separators if s == "" or s in text)
    rest = separators[separators.index(sep) + 1 :]
    parts = [p for p in (text.split(sep) if sep else list(text)) if p]
    out: list[str] = []
    small: list[str] = []
    for p in parts:
        if len(p) <= size:
            small.append(p)
            continue
        out += _merge(small, sep, size, overlap)
        small = []
        out += recursive_split(p, size, overlap, rest) if rest else [p]
    return out + _merge(small, sep, size, overlap)


def _merge(parts: list[str], sep: str, size: int, overlap: int) -> list[str]:
    out: list[str] = []
    held: list[str] = []
    total = 0
    for p in parts:
        if held and total + len(sep) + len(p) > size:
            out.append(sep.join(held).strip())
            while held and (total > overlap or total + len(sep) + len(p) > size):
                total -= len(held.pop(0)) + (len(sep) if held else 0)
        total += len(p) + (len(sep) if held else 0)
        held.append(p)
    out.append(sep.join(held).strip())
    return [x for x in out if x]


def pack_sentences(tag: str, body: str, cap: int = EMBEDDER_CAP, tokens: Tokens = regex_tokenizer, sentences: Callable[[str], list[str]] = split_sentences, overlap: int = 2, drop_redundant_tail: bool = False) -> list[str]:
    """Sentences packed up to ``cap`` tokens, each chunk led by the tag's line and repeating the last ``overlap`` ones.

    A sentence over the room is truncated to it. The next chunk starts ``overlap`` sentences before the end of the last
    one if that moves ahead; so a last chunk of more than ``overlap`` sentences is followed by its own tail, unless
    ``drop_redundant_tail``.
    """
    found = sentences(body) or [body]
    prefix = tag.strip() + "\n" if tag.strip() else ""
    room = max(1, cap - len(tokens(prefix)))
    cost: list[int] = []
    for k, s in enumerate(found):
        t = tokens(s)
        if len(t) > room:
            found[k] = " ".join(t[:room])
        cost.append(min(len(t), room))
    out: list[str] = []
    i = 0
    while i < len(found):
        j, total = i, 0
        while j < len(found) and total + cost[j] + (j > i) <= room:
            total += cost[j] + (j > i)
            j += 1
        j = max(j, i + 1)
        out.append((prefix + " ".join(found[i:j])).strip())
        if drop_redundant_tail and j >= len(found):
            break
        i = j - overlap if j - overlap > i else j
    return out


def trim_tokens(text: str, most: int, tokens: Tokens = regex_tokenizer, step: int = 50) -> str:
    """Drops the last ``step`` characters, as often as needed, until at most ``most`` tokens are left.

    A prefix never has more tokens than the whole, so the number of steps is found by bisection: the text is read some
    twenty times at most, not once for every step.
    """
    if len(tokens(text)) <= most:
        return text
    low, high = 0, -(-len(text) // step)  # steps that are too few, and enough
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (low, middle) if len(tokens(text[: len(text) - middle * step])) <= most else (middle, high)
    return text[: max(0, len(text) - high * step)]


def _slices(text: str, most: int, tokens: Tokens) -> list[str]:
    found = tokens(text)
    return [text] if len(found) <= most else [" ".join(found[i : i + most]) for i in range(0, len(found), most)]


def tag_of(h1: str | None, h2: str | None, h3: str | None = None) -> str:
    return ("§" + "/".join([h.strip() for h in (h1, h2, h3) if h and h.strip()][:2]))[:50]


def chunk_text(text: str | None, config: EngineConfig, tokens: Tokens = regex_tokenizer) -> list[tuple[int, int, str, str | None, str | None, str | None]]:
    """(section, piece, text, h1, h2, h3) of one document by the configured strategy."""
    out: list[tuple] = []
    if not text:
        return out
    simple = config.chunk_strategy == "simple"
    for n, (h1, h2, h3, body) in enumerate(markdown_sections(text if simple else protect_tables(text))):
        if simple:
            parts = recursive_split(body, config.chunk_size, config.chunk_overlap)
        elif config.chunk_strategy == "recursive":
            cut = [p.strip() for p in recursive_split(body, config.chunk_size, config.chunk_overlap)]
            packed = [q for p in cut if p for q in pack_sentences(tag_of(h1, h2, h3), p, EMBEDDER_CAP, tokens, drop_redundant_tail=config.drop_redundant_tail)]
            parts = [trim_tokens(q, config.max_chunk_tokens, tokens) for q in packed]
        else:
            packed = pack_sentences(tag_of(h1, h2), body, EMBEDDER_CAP, tokens, overlap=config.semantic_overlap, drop_redundant_tail=config.drop_redundant_tail)
            parts = [trim_tokens(s, config.max_chunk_tokens, tokens) for q in packed for s in _slices(q, EMBEDDER_CAP, tokens)]
        out += [(n, k, p, h1, h2, h3) for k, p in enumerate(x for x in parts if x.strip())]
    return out


def chunks(docs: DataFrame, key: str, content: str, config: EngineConfig | None = None, tokens: Tokens = regex_tokenizer) -> DataFrame:
    """(key, section_ord, piece_ord, chunk, h1, h2, h3, split_method) of each document."""
    config = config or EngineConfig()
    piece = T.StructType([T.StructField("section_ord", T.IntegerType()), T.StructField("piece_ord", T.IntegerType()), *[T.StructField(x, T.StringType()) for x in ("chunk", "h1", "h2", "h3")]])

    @F.pandas_udf(T.ArrayType(piece))
    def cut(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [dict(zip(piece.names, x, strict=True)) for x in chunk_text(t, config, tokens)])

    method = F.lit("semantic" if config.chunk_strategy == "semantic" else None).cast("string")
    return docs.select(F.col(key), F.explode(cut(F.col(content))).alias("x")).select(key, "x.*", method.alias("split_method"))


@F.pandas_udf(T.StringType())
def protected(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else protect_tables(t))


SECTION = T.ArrayType(T.StructType([T.StructField(x, T.StringType()) for x in ("h1", "h2", "h3", "body")]))


@F.pandas_udf(SECTION)
def sections(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [] if t is None else [dict(zip(("h1", "h2", "h3", "body"), s, strict=True)) for s in markdown_sections(t)])


def packed(cap: int = EMBEDDER_CAP, tag: str = "§") -> Callable[[Column], Column]:
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else pack_sentences(tag, t, cap))

    return run


def trimmed(most: int) -> Callable[[Column], Column]:
    @F.pandas_udf(T.StringType())
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else trim_tokens(t, most))

    return run


__all__ = ["chunks", "heading_tag", "pack_sentences", "protected", "sections", "token_count", "token_windows", "token_windows_with_prefix", "word_windows"]
