"""Column helpers on strings that are shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space as Python's str.strip and str.split see it.
SPACE = r"[\t-\r\x1c-\x20\x{85}\p{Z}]"


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends; null stays null."""
    return F.regexp_replace(F.regexp_replace(c, f"^{SPACE}+", ""), f"(?<!{SPACE}){SPACE}+$", "")


def collapse(c: Column) -> Column:
    """White space runs become one blank, none at the ends."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def words(c: Column) -> Column:
    """Tokens between white space; an empty or blank text has none."""
    return F.filter(F.split(collapse(c), " "), lambda w: w != "")


def basename(c: Column) -> Column:
    """The last part of a path."""
    return F.regexp_extract(c, "([^/]*)/*$", 1)


def shorten(c: Column, width: int = 600) -> Column:
    """Collapse white space; beyond ``width`` characters keep what fits with ' [...]' after it.

    It is cut between words, or after a hyphen between letters as the standard library's textwrap does.
    """
    flat = collapse(c)
    kept = F.regexp_extract(flat, rf"^(.{{1,{width - 6}}})(?: |(?<=[\p{{L}}_]{{2}}-)(?=[\p{{L}}_]-?[\p{{L}}_]))", 1)
    return F.when(F.char_length(flat) <= width, flat).otherwise(F.when(kept == "", "[...]").otherwise(F.concat(kept, F.lit(" [...]"))))


def heading_tag(*headings: Column, most: int = 50) -> Column:
    """'§' and the first two headings that aren't blank, joined by '/', cut to ``most`` characters."""
    named = F.filter(F.array(*[strip(h) for h in headings]), lambda h: h.isNotNull() & (h != ""))
    return F.substring(F.concat(F.lit("§"), F.array_join(F.slice(named, 1, 2), "/")), 1, most)


#: Words that show that a question asks for a procedure.
PROCEDURAL = r"(?i)\b(install|installation|steps|procedure|instructions?|set ?up|assemble|mount|tighten|remove|replace|adjust)\b"


def is_procedural(question: Column) -> Column:
    return F.coalesce(question.rlike(PROCEDURAL), F.lit(False))


#: The default tokenizer: runs of letters, digits and underscores, and every other character that isn't white space.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\p{Z}]"


def regex_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(TOKEN), F.lit(0))
