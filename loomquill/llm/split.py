"""Cutting oversized texts into pieces under a limit, at natural boundaries, with an overlap.

One regular expression with bounded quantifiers is extracted over and over: its alternatives are ordered by the strength
of the boundary (paragraph, line, sentence, word, any character that is no letter or digit) and the last one takes
characters up to the limit. Each piece then repeats the end of the one before, found by an offset into the text. All of
it is SQL functions of arrays; there is no shuffle.

Defined results: lengths are Unicode code points; a text is trimmed first; null, empty and blank texts give no piece; a
text within the limit is one piece; rows are not compared with each other, so repeated rows give repeated pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomquill.functions.text import SPACE, strip

LIMIT, OVERLAP = 1800, 200
BOUNDARIES = ("paragraph", "line", "sentence", "word", "mark", "character")


def _pattern(most: int) -> str:
    """Alternatives from the strongest boundary to none. A stronger one is taken only if it leaves at least a third."""
    least = max(1, most // 3)
    ends = (r"\n\s{0,8}\n", r"\n", r"[.!?。！？][\"'”»)\]]{0,2}(?:\s|(?<=[。！？]))", r"\s", r"[^\p{L}\p{N}]")
    widths = (12, 1, 4, 1, 1)
    cuts = "|".join(f"(?s:.{{{min(least, most - w)},{most - w}}}){e}" for e, w in zip(ends, widths, strict=True) if most > w)
    return f"(?s:.{{1,{most}}})\\z|{cuts}|(?s:.{{1,{most}}})"


def _kind(body: Column, last: Column) -> Column:
    """The boundary at which a piece ends, read off its own end."""
    return (
        F.when(last, "end")
        .when(body.rlike(r"\n\s*\n$"), "paragraph")
        .when(body.rlike(r"\n$"), "line")
        .when(body.rlike(r"([.!?][\"'”»)\]]{0,2}\s|[。！？][\"'”»)\]]{0,2}\s?)$"), "sentence")
        .when(body.rlike(rf"{SPACE}$"), "word")
        .when(body.rlike(r"[^\p{L}\p{N}]$"), "mark")
        .otherwise("character")
    )


def pieces(text: Column, limit: int = LIMIT, overlap: int = OVERLAP) -> Column:
    """Array of (piece, start, fresh, boundary): the text of the piece, where its new part starts (from 0) and how long
    that is, and the kind of boundary at its end. A piece is never longer than ``limit``."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be below the limit")
    # every piece but the first repeats up to `overlap` characters, so `limit - overlap` new ones fit
    pattern = F.lit(_pattern(limit - overlap))

    def cut(whole: Column) -> Column:
        one = F.when(whole != "", F.array(_piece(whole, F.lit(0), F.char_length(whole), F.lit("end"))))
        many = _let(F.regexp_extract_all(whole, pattern, F.lit(0)), lambda bodies: _let(_starts(bodies), lambda starts: _overlapped(bodies, starts, overlap)))
        return F.when(F.char_length(whole) <= limit, one).otherwise(many)

    return _let(strip(text), cut)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use).getItem(0)


def _starts(bodies: Column) -> Column:
    """Where each body starts: running sums of their lengths, in one pass."""
    zero = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("total"))
    step = lambda s, b: F.struct(F.concat(s["starts"], F.array(s["total"])).alias("starts"), (s["total"] + F.char_length(b)).alias("total"))
    return F.aggregate(bodies, zero, step, lambda s: s["starts"])


def _piece(piece: Column, start: Column, fresh: Column, boundary: Column) -> Column:
    return F.struct(piece.alias("piece"), start.cast("int").alias("start"), fresh.cast("int").alias("fresh"), boundary.alias("boundary"))


def _overlapped(bodies: Column, starts: Column, overlap: int) -> Column:
    """Adds to each body the end of the one before: from a word's start where there is one within the last characters."""

    def one(body: Column, i: Column) -> Column:
        before = F.when(i > 0, F.element_at(bodies, F.greatest(i, F.lit(1)).cast("int")))
        tail = F.right(before, F.lit(overlap)) if overlap else F.lit("")
        kept = F.when(F.char_length(before) <= overlap, before).otherwise(F.coalesce(F.nullif(F.regexp_extract(tail, r"(?s)^.*?\s(\S.*)$", 1), F.lit("")), tail))
        return _piece(F.concat(F.coalesce(kept, F.lit("")), body), F.get(starts, i), F.char_length(body), _kind(body, i == F.size(bodies) - 1))

    return F.transform(bodies, one)


def split(rows: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, piece_no from 0, piece, start, fresh, boundary), one row per piece."""
    cut = rows.select(F.col(key), F.posexplode(pieces(F.col(text), limit, overlap)).alias("piece_no", "p"))
    return cut.select(key, "piece_no", "p.piece", "p.start", "p.fresh", "p.boundary")


def size_cases(rows: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, size_case): 'oversized' texts, and 'unbreakable' ones with a run of more than ``limit`` letters and digits.

    The pieces decide: a text is oversized if it is cut at all, and only one that had to be cut between two characters
    can hold such a run, which is then looked for in it.
    """
    cut = pieces(F.col(text), limit, overlap)
    hard = F.exists(F.col("_cut"), lambda p: p["boundary"] == "character") & F.col("_text").rlike(rf"[\p{{L}}\p{{N}}]{{{limit + 1}}}")
    cases = rows.select(F.col(key).alias("_key"), F.col(text).alias("_text"), cut.alias("_cut")).where(F.size("_cut") > 1)
    kinds = F.when(hard, F.array(F.lit("oversized"), F.lit("unbreakable"))).otherwise(F.array(F.lit("oversized")))
    return cases.select(F.col("_key").alias(key), F.explode(kinds).alias("size_case"))
