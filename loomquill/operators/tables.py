"""Extracted tables (headers, rows) as Markdown, JSON and sentences."""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomquill.functions.text import strip


def _cells(c: Column) -> Column:
    return F.transform(c, lambda x: F.coalesce(x, F.lit("")))


def to_markdown(headers: Column, rows: Column) -> Column:
    """A pipe table with a rule under the header and a newline at the end; null cells are empty."""

    def line(cells: Column) -> Column:
        return F.concat(F.lit("| "), F.array_join(_cells(cells), " | "), F.lit(" |\n"))

    rule = F.concat(F.lit("|"), F.array_join(F.transform(headers, lambda _: F.lit("---")), "|"), F.lit("|\n"))
    return F.concat(line(headers), rule, F.array_join(F.transform(rows, line), ""))


def to_json(headers: Column, rows: Column) -> Column:
    """{"headers": [...], "rows": [[...]]} without spaces; null headers are empty, null cells stay null."""
    return F.to_json(F.struct(_cells(headers).alias("headers"), rows.alias("rows")), {"ignoreNullFields": "false"})


def to_csv(headers: Column, rows: Column) -> Column:
    """Cells joined by commas without quoting, a line per row."""
    return F.array_join(F.transform(F.concat(F.array(headers), rows), lambda r: F.array_join(_cells(r), ",")), "\n")


def row_sentences(headers: Column, rows: Column) -> Column:
    """'Row -> h: v, ...' for each row that isn't the header again, without white space around headers and values; pairs
    end with the shorter side."""
    head = _cells(headers)

    def sentence(row: Column) -> Column:
        cells = _cells(row)
        n = F.least(F.size(head), F.size(cells))
        pairs = F.zip_with(F.slice(head, 1, n), F.slice(cells, 1, n), lambda h, v: F.concat(strip(h), F.lit(": "), strip(v)))
        return F.concat(F.lit("Row -> "), F.array_join(pairs, ", "))

    return F.transform(F.filter(rows, lambda r: _cells(r) != head), sentence)


@F.pandas_udf(T.ArrayType(T.StringType()))
def csv_sentences(text: pd.Series, headers: pd.Series) -> pd.Series:
    """The same from unquoted CSV text, parsed again: commas and newlines inside cells then shift columns."""

    def one(raw, head):
        head = ["" if h is None else h for h in head]
        return ["Row -> " + ", ".join(f"{h.strip()}: {v.strip()}" for h, v in zip(head, row, strict=False)) for row in csv.reader(io.StringIO(raw)) if row != head]

    return pd.Series([one(t, h) for t, h in zip(text, headers, strict=True)])
