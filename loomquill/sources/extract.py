"""Providers that turn files into pages, tables and images, run by Arrow batches; the defaults need no models.

A provider is any object with the methods of ``Extractor``. Real models plug in by subclassing; each worker builds them
once, on first use.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomquill.functions.text import basename

PAGE_DDL = "source string, page int, page_content string, error string"
TABLE_DDL = "source string, page int, table_no int, headers array<string>, rows array<array<string>>, error string"
IMAGE_DDL = "source string, page int, xref int, rect string, width int, height int, ocr string, vision_label string, content binary, error string"


class Extractor:
    """The default reads plain bytes: form feeds part pages, and there are neither tables nor embedded images."""

    def pages(self, content: bytes) -> list[str]:
        return content.decode("utf-8", "replace").split("\f")

    def whole(self, content: bytes) -> str:
        """Used if ``pages`` fails; pages read before that are kept."""
        return content.decode("utf-8", "replace")

    def tables(self, content: bytes) -> list[tuple[int, list[str | None], list[list[str | None]]]]:
        return []

    def images(self, content: bytes) -> list[dict]:
        return []

    def caption(self, content: bytes) -> str:
        return ""

    def read_chart(self, content: bytes) -> str:
        return ""

    def spans(self, content: bytes) -> list[tuple[str, float | None]]:
        return []


def page_texts(files: DataFrame, extractor: Extractor) -> DataFrame:
    """One row per page that isn't blank, pages from 1; if a file fails, its whole text without a page, and the error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content in zip(f["path"], f["content"], strict=True):
                try:
                    for n, text in enumerate(extractor.pages(content), 1):
                        if text and text.strip():
                            rows.append((path, n, text, None))
                except Exception as e:  # one bad file must not end the scan
                    rows.append((path, None, extractor.whole(content), str(e)))
            yield pd.DataFrame(rows, columns=["source", "page", "page_content", "error"]).astype({"page": "Int32"})

    return files.where(F.col("route") == "pdf").select("path", "content").mapInPandas(run, PAGE_DDL)


def tables(files: DataFrame, extractor: Extractor) -> DataFrame:
    """One row per table; the first row of each is its header. A file that fails has one row with its error."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content in zip(f["path"], f["content"], strict=True):
                try:
                    rows += [(path, page, n, head, body, None) for n, (page, head, body) in enumerate(extractor.tables(content))]
                except Exception as e:
                    rows.append((path, None, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["source", "page", "table_no", "headers", "rows", "error"]).astype({"page": "Int32", "table_no": "Int32"})

    return files.where(F.col("route") == "pdf").select("path", "content").mapInPandas(run, TABLE_DDL)


def embedded_images(files: DataFrame, extractor: Extractor) -> DataFrame:
    """One row per placement of an image in a PDF, for ``operators.images.keep``; its bytes stay in the row."""
    names = ["source", "page", "xref", "rect", "width", "height", "ocr", "vision_label", "content", "error"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, content in zip(f["path"], f["content"], strict=True):
                try:
                    rows += [{"source": path, "error": None, **i} for i in extractor.images(content)]
                except Exception as e:
                    rows.append({"source": path, "error": str(e)})
            # objects: texts beside missing ones would become chunked arrays, which Arrow doesn't take here
            yield pd.DataFrame([[r.get(n) for n in names] for r in rows], columns=names, dtype=object).astype({"page": "Int32", "xref": "Int32", "width": "Int32", "height": "Int32"})

    return files.where(F.col("route") == "pdf").select("path", "content").mapInPandas(run, IMAGE_DDL)


def image_readings(files: DataFrame, extractor: Extractor, caption: bool = True, chart: bool = True, least_conf: float = 0.30) -> DataFrame:
    """(image_path, caption, chartqa, ocr) of standalone images; a reading that fails is empty."""

    def attempt(f, *args):
        try:
            return f(*args)
        except Exception:
            return ""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(p, attempt(extractor.caption, c) if caption else "", attempt(extractor.read_chart, c) if chart else "", " ".join(t for t, s in attempt(extractor.spans, c) or [] if s is None or s >= least_conf)) for p, c in zip(f["path"], f["content"], strict=True)]
            yield pd.DataFrame(rows, columns=["image_path", "caption", "chartqa", "ocr"])

    return files.where(F.col("route") == "image").select("path", "content").mapInPandas(run, "image_path string, caption string, chartqa string, ocr string")


def image_name(source: Column, page0: Column, xref: Column, rect: Column) -> Column:
    """The name under which an embedded image is kept: the hash of its file's base name, page from 0, number and place.

    Null parts are empty, so that no two places share a name by leaving one out.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (basename(source), page0, xref, rect)]
    return F.concat(F.sha1(F.concat_ws(":", *parts)), F.lit(".png"))
