"""Decisions on images: what is kept, what its readings say together, what it shows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomquill.functions.text import basename, strip

#: What an image may show; the first three are charts.
LABELS = ("chart", "diagram", "table", "screenshot", "document", "natural photo")
CHARTS = LABELS[:3]
MARK = " • "


def has_text(c: Column, least: int = 1) -> Column:
    """An ASCII letter or digit, and enough characters without the white space around them."""
    return F.coalesce(c.rlike("[A-Za-z0-9]") & (F.char_length(strip(c)) >= least), F.lit(False))


def keep(ocr: Column, width: Column, height: Column, label: Column, chart_like: bool = True) -> Column:
    """Whether an embedded image is kept: it has text, or it is large enough and chart-like."""
    large = (F.least(width, height) >= 48) & (width.cast("long") * height >= 16_000)
    return has_text(ocr, 6) | F.coalesce(large & (label.isin(*CHARTS) if chart_like else F.lit(True)), F.lit(False))


def confident(spans: Column, least: float = 0.30) -> Column:
    """Texts of spans <text, conf> with no confidence or enough of it, joined by blanks."""
    return F.array_join(F.transform(F.filter(spans, lambda s: s["conf"].isNull() | (s["conf"] >= least)), lambda s: s["text"]), " ")


def fuse(*readings: Column) -> Column:
    """The readings that aren't empty, joined by a bullet; null if there are none."""
    joined = F.array_join(F.filter(F.array(*readings), lambda x: x.isNotNull() & (x != "")), MARK)
    return F.when(joined != "", joined)


def is_image_text(metadata: str = "metadata") -> Column:
    """Whether a document came from an image."""
    return F.coalesce(F.col(f"{metadata}.source_type") == "image_text", F.lit(False)) | F.col(f"{metadata}.image_path").isNotNull()


def stub(source: Column, page: Column, path: Column, label: Column) -> Column:
    """'image [(label)] from <name> [page N]'."""
    name = F.coalesce(F.nullif(basename(F.coalesce(F.nullif(source, F.lit("")), path)), F.lit("")), F.lit("image"))
    return F.concat_ws(" ", F.lit("image"), F.when(label != "", F.concat(F.lit("("), label, F.lit(")"))), F.lit("from"), name, F.when(page.isNotNull() & (page != 0), F.concat(F.lit("page "), page.cast("string"))))


def zero_shot(images: DataFrame, key: str, vector: str, prompts: list[list[float]]) -> DataFrame:
    """(key, label_no, score): the prompt of largest cosine, the first of equals. Prompts are few and literal."""

    def unit(v: list[float]) -> list[float]:
        n = sum(x * x for x in v) ** 0.5
        return [x / n if n else 0.0 for x in v]

    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    scores = []
    for p in prompts:
        weights = F.array(*[F.lit(x) for x in unit(p)])
        scores.append(F.aggregate(F.zip_with(F.col(vector), weights, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x))
    rounded = F.transform(F.array(*scores), lambda s: F.round(s / F.col("_norm"), 9))
    return images.withColumn("_norm", norm).where(F.col("_norm") > 0).select(key, rounded.alias("scores")).select(key, (F.array_position("scores", F.array_max("scores")) - 1).alias("label_no"), F.array_max("scores").alias("score"))


def union_by_name(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
