"""Distinct rows where the first one wins; order is always an explicit column.

The winner is the minimum of a struct, so groups are combined before the shuffle and none is gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomquill.functions.text import collapse, strip


def first_rows(rows: DataFrame, keys: dict[str, Column], order: list[Column], columns: list[str]) -> DataFrame:
    """The row with the smallest ``order`` of each key; null keys are equal. Gives ``columns`` only."""
    first = F.min_by(F.struct(*columns), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_first")
    return rows.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(first).select("_first.*")


def documents(docs: DataFrame, order: Column, content: str = "page_content", metadata: str = "metadata", least: int = 12, keep: list[str] | None = None) -> DataFrame:
    """Drops short texts; of equal texts (case and white space aside) on one page of one source the first is kept."""
    m = F.col(metadata)
    anchor = F.coalesce(F.nullif(m["source"], F.lit("")), F.nullif(m["image_path"], F.lit("")), F.lit("na"))
    long = docs.where(F.char_length(strip(F.col(content))) >= least)
    keys = {"_anchor": anchor, "_page": m["page"], "_text": F.sha2(F.lower(collapse(F.col(content))), 256)}
    return first_rows(long, keys, [order], keep or docs.columns)


def image_rows(rows: DataFrame, rank: Column, order: Column, columns: list[str], metadata: str = "metadata") -> DataFrame:
    """One row per (image_path, source, page): texts from images come before stubs."""
    m = F.col(metadata)
    return first_rows(rows, {"_path": m["image_path"], "_source": m["source"], "_page": m["page"]}, [rank, order], columns)


def cap_sections(hits: DataFrame, keys: list[str], rank: str = "rank", most: int = 2) -> DataFrame:
    """At most ``most`` hits per request and section, in rank order. ``keys`` start with the request."""
    w = Window.partitionBy(*keys).orderBy(rank)
    return hits.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")


def first_seen(values: Column) -> Column:
    """Distinct values of an ordered array, each at its first place."""
    return F.array_distinct(values)


def bag_union(first: DataFrame, second: DataFrame, rank: str = "rank") -> DataFrame:
    """UNION ALL in which all of ``first`` comes before ``second``; nothing is removed."""
    return first.withColumn("part", F.lit(0)).unionByName(second.withColumn("part", F.lit(1))).withColumn("order", F.struct("part", rank))
