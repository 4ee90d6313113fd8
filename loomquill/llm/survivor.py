"""One surviving record for each group of records that describe the same image file.

All attributes are decided in one aggregation: the maximum of a composite struct (trust, time, smallest id, value)
per attribute. It is combined on the map side, so a group that holds a third of all rows sends one row per task.

Defined results: a null or blank path belongs to no group; rows repeated under one id count once; an attribute for
which no record has a value is null in ``survivors`` and has no row in ``winners``; equal trust and time go to the
smallest id; an extractor that is null or not listed ranks below every listed one; a null time is the earliest;
empty tables give no rows; further columns of the input are ignored.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomquill.functions.text import strip

ATTRIBUTES = ("source", "page", "vision_label", "caption", "chartqa", "ocr")
#: Strings that stand for a missing value, compared in lower case.
FILLERS = ("", "-", "--", "---", "?", ".", "n/a", "na", "n.a.", "nan", "nil", "none", "null", "unknown", "undefined", "unspecified", "not available", "not specified", "missing", "tbd", "todo", "xxx")
LEAST = -(2**63)


@F.pandas_udf(T.StringType())
def composed(s: pd.Series) -> pd.Series:
    """Unicode form NFC; Spark has no such function."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFC", x))


def canonical_path(path: Column, folder: Column) -> Column:
    """The file that ``path`` names, however written; relative paths start at ``folder``. Letter case counts."""
    given = strip(path)
    uri = given.rlike("(?i)^file:")
    decoded = F.coalesce(F.try_url_decode(F.replace(F.regexp_replace(given, "(?i)^file:(//[^/\\\\]*(?=[/\\\\]))?", ""), F.lit("+"), F.lit("%2B"))), F.regexp_replace(given, "(?i)^file:", ""))
    plain = F.translate(F.when(uri, decoded).otherwise(given), "\\", "/")
    rooted = F.when(plain.rlike("^(/|[A-Za-z]:/)"), plain).otherwise(F.concat(F.translate(F.coalesce(strip(folder), F.lit("")), "\\", "/"), F.lit("/"), plain))
    parts = F.filter(F.split(rooted, "/"), lambda x: (x != "") & (x != "."))
    empty = F.array().cast("array<string>")
    folded = F.aggregate(parts, empty, lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(x))))
    return F.when(given != "", F.concat(F.lit("/"), F.array_join(folded, "/")))


def _valid(name: str) -> Column:
    c = F.col(f"metadata.{name}")
    if name == "page":
        return c >= 1
    return c.isNotNull() if name in ("caption", "chartqa", "ocr") else c.isNotNull() & ~F.lower(strip(c)).isin(*FILLERS)


def survivors(records: DataFrame, trust: DataFrame) -> DataFrame:
    """(group_id, n_records, one struct <trust, time, negative rec_id, value> for each of ATTRIBUTES).

    ``records``: rec_id, metadata, source_dir, extractor, ingested_at. ``trust``: extractor, trust_level. Groups of a
    single record are kept here (n_records_above_one is false) so that the output is the whole deduplicated table.
    """
    levels = trust.where(F.col("extractor").isNotNull()).groupBy("extractor").agg(F.max("trust_level").cast("long").alias("_level"))
    rows = (
        records.select("rec_id", "metadata", "source_dir", "extractor", "ingested_at")
        .where(F.col("rec_id").isNotNull() & (strip(F.col("metadata.image_path")) != ""))
        .join(levels, "extractor", "left")
        .select(
            "rec_id",
            "metadata",
            composed(canonical_path(F.col("metadata.image_path"), F.col("source_dir"))).alias("_file"),
            F.coalesce("_level", F.lit(LEAST)).alias("_level"),
            F.coalesce(F.unix_micros(F.col("ingested_at").cast("timestamp")), F.lit(LEAST)).alias("_at"),
        )
    )
    best = [F.max(F.when(_valid(a), F.struct(F.col("_level").alias("level"), F.col("_at").alias("at"), (-F.col("rec_id")).alias("minus_id"), F.col(f"metadata.{a}").alias("value")))).alias(a) for a in ATTRIBUTES]
    return rows.groupBy("_file").agg(F.min("rec_id").alias("group_id"), (F.min("rec_id") != F.max("rec_id")).alias("n_records_above_one"), *best).withColumnRenamed("_file", "file")


def winners(records: DataFrame, trust: DataFrame) -> DataFrame:
    """(group_id, attr, rec_id): the record that gives each surviving value, for groups of two or more records."""
    listed = F.explode(F.array(*[F.struct(F.lit(a).alias("attr"), (-F.col(f"{a}.minus_id")).alias("rec_id")) for a in ATTRIBUTES]))
    return survivors(records, trust).where("n_records_above_one").select("group_id", listed.alias("x")).select("group_id", "x.attr", "x.rec_id").where(F.col("rec_id").isNotNull())
