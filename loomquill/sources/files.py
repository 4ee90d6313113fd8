"""File sources: recursive scan, routing by suffix, whole-text files, JSON bundles and the vector store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomquill.schema import BUNDLE_DDL, META_DDL, STORE_DDL

#: Suffixes whose type is an image.
IMAGE_SUFFIXES = ("bmp", "gif", "ico", "jpe", "jpeg", "jpg", "pbm", "pgm", "png", "ppm", "svg", "tif", "tiff", "webp", "heic", "avif")


def route(path: Column) -> Column:
    """'image', 'pdf' or 'text' by suffix, first match; null for files that are dropped."""
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.when(suffix.isin(*IMAGE_SUFFIXES), "image").when(suffix == "pdf", "pdf").when(suffix.isin("txt", "md"), "text")


def scan(spark: SparkSession, folder: str) -> DataFrame:
    """(path, route, modificationTime, length, content) of all files below a folder that have a route; content is read only if used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.withColumn("route", route(F.col("path"))).where(F.col("route").isNotNull())


def text_documents(files: DataFrame) -> DataFrame:
    """(page_content, metadata) of text files: a whole file is one document without a page; bytes that aren't UTF-8 become U+FFFD."""
    plain = files.where(F.col("route") == "text")
    meta = F.from_json(F.to_json(F.struct(F.regexp_replace("path", "^file:/*", "/").alias("source"), F.lit("text").alias("source_type"))), META_DDL)
    return plain.select(F.make_valid_utf8(F.col("content").cast("string")).alias("page_content"), meta.alias("metadata"))


def bundle(spark: SparkSession, path: str) -> DataFrame:
    """A JSON bundle as rows (modality, ord, page_content, metadata, source_dir); missing arrays are empty."""
    raw = spark.read.schema(BUNDLE_DDL).option("multiLine", True).json(path)
    parts = [raw.select(F.lit(m).alias("modality"), F.posexplode_outer(m).alias("ord", "d"), "source_dir").where(F.col("d").isNotNull()) for m in ("text_docs", "image_text_docs", "img_docs")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rows.select("modality", "ord", "d.page_content", "d.metadata", "source_dir")


def parse_metadata(text: Column) -> Column:
    """Metadata from a JSON string, or else from a Python literal; what is neither has all keys null."""
    strict = F.from_json(text, META_DDL, {"mode": "PERMISSIVE"})
    literal = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "'", '"'), r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
    return F.coalesce(F.when(F.try_parse_json(text).isNotNull(), strict), F.from_json(literal, META_DDL, {"mode": "PERMISSIVE", "allowSingleQuotes": "true"}), F.from_json(F.lit("{}"), META_DDL))


def parse_embedding(text: Column) -> Column:
    """A vector from its text form '[0.1, ...]'; null where it is none."""
    return F.from_json(text, "array<float>")


def store(spark: SparkSession, path: str, base: str | None = None, kind: str | None = None) -> DataFrame:
    """A store table; base and kind are its partitions, so filters on them prune files."""
    rows = spark.read.schema(STORE_DDL).parquet(path)
    for name, value in (("base", base), ("kind", kind)):
        if value is not None:
            rows = rows.where(F.col(name) == value)
    return rows


def jdbc_store(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    """A store kept in a relational database, with vector and metadata as text."""
    if not name.replace("_", "").isalnum():
        raise ValueError("a table's name must be letters, digits and underscores")
    rows = spark.read.format("jdbc").option("url", url).option("dbtable", name).options(**options).load()
    return rows.select("id", "document", parse_metadata(F.col("metadata").cast("string")).alias("metadata"), parse_embedding(F.col("embedding").cast("string")).alias("embedding"))
