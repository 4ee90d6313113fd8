"""From a folder of files to the documents that the ingest plan takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomquill.config import EngineConfig
from loomquill.operators import chunking, images, tables
from loomquill.schema import META_DDL
from loomquill.session import cut
from loomquill.sources import extract, files
from loomquill.sources.pdf import PlainPdf


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/*", "/")


def _meta(**values: Column) -> Column:
    m = F.from_json(F.lit("{}"), META_DDL)
    for name, value in values.items():
        m = m.withField(name, value)
    return m


def _placed(rows: DataFrame, kind: int, path: Column, *place: Column) -> DataFrame:
    """Adds ``ord``: path, page, kind of document and place, which order the documents of a scan."""
    zero = F.lit(0)
    page, at, part = (*[F.coalesce(p.cast("int"), zero) for p in place], zero, zero, zero)[:3]
    return rows.select(F.struct(path.alias("path"), page.alias("page"), F.lit(kind).alias("kind"), at.alias("at"), part.alias("part")).alias("ord"), "page_content", "metadata")


def documents(spark: SparkSession, folder: str, extractor: extract.Extractor | None = None, config: EngineConfig | None = None) -> DataFrame:
    """(ord, page_content, metadata) of all files below ``folder``: whole text files, pages of PDF files in windows of words,
    their tables as Markdown, JSON and sentences, and what is read from images, standalone and embedded. Images of which
    nothing is read have an empty page_content. A file that fails gives what could be read of it and never ends the scan."""
    config, extractor = config or EngineConfig(), extractor or PlainPdf()
    found = files.scan(spark, folder)
    text = files.text_documents(found)
    out = _placed(text, 0, F.col("metadata.source"))

    pages = extract.page_texts(found, extractor).select("source", "page", F.posexplode(chunking.word_windows(F.col("page_content"))).alias("at", "page_content"))
    pages = pages.withColumn("metadata", _meta(source=_plain(F.col("source")), page=F.col("page"), source_type=F.lit("text")))
    out = out.unionByName(_placed(pages, 1, F.col("metadata.source"), F.col("page"), F.col("at")))

    made = cut(extract.tables(found, extractor).where(F.col("error").isNull()))
    flags = ("table_md", "table_json", "table_row")
    for k, (flag, content) in enumerate(zip(flags, (F.array(tables.to_markdown(F.col("headers"), F.col("rows"))), F.array(tables.to_json(F.col("headers"), F.col("rows"))), tables.row_sentences(F.col("headers"), F.col("rows"))), strict=True)):
        rows = made.select("source", "page", "table_no", F.posexplode(content).alias("part", "page_content"))
        meta = _meta(source=_plain(F.col("source")), page=F.col("page"), source_type=F.lit("text"), **{flag: F.lit(True)})
        out = out.unionByName(_placed(rows.withColumn("metadata", meta), 2 + k, F.col("metadata.source"), F.col("page"), F.col("table_no"), F.col("part")))

    standalone = found.where(F.col("route") == "image").select("path", "route", "content")
    seen = read(standalone, extractor, config).withColumn("image_path", _plain(F.col("image_path")))
    out = out.unionByName(_image_documents(seen.withColumn("source", F.lit(None).cast("string")).withColumn("page", F.lit(None).cast("int")).withColumn("vision_label", F.lit(None).cast("string"))))
    if config.extract_images:
        inside = extract.embedded_images(found, extractor).where(F.col("error").isNull())
        kept = inside.where(images.keep(F.col("ocr"), F.col("width"), F.col("height"), F.col("vision_label"), config.keep_chart_like))
        name = extract.image_name(F.col("source"), F.col("page") - 1, F.col("xref"), F.col("rect"))
        kept = cut(kept.withColumn("image_path", F.concat(F.lit(config.image_store_folder.rstrip("/") + "/"), name)))
        described = read(kept.select(F.col("image_path").alias("path"), F.lit("image").alias("route"), "content"), extractor, config)
        where = kept.select("image_path", _plain(F.col("source")).alias("source"), "page", "vision_label").dropDuplicates(["image_path"])
        out = out.unionByName(_image_documents(described.dropDuplicates(["image_path"]).join(where, "image_path")))
    return out


def read(found: DataFrame, extractor: extract.Extractor, config: EngineConfig) -> DataFrame:
    """(image_path, caption, chartqa, ocr) of images, with the readings that are switched on."""
    return extract.image_readings(found, extractor, caption=config.use_blip, chart=config.use_chartqa)


def _image_documents(seen: DataFrame) -> DataFrame:
    flags = {c: F.coalesce(F.col(c) != "", F.lit(False)) for c in ("caption", "chartqa", "ocr")}
    text = F.coalesce(images.fuse(F.col("caption"), F.col("chartqa"), F.col("ocr")), F.lit(""))
    meta = _meta(source=F.col("source"), page=F.col("page"), image_path=F.col("image_path"), vision_label=F.col("vision_label"), source_type=F.lit("image_text"), **flags)
    rows = seen.select(text.alias("page_content"), meta.alias("metadata"), F.coalesce("source", "image_path").alias("path"), "page")
    return _placed(rows, 9, F.col("path"), F.col("page"))
