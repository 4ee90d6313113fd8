"""Context for an answer: labels, merged pages, figures, citations, the prompt and the reply."""

from __future__ import annotations

from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomquill.functions.text import basename, shorten, strip

#: The metadata flags a label shows, in this order.
FLAGS = ("table_md", "table_json", "table_row", "chartqa", "ocr", "caption")
#: The default instructions of a prompt, a parameter of ``prompt``.
INSTRUCTIONS = (
    "Numbered excerpts of documents follow the question. They are all you know: what they don't say, you don't say either.",
    "End with the heading 'Citation(s):' and, below it, one line for each document and page that your answer rests on; the text itself stays free of source numbers.",
    "Links to files come from the block 'Related figure(s)' only. Where that block exists, carry its lines over as they stand; where it doesn't, give no link.",
)
GUARD = "The only file:// links allowed are those listed under 'Related figure(s)' in the user's message, if it has that list."
FIGURE_GUARD = "This request has a 'Related figure(s)' list: its lines belong into the answer, character by character."


def _name(m: Column) -> Column:
    """The document's name, or the image's where there is no document."""
    return F.coalesce(F.nullif(basename(F.coalesce(F.nullif(m["source"], F.lit("")), m["image_path"])), F.lit("")), F.lit("unknown"))


def label(m: Column, number: Column) -> Column:
    """'Source 3: name.pdf (flag/flag) (page 2)'; for text read from an image 'Source 3: image.png (from image) ...'."""
    read = F.coalesce(m["caption"], F.lit(False)) | F.coalesce(m["ocr"], F.lit(False)) | F.coalesce(m["chartqa"], F.lit(False))
    from_image = F.coalesce(m["image_path"] != "", F.lit(False)) & read
    name = F.when(from_image, F.coalesce(F.nullif(basename(m["image_path"]), F.lit("")), F.lit("unknown"))).otherwise(_name(m))
    flags = F.array_join(F.filter(F.array(*[F.when(m[f], f) for f in FLAGS]), lambda x: x.isNotNull()), "/")
    return F.concat(F.lit("Source "), number.cast("string"), F.lit(": "), name, F.when(from_image, " (from image)").otherwise(""), F.when(flags != "", F.concat(F.lit(" ("), flags, F.lit(")"))).otherwise(""), F.when(m["page"].isNotNull(), F.concat(F.lit(" (page "), m["page"].cast("string"), F.lit(")"))).otherwise(""))


def snippet(m: Column, number: Column, document: Column, width: int = 600) -> Column:
    return F.concat_ws("\n", label(m, number), shorten(document, width))


def cut_at_space(c: Column, most: int) -> Column:
    """Up to ``most`` characters, ending before the last blank if there is one."""
    head = F.substring(c, 1, most)
    return F.when(F.char_length(c) <= most, c).otherwise(F.regexp_replace(head, " [^ ]*$", ""))


def merge_by_page(hits: DataFrame, rank: str = "rank", most: int = 1600) -> DataFrame:
    """(query, source, page, rank of the first, text, metadata of the first): documents of one page in rank order.

    A request has few hits; pages without source and number are one group.
    """
    g = hits.groupBy("query", F.col("metadata.source").alias("source"), F.col("metadata.page").alias("page"))
    parts = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.coalesce("document", F.lit("")).alias("d"))))
    merged = g.agg(F.min(rank).alias("rank"), parts.alias("parts"), F.min_by("metadata", rank).alias("metadata"))
    text = strip(F.array_join(F.transform("parts", lambda p: p["d"]), " "))
    return merged.select("query", "source", "page", "rank", cut_at_space(text, most).alias("text"), "metadata")


def page_images(pages: DataFrame, images: DataFrame, order: str, per_page: int = 3, total: int = 8, pathless_count: bool = False) -> DataFrame:
    """(query, source, page, image_path, n): images of the pages (query, source, page, rank), up to ``per_page`` of each.

    Pages go on until ``total`` is reached, which is looked at between pages only; of one path the first stays. With
    ``pathless_count`` rows without a path take a page's places too, as in a store kept in a relational database.
    """
    has_path = F.col("image_path").isNotNull() & (F.col("image_path") != "")
    on_page = Window.partitionBy("source", "page").orderBy(order)
    known = images.where(F.col("page").isNotNull())
    if pathless_count:
        known = known.withColumn("_n", F.row_number().over(on_page)).where(F.col("_n") <= per_page)
    first = known.where(has_path).withColumn("_n", F.row_number().over(on_page)).where(F.col("_n") <= per_page)
    asked = pages.where(F.col("source").isNotNull() & F.col("page").isNotNull()).groupBy("query", "source", "page").agg(F.min("rank").alias("rank"))
    found = asked.join(first.select("source", "page", "image_path", "_n"), ["source", "page"])
    in_order = Window.partitionBy("query").orderBy("rank", "_n")
    counted = found.withColumn("n", F.row_number().over(in_order)).withColumn("_before", F.col("n") - F.col("_n"))
    kept = counted.where(F.col("_before") < total)
    once = kept.groupBy("query", "image_path").agg(F.min_by(F.struct("source", "page", "n"), "n").alias("x"))
    return once.select("query", "x.source", "x.page", "image_path", "x.n")


@F.pandas_udf(T.StringType())
def file_url(paths: pd.Series) -> pd.Series:
    return paths.map(lambda p: None if p is None else "file://" + quote(p, safe="/~"))


def links(images: DataFrame) -> DataFrame:
    """Adds abs_path, file_url, filename and md_link to rows with image_path (absolute)."""
    with_url = images.withColumn("abs_path", F.col("image_path")).withColumn("file_url", file_url(F.col("image_path"))).withColumn("filename", basename(F.col("image_path")))
    return with_url.withColumn("md_link", F.concat(F.lit("["), "filename", F.lit("]("), "file_url", F.lit(")")))


def citation(m: Column) -> Column:
    """'name, page N'."""
    return F.concat(_name(m), F.when(m["page"].isNotNull(), F.concat(F.lit(", page "), m["page"].cast("string"))).otherwise(""))


def citation_struct(m: Column) -> Column:
    """<source, page> of a merged row; the image's path stands in if both are missing."""
    none = F.coalesce(F.nullif(m["source"], F.lit("")), m["page"].cast("string")).isNull()
    return F.struct(F.when(none, m["image_path"]).otherwise(F.nullif(m["source"], F.lit(""))).alias("source"), m["page"].alias("page"))


def citations(hits: DataFrame, rank: str = "rank") -> DataFrame:
    """(query, n, line): distinct citation lines in rank order."""
    lines = hits.select("query", citation(F.col("metadata")).alias("line"), F.col(rank).alias("_r")).groupBy("query", "line").agg(F.min("_r").alias("_r"))
    return lines.select("query", F.row_number().over(Window.partitionBy("query").orderBy("_r")).alias("n"), "line")


def figure_lines(images: DataFrame, most: int = 8) -> DataFrame:
    """(query, figures): the first lines '- [name](url) — source, page N' of a request."""
    line = F.concat(F.lit("- "), "md_link", F.lit(" — "), basename(F.col("source")), F.lit(", page "), F.col("page").cast("string"))
    own = images.select("query", "n", line.alias("line")).groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("x"))
    return own.select("query", F.transform(F.slice("x", 1, most), lambda x: x["line"]).alias("figures"))


def prompt(question: Column, blocks: Column, lines: Column, figures: Column | None = None, instructions: tuple[str, ...] = INSTRUCTIONS) -> Column:
    """Instructions, the question, the sources' snippets, figures if any, and the citations."""
    parts = [F.lit(x) for x in instructions] + [F.lit(""), F.concat(F.lit("Question: "), F.coalesce(question, F.lit(""))), F.lit(""), F.array_join(blocks, "\n"), F.lit("")]
    if figures is not None:
        parts.append(F.when(F.size(figures) > 0, F.concat(F.lit("Related figure(s):\n"), F.array_join(figures, "\n"), F.lit("\n"))))
    return F.concat_ws("\n", *parts, F.lit("Citation(s):\n"), F.array_join(lines, "\n"))


def api_messages(api: Column, context: Column, has_images: Column) -> Column:
    """The system messages that came in, a guard, a second one with images, and the prompt as the user's."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    empty = F.array().cast("array<struct<role:string,content:string>>")
    came = F.coalesce(F.filter(api, lambda m: m["role"] == "system"), empty)
    return F.concat(came, F.array(message("system", F.lit(GUARD))), F.when(has_images, F.array(message("system", F.lit(FIGURE_GUARD)))).otherwise(empty), F.array(message("user", context)))


def envelope(requests: DataFrame, merged: DataFrame, images: DataFrame, prompts: DataFrame) -> DataFrame:
    """One reply per request, none lost: status 'ok', or why there is none. A request's ``metadata``, if it has such a
    column (MAP<STRING, STRING>), comes back with the reply."""
    if "metadata" not in requests.columns:
        requests = requests.withColumn("metadata", F.create_map().cast("map<string,string>"))
    docs = merged.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "text", "metadata"))).alias("m"))
    docs = docs.select("query", F.array(F.struct(F.transform("m", lambda x: x["text"]).alias("document"), F.transform("m", lambda x: x["metadata"]).alias("metadata"))).alias("value"), F.transform("m", lambda x: citation_struct(x["metadata"])).alias("citations"))
    figures = images.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "source", "page", "image_path", "abs_path", "file_url", "filename", "md_link"))).alias("images"))
    joined = requests.select("request_id", "message", "embeddings", "api", F.col("metadata").alias("request_metadata")).join(docs, requests["request_id"] == docs["query"], "left").drop("query").join(figures.withColumnRenamed("query", "request_id"), "request_id", "left").join(prompts.select(F.col("query").alias("request_id"), "prompt"), "request_id", "left")
    status = F.when(F.col("embeddings").isNull(), "no embeddings").when(F.col("value").isNull(), "no candidates").otherwise("ok")
    has = F.coalesce(F.size("images") > 0, F.lit(False))
    return joined.select("request_id", F.col("request_id").alias("requestId"), F.lit("vector_search_result").alias("type"), status.alias("status"), "value", "message", F.coalesce("request_metadata", F.create_map().cast("map<string,string>")).alias("metadata"), api_messages(F.col("api"), F.col("prompt"), has).alias("api"), "citations", "images")
