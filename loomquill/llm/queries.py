"""Queries of this subpackage, each over its whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomquill.llm import bpe, language, leak, markup, neardup, neighbours, ocr, repetition, split, survivor
from loomquill.llm.sql import SQL
from loomquill.session import table

Query = Callable[[SparkSession, str], DataFrame]


#: Candidates of a query whose neighbours may be no more alike than chance has it.
P5_WIDE = 200_000
TABLES = {0: "store_rows", 1: "embed_payloads"}


def _named(tbl: str = "tbl") -> F.Column:
    return F.when(F.col(tbl) == 0, TABLES[0]).otherwise(TABLES[1]).alias("tbl")


def _collection(spark: SparkSession, d: str, of_rows: str, of_payloads: str, value: str) -> DataFrame:
    """(tbl, key, value) of both collections; an element's key is payload_id * 1000 + position."""
    rows = table(spark, d, "store_rows").select(F.lit(0).alias("tbl"), F.col("row_id").alias("key"), F.col(of_rows).alias(value))
    elements = table(spark, d, "embed_payloads").select("payload_id", F.posexplode(of_payloads).alias("pos", value))
    return rows.unionByName(elements.select(F.lit(1).alias("tbl"), (F.col("payload_id") * 1000 + F.col("pos")).alias("key"), value))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = neardup.alike_pairs(_collection(spark, d, "document", "img_txt_docs", "text"), least=0.6, run=3)
    return pairs.select(_named(), F.col("a").alias("id_a"), F.col("b").alias("id_b"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """Near-duplicates at five words and 0.8: one row per text with its group and that group's size."""
    found = neardup.groups(_collection(spark, d, "document", "img_txt_docs", "text"))
    return found.select(_named(), "key", "group_id", "n_members").distinct()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    n = neighbours.nearest(_collection(spark, d, "embedding", "txt_embeddings", "vector"))
    return n.select(_named(), F.least("key", "other").alias("id_a"), F.greatest("key", "other").alias("id_b")).distinct()


def p5_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The stated query set, every key divisible by 100, with all of its k most similar vectors, whatever their cosines."""
    n = neighbours.nearest(_collection(spark, d, "embedding", "txt_embeddings", "vector"), least=-1.0, budget=P5_WIDE, asked=F.col("key") % 100 == 0)
    return n.select(_named(), "key", "rank", "other", F.round("cos", 3).alias("cos"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Both tables as (key, source, text); readings have negative keys."""
    a = table(spark, d, "text_docs").select(F.col("item_id").alias("key"), F.col("metadata.source").alias("source"), F.col("page_content").alias("text"))
    b = table(spark, d, "image_readings").select((-1 - F.col("reading_id")).alias("key"), F.lit(None).cast("string").alias("source"), F.col("ocr").alias("text"))
    return a.unionByName(b)


def _unkeyed(df: DataFrame, *columns: str) -> DataFrame:
    tbl = F.when(F.col("key") < 0, "image_readings").otherwise("text_docs").alias("tbl")
    return df.select(tbl, F.when(F.col("key") < 0, -1 - F.col("key")).otherwise(F.col("key")).alias("item_id"), *columns)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    found = ocr.mended(_pages(spark, d)).select("key", F.explode("defects").alias("x"))
    return _unkeyed(found, "x.defect", "x.piece").distinct()


def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    return _unkeyed(ocr.mended(_pages(spark, d)), "text").distinct()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.winners(table(spark, d, "img_docs"), table(spark, d, "extractors"))


def p3_survivors(spark: SparkSession, d: str) -> DataFrame:
    s = survivor.survivors(table(spark, d, "img_docs"), table(spark, d, "extractors"))
    return s.select("group_id", *[F.col(f"{a}.value").alias(a) for a in survivor.ATTRIBUTES])


def _long_texts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "text_docs").select(F.lit("text_docs").alias("tbl"), F.col("item_id"), F.col("page_content").alias("text"))
    b = table(spark, d, "store_rows").select(F.lit("store_rows").alias("tbl"), F.col("row_id").alias("item_id"), F.col("document").alias("text"))
    return a.unionByName(b).withColumn("key", F.struct("tbl", "item_id"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return split.size_cases(_long_texts(spark, d), "key", "text").select("key.tbl", "key.item_id", "size_case").distinct()


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split.split(_long_texts(spark, d), "key", "text").select("key.tbl", "key.item_id", "piece_no", "piece", "start", "fresh", "boundary")


def p4_joined(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of each text put together again without what they repeat, and the length of the longest."""
    new = F.transform("pieces", lambda p: F.right(p["piece"], p["fresh"]))
    longest = F.array_max(F.transform("pieces", lambda p: F.char_length(p["piece"])))
    rows = _long_texts(spark, d).select("key.tbl", "key.item_id", split.pieces(F.col("text")).alias("pieces")).where(F.size("pieces") > 0)
    return rows.select("tbl", "item_id", F.md5(F.array_join(new, "")).alias("digest"), (longest <= split.LIMIT).alias("fits")).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.structure(table(spark, d, "text_docs"), "item_id", "page_content")


def p6_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.cleaned(table(spark, d, "text_docs"), "item_id", "page_content").distinct()


def _readings(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "image_readings")
    pairs = F.array(*[F.struct(F.lit(a).alias("attr"), F.col(a).alias("text")) for a in ("caption", "chartqa")])
    return r.select(F.col("reading_id").alias("key"), F.explode(pairs).alias("x")).select("key", "x.attr", "x.text")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.repetitive(_readings(spark, d)).select(F.col("key").alias("reading_id"), "attr")


def p7_scores(spark: SparkSession, d: str) -> DataFrame:
    j = repetition.judged(_readings(spark, d))
    return j.select(F.col("key").alias("reading_id"), "attr", "n_words", F.round("run_share", 6).alias("repeated_share"), "votes", F.round("posterior", 6).alias("posterior")).distinct()


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """The measure alone: the share of each text's words that lie in repeated runs."""
    m = repetition.measured(_readings(spark, d))
    return m.select(F.col("key").alias("reading_id"), "attr", "n_words", F.round("run_share", 6).alias("repeated_share")).distinct()


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(table(spark, d, "documents"), "doc_id", "text")


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The texts again, decoded from their ids."""
    return bpe.decode(p8_ids(spark, d), "doc_id").withColumnRenamed("text", "decoded")


def _leak_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return docs, table(spark, d, "eval_items").select(F.col("item_id").alias("id"), "text")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leak.verbatim(*_leak_inputs(spark, d))


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leak.leaks(*_leak_inputs(spark, d))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return language.relabelled(_labelled(spark, d)).withColumnRenamed("id", "doc_id")


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments in one language each, with a confidence."""
    c = language.classified(_labelled(spark, d))
    return c.select(F.col("key").alias("doc_id"), F.posexplode("segments").alias("segment_no", "s")).select("doc_id", "segment_no", "s.start", "s.length", "s.lang", F.round("s.confidence", 4).alias("confidence"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (p1_found, p1_groups, p5_found, p5_nearest, p2_found, p2_repaired, p3_found, p3_survivors, p4_found, p4_pieces, p4_joined, p6_found, p6_clean, p7_found, p7_scores, p7_shares, p8_ids, p8_round_trip, p9_found, p9_leaks, p10_found, p10_segments)}


__all__ = ["QUERIES", "SQL"]
