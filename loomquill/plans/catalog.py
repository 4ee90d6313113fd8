"""Queries that show each operator on the test tables, always whole ones, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomquill.config import EngineConfig
from loomquill.functions import text as X
from loomquill.operators import assembly, chunking, dedupe, embedding, images, retrieval, store, tables
from loomquill.plans import pipeline
from loomquill.session import table
from loomquill.sources import extract, files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class _Metadata:
    """The metadata column; a column itself can't be made before there is a session."""

    def __getitem__(self, name: str):
        return F.col("metadata")[name]

    def isNotNull(self):
        return F.col("metadata").isNotNull()


M = _Metadata()


class _Fragment(str):
    """SQL with places {0} and {1}; other braces stay."""

    def format(self, *parts: str) -> str:
        out = str(self)
        for i, p in enumerate(parts):
            out = out.replace(f"{{{i}}}", p)
        return out


# SQL fragments
S = X.SPACE
STRIP = _Fragment(f"regexp_replace({{0}}, '^{S}+|{S}+$', '', 'g')")
COLLAPSE = _Fragment(f"trim(regexp_replace({{0}}, '{S}+', ' ', 'g'), ' ')")
WORDS = _Fragment(f"list_filter(regexp_split_to_array({{0}}, '{S}+'), lambda w: w <> '')")
BASENAME = _Fragment("regexp_extract({0}, '([^/]*)/*$', 1)")
NAME = _Fragment("coalesce(nullif(" + BASENAME.format("coalesce(nullif({0}.source, ''), {0}.image_path)") + ", ''), 'unknown')")


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# --- sources ---------------------------------------------------------------------------------------------------------


@query("""SELECT DISTINCT item_id, path, CASE WHEN regexp_matches(lower(path), '\\.(bmp|gif|ico|jpe|jpeg|jpg|pbm|pgm|png|ppm|svg|tif|tiff|webp|heic|avif)$') THEN 'image' WHEN lower(path) LIKE '%.pdf' THEN 'pdf' WHEN regexp_matches(lower(path), '\\.(txt|md)$') THEN 'text' END AS route
FROM (SELECT item_id, metadata.source AS path FROM text_docs UNION ALL SELECT reading_id, image_path FROM image_readings)""")
def route_files(spark, d):
    paths = table(spark, d, "text_docs").select("item_id", F.col("metadata.source").alias("path")).unionByName(table(spark, d, "image_readings").select(F.col("reading_id").alias("item_id"), F.col("image_path").alias("path")))
    return paths.select("item_id", "path", files.route(F.col("path")).alias("route")).distinct()


@query("""SELECT DISTINCT metadata.source AS source, page_content, CAST(length(page_content) AS BIGINT) AS n_chars, 'text' AS source_type FROM text_docs WHERE regexp_matches(lower(metadata.source), '\\.(txt|md)$') AND page_content IS NOT NULL""")
def scan_documents(spark, d):
    """The text files among the documents, as the folder scan gives them, made documents again."""
    docs = table(spark, d, "text_docs").where(M["source"].isNotNull() & F.col("page_content").isNotNull())
    scanned = docs.select(M["source"].alias("path"), F.encode("page_content", "UTF-8").alias("content")).withColumn("route", files.route(F.col("path")))
    read = files.text_documents(scanned)
    return read.select(M["source"].alias("source"), "page_content", F.char_length("page_content").cast("bigint").alias("n_chars"), M["source_type"].alias("source_type")).distinct()


@query("SELECT DISTINCT reading_id, sha1(coalesce(regexp_extract(source, '([^/]*)/*$', 1), '') || ':' || coalesce(CAST(page - 1 AS VARCHAR), '') || ':' || reading_id || ':' || coalesce(CAST(width AS VARCHAR), '')) || '.png' AS name FROM image_readings")
def image_name_sha1(spark, d):
    r = table(spark, d, "image_readings")
    return r.select("reading_id", extract.image_name(F.col("source"), F.col("page") - 1, F.col("reading_id"), F.col("width")).alias("name")).distinct()


# --- tables and images -----------------------------------------------------------------------------------------------


def _region_tables(spark, d) -> DataFrame:
    """The nations of each region as an extracted table with blanks, nulls, commas and the header once more."""
    n = F.col("n_nationkey")
    name = F.when(n % 4 == 0, F.lit(None)).when(n % 4 == 1, F.concat(F.lit("  "), "n_name", F.lit(" "))).otherwise(F.col("n_name"))
    note = F.when(n % 3 == 0, "").otherwise(F.concat("n_name", F.lit(", "), F.col("n_regionkey").cast("string")))
    cells = table(spark, d, "nation").select("n_regionkey", n, F.array(n.cast("string"), name, note).alias("cells"))
    rows = cells.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", "cells"))).alias("x"))
    head = F.array(F.lit(" key"), F.lit("name "), F.lit(None).cast("string"))
    again = F.array(F.array(F.lit(" key"), F.lit("name "), F.lit("")))
    return rows.select(F.col("n_regionkey").cast("bigint").alias("table_no"), head.alias("headers"), F.concat(again, F.transform("x", lambda r: r["cells"])).alias("rows"))


CELLS = """cells AS (SELECT CAST(n_regionkey AS BIGINT) AS table_no, n_nationkey AS n, CAST(n_nationkey AS VARCHAR) AS c1, CASE n_nationkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '  ' || n_name || ' ' ELSE n_name END AS c2, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE n_name || ', ' || n_regionkey END AS c3 FROM nation
UNION ALL SELECT DISTINCT CAST(n_regionkey AS BIGINT), -1, ' key', 'name ', '' FROM nation)"""


@query(f"""WITH {CELLS} SELECT table_no, '|  key | name  |  |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || c1 || ' | ' || coalesce(c2, '') || ' | ' || c3 || ' |' || chr(10), '' ORDER BY n) AS markdown FROM cells GROUP BY 1""")
def table_to_markdown(spark, d):
    return _region_tables(spark, d).select("table_no", tables.to_markdown(F.col("headers"), F.col("rows")).alias("markdown"))


@query(f"""WITH {CELLS} SELECT table_no, '{{"headers":[" key","name ",""],"rows":[' || string_agg('["' || c1 || '",' || coalesce('"' || c2 || '"', 'null') || ',"' || c3 || '"]', ',' ORDER BY n) || ']}}' AS json FROM cells GROUP BY 1""")
def table_to_json(spark, d):
    return _region_tables(spark, d).select("table_no", tables.to_json(F.col("headers"), F.col("rows")).alias("json"))


@query(f"""WITH {CELLS} SELECT table_no, 'Row -> key: ' || trim(c1) || ', name: ' || coalesce(trim(c2), '') || ', : ' || trim(c3) AS sentence FROM cells WHERE n >= 0""")
def table_row_sentences(spark, d):
    return _region_tables(spark, d).select("table_no", F.explode(tables.row_sentences(F.col("headers"), F.col("rows"))).alias("sentence"))


@query(f"""WITH {CELLS} SELECT table_no, 'Row -> key: ' || trim(p[1]) || ', name: ' || trim(p[2]) || ', : ' || trim(p[3]) AS sentence FROM (SELECT table_no, n, string_split(c1 || ',' || coalesce(c2, '') || ',' || c3, ',') AS p FROM cells) WHERE n >= 0""")
def table_csv_sentences(spark, d):
    t = _region_tables(spark, d)
    return t.select("table_no", F.explode(tables.csv_sentences(tables.to_csv(F.col("headers"), F.col("rows")), F.col("headers"))).alias("sentence"))


@query(f"""SELECT DISTINCT reading_id, coalesce(regexp_matches(ocr, '[A-Za-z0-9]') AND length({STRIP.format("ocr")}) >= 6, false)
OR coalesce(least(width, height) >= 48 AND CAST(width AS BIGINT) * height >= 16000 AND vision_label IN ('chart', 'diagram', 'table'), false) AS kept FROM image_readings""")
def image_keep_filter(spark, d):
    return table(spark, d, "image_readings").select("reading_id", images.keep(F.col("ocr"), F.col("width"), F.col("height"), F.col("vision_label")).alias("kept")).distinct()


@query("""SELECT DISTINCT reading_id, concat_ws(' ', caption, CASE WHEN ocr_conf IS NULL OR ocr_conf >= 0.3 THEN ocr END) AS text FROM image_readings""")
def ocr_conf_filter(spark, d):
    spans = F.array(F.struct(F.col("caption").alias("text"), F.lit(None).cast("double").alias("conf")), F.struct(F.col("ocr").alias("text"), F.col("ocr_conf").alias("conf")))
    return table(spark, d, "image_readings").select("reading_id", images.confident(spans).alias("text")).distinct()


@query("""SELECT DISTINCT reading_id, nullif(concat_ws(' • ', nullif(caption, ''), nullif(chartqa, ''), nullif(ocr, '')), '') AS text, coalesce(caption, '') <> '' AS caption, coalesce(chartqa, '') <> '' AS chartqa, coalesce(ocr, '') <> '' AS ocr
FROM image_readings WHERE concat_ws('', caption, chartqa, ocr) <> ''""")
def fuse_image_text(spark, d):
    r = table(spark, d, "image_readings")
    flags = [(F.coalesce(c, F.lit("")) != "").alias(c) for c in ("caption", "chartqa", "ocr")]
    return r.select("reading_id", images.fuse(F.col("caption"), F.col("chartqa"), F.col("ocr")).alias("text"), *flags).where(F.col("text").isNotNull()).distinct()


@query("""SELECT DISTINCT tbl, id, CASE WHEN coalesce(metadata.source_type = 'image_text', false) OR metadata.image_path IS NOT NULL THEN 'image_text' ELSE 'text' END AS modality
FROM (SELECT 'text_docs' AS tbl, item_id AS id, metadata FROM text_docs UNION ALL SELECT 'img_docs', rec_id, metadata FROM img_docs)""")
def split_modality(spark, d):
    a = table(spark, d, "text_docs").select(F.lit("text_docs").alias("tbl"), F.col("item_id").alias("id"), "metadata")
    both = a.unionByName(table(spark, d, "img_docs").select(F.lit("img_docs").alias("tbl"), F.col("rec_id").alias("id"), "metadata"))
    return both.select("tbl", "id", F.when(images.is_image_text(), "image_text").otherwise("text").alias("modality")).distinct()


@query("SELECT vec_id, CAST(list_position(s, list_max(s)) - 1 AS BIGINT) AS label_no FROM (SELECT vec_id, list_transform(range(1, 7), lambda i: round(CAST(embedding[i] AS DOUBLE) / sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))), 9)) AS s FROM embeddings)")
def zero_shot_argmax(spark, d):
    prompts = [[float(i == k) for i in range(64)] for k in range(len(images.LABELS))]
    return images.zero_shot(table(spark, d, "embeddings"), "vec_id", "embedding", prompts).select("vec_id", F.col("label_no").cast("bigint").alias("label_no"))


@query(f"""SELECT DISTINCT rec_id, concat_ws(' ', 'image', CASE WHEN metadata.vision_label <> '' THEN '(' || metadata.vision_label || ')' END, 'from', coalesce(nullif({BASENAME.format("coalesce(nullif(metadata.source, ''), metadata.image_path)")}, ''), 'image'), CASE WHEN metadata.page <> 0 THEN 'page ' || metadata.page END) AS stub FROM img_docs WHERE metadata.image_path IS NOT NULL""")
def image_stub_text(spark, d):
    r = table(spark, d, "img_docs").where(M["image_path"].isNotNull())
    return r.select("rec_id", images.stub(M["source"], M["page"], M["image_path"], M["vision_label"]).alias("stub")).distinct()


# --- distinct and bags -----------------------------------------------------------------------------------------------


@query(f"""SELECT min(item_id) AS item_id FROM text_docs WHERE length({STRIP.format("page_content")}) >= 12
GROUP BY coalesce(nullif(metadata.source, ''), nullif(metadata.image_path, ''), 'na'), metadata.page, lower({COLLAPSE.format("page_content")})""")
def dedupe_documents(spark, d):
    return dedupe.documents(table(spark, d, "text_docs"), F.col("item_id"), keep=["item_id"])


@query("""SELECT rec_id, path, source, page FROM (SELECT rec_id, metadata.image_path AS path, metadata.source AS source, metadata.page AS page, row_number() OVER (PARTITION BY metadata.image_path, metadata.source, metadata.page ORDER BY CASE WHEN metadata.source_type = 'image_text' THEN 0 ELSE 1 END, rec_id) AS n FROM img_docs) WHERE n = 1""")
def dedupe_image_rows(spark, d):
    r = table(spark, d, "img_docs").select("rec_id", "metadata", M["image_path"].alias("path"), M["source"].alias("source"), M["page"].alias("page"))
    return dedupe.image_rows(r, F.when(M["source_type"] == "image_text", 0).otherwise(1), F.col("rec_id"), ["rec_id", "path", "source", "page"])


def _stored(spark, d) -> DataFrame:
    """Store rows once per row_id: of rows repeated under one the earliest, then the one of smallest id and text."""
    rows = table(spark, d, "store_rows")
    return dedupe.first_rows(rows, {"_k": F.col("row_id")}, [F.col("ingested_at"), F.col("id"), F.col("document")], rows.columns)


@query("""SELECT row_id, source, page FROM (SELECT *, row_number() OVER (PARTITION BY base, source, page, h1, h2, h3 ORDER BY row_id) AS n FROM (SELECT DISTINCT row_id, base, metadata.source AS source, metadata.page AS page, metadata.h1 AS h1, metadata.h2 AS h2, metadata.h3 AS h3 FROM store_rows)) WHERE n <= 2""")
def section_cap(spark, d):
    hits = table(spark, d, "store_rows").select("row_id", "base", *[M[x].alias(x) for x in ("source", "page", "h1", "h2", "h3")]).distinct()
    return dedupe.cap_sections(hits, ["base", "source", "page", "h1", "h2", "h3"], "row_id").select("row_id", "source", "page")


@query("SELECT DISTINCT CASE kind WHEN 'text' THEN 0 ELSE 1 END AS part, row_id FROM store_rows WHERE kind IN ('text', 'images')")
def union_modalities(spark, d):
    r = table(spark, d, "store_rows").select("row_id", "kind").distinct()
    return dedupe.bag_union(r.where("kind = 'text'"), r.where("kind = 'images'"), "row_id").select("part", "row_id")


# --- store -----------------------------------------------------------------------------------------------------------


@query("""SELECT row_id, CASE kind WHEN 'text' THEN 't' ELSE 'i' END || (row_number() OVER (PARTITION BY base, kind ORDER BY row_id) - 1) AS id FROM (SELECT DISTINCT row_id, base, kind FROM store_rows)""")
def positional_ids(spark, d):
    rows = table(spark, d, "store_rows").select("row_id", "base", "kind").distinct()
    return store.positional_ids(rows, ["base", "kind"], "row_id", F.when(F.col("kind") == "text", "t").otherwise("i")).select("row_id", "id")


@query("""SELECT base, kind, id, min(row_id) AS row_id FROM store_rows r WHERE NOT EXISTS (SELECT 1 FROM store_rows t WHERE t.base = 'archive' AND t.base = r.base AND t.kind = r.kind AND t.id = r.id) GROUP BY base, kind, id""")
def insert_if_absent(spark, d):
    rows = table(spark, d, "store_rows").select("row_id", "base", "kind", "id")
    return store.absent(rows, rows.where("base = 'archive'"), ["base", "kind", "id"], [F.col("row_id")]).select("base", "kind", "id", "row_id")


# --- chunking --------------------------------------------------------------------------------------------------------


@query(f"""WITH w AS (SELECT doc_id, text, {WORDS.format("text")} AS ws FROM documents WHERE text IS NOT NULL), u AS (SELECT *, unnest(generate_series(0, greatest(len(ws) - 1, 0), 400)) AS i FROM w)
SELECT doc_id, CAST(i // 400 AS BIGINT) AS piece_no, CASE WHEN len(ws) <= 500 THEN text ELSE array_to_string(ws[i + 1:i + 500], ' ') END AS piece FROM u WHERE i = 0 OR i + 100 < len(ws)""")
def word_windows(spark, d):
    docs = table(spark, d, "documents").where(F.col("text").isNotNull())
    cut = docs.select("doc_id", F.posexplode(chunking.word_windows(F.col("text"))).alias("piece_no", "piece"))
    return cut.select("doc_id", F.col("piece_no").cast("bigint").alias("piece_no"), "piece")


TOKENS = _Fragment(f"regexp_extract_all({{0}}, '{X.TOKEN}')")


@query(f"SELECT doc_id, CAST(len({TOKENS.format('text')}) AS BIGINT) AS n_tokens FROM documents WHERE text IS NOT NULL")
def token_count(spark, d):
    return table(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", chunking.token_count(F.col("text")).cast("bigint").alias("n_tokens"))


@query(f"""WITH w AS (SELECT doc_id, {TOKENS.format('text')} AS ws FROM documents), u AS (SELECT *, unnest(generate_series(0, len(ws) - 1, 128)) AS i FROM w WHERE len(ws) > 0)
SELECT doc_id, CAST(i // 128 AS BIGINT) AS window_no, array_to_string(ws[i + 1:i + 128], ' ') AS piece FROM u""")
def token_windows(spark, d):
    cut = table(spark, d, "documents").select("doc_id", F.posexplode(chunking.token_windows(F.col("text"), 128)).alias("n", "piece"))
    return cut.select("doc_id", F.col("n").cast("bigint").alias("window_no"), "piece")


@query(f"""WITH w AS (SELECT doc_id, {TOKENS.format('text')} AS ws FROM documents), u AS (SELECT *, unnest(generate_series(0, len(ws) - 1, 80)) AS i FROM w WHERE len(ws) > 0)
SELECT doc_id, CAST(i // 80 AS BIGINT) AS window_no, '§ manual' || chr(10) || chr(10) || array_to_string(ws[i + 1:i + 98], ' ') AS piece FROM u WHERE i = 0 OR i + 18 < len(ws)""")
def token_windows_prefix(spark, d):
    cut = table(spark, d, "documents").select("doc_id", F.posexplode(chunking.token_windows_with_prefix("§ manual", F.col("text"), 100, 18)).alias("n", "piece"))
    return cut.select("doc_id", F.col("n").cast("bigint").alias("window_no"), "piece")


@query(f"""SELECT p_partkey, substr('§' || array_to_string(list_filter([{STRIP.format("p_brand")}, {STRIP.format("p_type")}, {STRIP.format("p_name")}], lambda h: h IS NOT NULL AND h <> '')[1:2], '/'), 1, 50) AS tag FROM part""")
def heading_tag(spark, d):
    return table(spark, d, "part").select("p_partkey", X.heading_tag(F.col("p_brand"), F.col("p_type"), F.col("p_name")).alias("tag"))


@query(rf"""WITH l AS (SELECT item_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS n, len(ls) AS total FROM (SELECT DISTINCT item_id, regexp_split_to_array(page_content, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]') AS ls FROM text_docs WHERE page_content IS NOT NULL)),
f AS (SELECT item_id, line, n, starts_with(s, '|') OR starts_with(s, '```') AS flag FROM (SELECT *, {STRIP.format("line")} AS s FROM l WHERE NOT (n = total AND line = ''))),
g AS (SELECT *, CASE WHEN flag THEN sum(CASE WHEN flag THEN 0 ELSE 1 END) OVER (PARTITION BY item_id ORDER BY n) ELSE -n END AS grp FROM f),
j AS (SELECT item_id, grp, min(n) AS n, string_agg(line, ' ' ORDER BY n) AS line FROM g GROUP BY item_id, grp)
SELECT t.item_id, coalesce(md5(string_agg(j.line, chr(10) ORDER BY j.n)), md5('')) AS digest FROM (SELECT DISTINCT item_id FROM text_docs WHERE page_content IS NOT NULL) t LEFT JOIN j USING (item_id) GROUP BY t.item_id""")
def protect_tables(spark, d):
    docs = table(spark, d, "text_docs").where(F.col("page_content").isNotNull())
    return docs.select("item_id", F.md5(chunking.protected(F.col("page_content"))).alias("digest")).distinct()


# a line at a time: the fence that is open, the headings so far, and the section that the line belongs to
@query(rf"""WITH RECURSIVE l AS (SELECT item_id, ls, len(ls) AS total FROM (SELECT DISTINCT item_id, string_split(page_content, chr(10)) AS ls FROM text_docs WHERE page_content IS NOT NULL)),
st(item_id, ls, total, n, fence, h1, h2, h3, sec, line) AS (SELECT item_id, ls, total, 0, '', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR, 0, NULL::VARCHAR FROM l UNION ALL
 SELECT item_id, ls, total, n + 1, CASE WHEN turns THEN CASE WHEN fence = '' THEN mark ELSE '' END ELSE fence END,
 CASE WHEN lvl = 1 THEN title ELSE h1 END, CASE WHEN lvl = 1 THEN NULL WHEN lvl = 2 THEN title ELSE h2 END, CASE WHEN lvl IN (1, 2) THEN NULL WHEN lvl = 3 THEN title ELSE h3 END,
 sec + CASE WHEN lvl > 0 THEN 1 ELSE 0 END, CASE WHEN lvl > 0 THEN NULL ELSE raw END FROM (
  SELECT *, CASE WHEN fence = '' AND mark = '' AND NOT turns THEN length(regexp_extract(s, '^(#{{1,3}}){S}', 1)) ELSE 0 END AS lvl, {STRIP.format("regexp_extract(s, '^#{1,3}" + S + "+(.*)$', 1)")} AS title FROM (
   SELECT *, mark <> '' AND (fence = '' OR mark = fence) AS turns FROM (SELECT *, CASE WHEN s[1:3] IN ('```', '~~~') THEN s[1:3] ELSE '' END AS mark FROM (SELECT *, ls[n + 1] AS raw, {STRIP.format("ls[n + 1]")} AS s FROM st WHERE n < total))))),
b AS (SELECT item_id, sec, any_value(h1) AS h1, any_value(h2) AS h2, any_value(h3) AS h3, {STRIP.format("string_agg(line, chr(10) ORDER BY n)")} AS body FROM st WHERE line IS NOT NULL GROUP BY item_id, ls, sec)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY sec) - 1 AS INTEGER) AS section_no, h1, h2, h3, body FROM b WHERE body <> ''""")
def markdown_sections(spark, d):
    docs = table(spark, d, "text_docs")
    return docs.select("item_id", F.posexplode(chunking.sections(F.col("page_content"))).alias("section_no", "s")).select("item_id", "section_no", "s.*").distinct()


def _chunked(strategy: str) -> Query:
    def run(spark, d):
        docs = dedupe.first_rows(table(spark, d, "text_docs"), {"_k": F.col("item_id")}, [F.col("ingested_at"), F.col("page_content")], ["item_id", "page_content"])
        return chunking.chunks(docs, "item_id", "page_content", EngineConfig(chunk_strategy=strategy))

    return run


for _strategy in ("simple", "recursive", "semantic"):
    QUERIES[f"chunk_{_strategy}"] = _chunked(_strategy)


@query()
def pack_sentences(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", F.posexplode(chunking.packed(128)(F.col("text"))).alias("chunk_no", "chunk"))


@query(f"""WITH t AS (SELECT doc_id, text, {TOKENS.format("text")} AS ws, regexp_split_to_array(text, '{X.TOKEN}') AS gaps FROM documents),
s AS (SELECT *, list_sum(list_transform(gaps[1:257], lambda g: length(g))) + list_sum(list_transform(ws[1:256], lambda w: length(w))) AS room FROM t)
SELECT doc_id, CASE WHEN len(ws) <= 256 THEN text ELSE substr(text, 1, CAST(length(text) - 50 * ceil((length(text) - room) / 50.0) AS BIGINT)) END AS text FROM s""")
def token_trim(spark, d):
    return table(spark, d, "documents").select("doc_id", chunking.trimmed(256)(F.col("text")).alias("text"))


# --- vectors ---------------------------------------------------------------------------------------------------------


def _vectors(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))


def _query_vectors(spark, d) -> DataFrame:
    """The stated query set of searches: every hundredth vector."""
    return _vectors(spark, d).where(F.col("key") % 100 == 0)


DISTANCE = "round(pow(list_distance(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 2), 9)"
TOP_L2 = f"SELECT query, key, rank, measure FROM (SELECT q.vec_id AS query, e.vec_id AS key, {DISTANCE} AS measure, row_number() OVER (PARTITION BY q.vec_id ORDER BY {DISTANCE}, e.vec_id) AS rank FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0) WHERE rank <= 80"


@query(f"SELECT query, key, CAST(rank AS BIGINT) AS rank, measure AS distance FROM ({TOP_L2})")
def vector_topk_l2(spark, d):
    n = retrieval.nearest(_vectors(spark, d), _query_vectors(spark, d), EngineConfig().candidates())
    return n.select("query", "key", F.col("rank").cast("bigint").alias("rank"), F.col("measure").alias("distance"))


COSINE = "round(1 - list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 9)"


@query(f"SELECT query, key, CAST(rank AS BIGINT) AS rank, 1 - m AS cosine FROM (SELECT q.vec_id AS query, e.vec_id AS key, {COSINE} AS m, row_number() OVER (PARTITION BY q.vec_id ORDER BY {COSINE}, e.vec_id) AS rank FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0) WHERE rank <= 10")
def cosine_topk(spark, d):
    n = retrieval.nearest(_vectors(spark, d), _query_vectors(spark, d), 10, cosine=True)
    return n.select("query", "key", F.col("rank").cast("bigint").alias("rank"), F.col("measure").alias("cosine"))


@query("SELECT vec_id, CAST(i - 1 AS BIGINT) AS i, round(n, 6) AS norm, round(embedding[i] / (n + 1e-12), 6) AS component FROM (SELECT vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x))) AS n, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)")
def l2_normalize(spark, d):
    v = F.col("embedding")
    out = table(spark, d, "embeddings").select("vec_id", F.round(retrieval.l2_norm(v), 6).alias("norm"), F.posexplode(retrieval.normalise(v)).alias("i", "c"))
    return out.select("vec_id", F.col("i").cast("bigint").alias("i"), "norm", F.round("c", 6).alias("component"))


@query(f"""WITH RECURSIVE cand AS (SELECT t.query, t.key, t.rank, CAST(e.embedding AS DOUBLE[]) AS v, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 9) AS rel FROM ({TOP_L2}) t JOIN embeddings e ON e.vec_id = t.key JOIN embeddings q ON q.vec_id = t.query),
sim AS (SELECT a.query, a.key AS a, b.key AS b, round(list_cosine_similarity(a.v, b.v), 9) AS s FROM cand a JOIN cand b ON a.query = b.query),
picks(query, pick, picked) AS (
 SELECT query, 1, list(key ORDER BY rel DESC, rank)[1:1] FROM cand GROUP BY query
 UNION ALL
 SELECT query, any_value(pick) + 1, list_append(any_value(picked), list(key ORDER BY score DESC, rank)[1]) FROM (
  SELECT p.query, p.pick, p.picked, c.key, c.rank, round(0.4 * c.rel - 0.6 * max(s.s), 9) AS score FROM picks p JOIN cand c ON c.query = p.query AND NOT list_contains(p.picked, c.key) JOIN sim s ON s.query = p.query AND s.a = c.key AND list_contains(p.picked, s.b) WHERE p.pick < 20 GROUP BY p.query, p.pick, p.picked, c.key, c.rank, c.rel) GROUP BY query)
SELECT query, picked[pick] AS key, CAST(pick AS BIGINT) AS pick FROM picks""")
def mmr_select(spark, d):
    v, q = _vectors(spark, d), _query_vectors(spark, d)
    hits = retrieval.nearest(v, q, EngineConfig().candidates()).join(v, "key").join(q.select(F.col("key").alias("query"), F.col("vector").alias("query_vector")), "query")
    return retrieval.mmr_select(hits)


# --- words -----------------------------------------------------------------------------------------------------------


def _corpus(spark, d) -> DataFrame:
    return table(spark, d, "documents").where(F.col("text").isNotNull()).select(F.col("doc_id").alias("key"), "text")


def _questions(spark, d) -> DataFrame:
    return table(spark, d, "eval_items").select(F.col("item_id").alias("query"), "text")


def _bm25(spark, d) -> DataFrame:
    return retrieval.bm25(_corpus(spark, d), _questions(spark, d), EngineConfig().top_k_bm25)


STATS = f"""toks AS (SELECT doc_id, {WORDS.format("lower(text)")} AS ws FROM documents WHERE text IS NOT NULL), post AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, unnest(ws) AS term, len(ws) AS n FROM toks) GROUP BY doc_id, term),
tot AS (SELECT count(*) AS n, sum(len(ws)) / count(*) AS mean FROM toks), raw AS (SELECT term, count(*) AS df, ln((SELECT n FROM tot) - count(*) + 0.5) - ln(count(*) + 0.5) AS r FROM post GROUP BY term),
idf AS (SELECT term, df, CASE WHEN r < 0 THEN 0.25 * (SELECT avg(r) FROM raw) ELSE r END AS idf FROM raw)"""
TOP_BM25 = f"""{STATS}, ask AS (SELECT item_id AS query, term, count(*) AS times FROM (SELECT item_id, unnest({WORDS.format("lower(text)")}) AS term FROM eval_items) GROUP BY 1, 2),
scored AS (SELECT a.query, p.doc_id AS key, round(sum(a.times * i.idf * p.tf * 2.5 / (p.tf + 1.5 * (0.25 + 0.75 * p.n / (SELECT mean FROM tot)))), 9) AS score FROM ask a JOIN idf i USING (term) JOIN post p USING (term) GROUP BY 1, 2),
ranked AS (SELECT query, key, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS rank FROM (SELECT * FROM scored UNION ALL SELECT e.item_id, t.doc_id, 0.0 FROM eval_items e, toks t WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s.query = e.item_id AND s.key = t.doc_id))), top AS (SELECT * FROM ranked WHERE rank <= 10)"""


@query(f"WITH {STATS} SELECT term, df, round(idf, 6) AS idf FROM idf")
def bm25_stats(spark, d):
    docs = _corpus(spark, d)
    return retrieval.term_weights(retrieval.postings(docs), docs.count()).select("term", "df", F.round("idf", 6).alias("idf"))


@query(f"WITH {TOP_BM25} SELECT query, key, CAST(rank AS BIGINT) AS rank, score FROM top")
def bm25_topk(spark, d):
    return _bm25(spark, d).select("query", "key", F.col("rank").cast("bigint").alias("rank"), "score")


def _hits(spark, d) -> DataFrame:
    """BM25 hits with the question, the document, its place, and a source for the gate."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("key"), F.col("text").alias("document"), "source", "page", "source_type")
    found = _bm25(spark, d).join(docs, "key").join(_questions(spark, d).withColumnRenamed("text", "question"), "query")
    return found.withColumn("order", F.col("rank").cast("bigint")).drop("rank")


OVERLAP = f"""round(CASE WHEN len(list_distinct(qw)) > 0 THEN len(list_intersect(qw, dw)) / len(list_distinct(qw)) ELSE 0 END, 9)"""
HITS = f"""{TOP_BM25}, hits AS (SELECT query, key, ord, question, document, source, page, source_type, {OVERLAP} AS overlap FROM (SELECT t.query, t.key, CAST(t.rank AS BIGINT) AS ord, e.text AS question, d.text AS document, d.source, d.page, d.source_type, {WORDS.format("lower(e.text)")} AS qw, {WORDS.format("lower(d.text)")} AS dw FROM top t JOIN documents d ON d.doc_id = t.key JOIN eval_items e ON e.item_id = t.query))"""


@query(f"WITH {HITS} SELECT query, key, rank, score FROM (SELECT query, key, overlap AS score, row_number() OVER (PARTITION BY query ORDER BY overlap DESC, ord) AS rank FROM hits) WHERE rank <= 3")
def rerank_lexical(spark, d):
    r = retrieval.rerank(_hits(spark, d), 3)
    return r.select("query", "key", F.col("rank").cast("bigint").alias("rank"), "score")


@query(f"""WITH {HITS}, m AS (SELECT *, max(overlap) OVER (PARTITION BY query) < 0.5 AS weak FROM hits), k AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN weak THEN 0 ELSE -overlap END, ord) AS rank FROM m WHERE NOT weak OR ord <= 5) SELECT query, key, rank FROM k WHERE rank <= 3""")
def low_confidence_gate(spark, d):
    h = _hits(spark, d).withColumn("source", F.when(F.col("order") <= 5, "bm25").otherwise("mmr"))
    h = h.withColumn("score", F.round(retrieval.overlap_score(F.col("question"), F.col("document")), 9))
    return retrieval.gate(h, 3, least=0.5).select("query", "key", F.col("rank").cast("bigint").alias("rank"))


@query(f"""WITH {HITS} SELECT CAST(0 AS INTEGER) AS part, query, key FROM hits UNION ALL SELECT 1, query, key FROM (SELECT query, key, row_number() OVER (PARTITION BY query ORDER BY overlap DESC, ord) AS rank FROM hits) WHERE rank <= 3""")
def hybrid_merge(spark, d):
    h = _hits(spark, d)
    first = h.select("query", "key", F.col("order").alias("rank"))
    second = retrieval.rerank(h, 3).select("query", "key", F.col("rank").cast("bigint").alias("rank"))
    return dedupe.bag_union(first, second).select("part", "query", "key")


PROCEDURAL = _Fragment(r"regexp_matches(coalesce({0}, ''), '" + X.PROCEDURAL + "')")


@query(f"SELECT doc_id, {PROCEDURAL.format('text')} AS procedural, CAST(CASE WHEN {PROCEDURAL.format('text')} THEN 6 ELSE 3 END AS BIGINT) AS final, CAST(CASE WHEN {PROCEDURAL.format('text')} THEN 24 ELSE 20 END AS BIGINT) AS picks FROM documents")
def procedural_intent(spark, d):
    p = X.is_procedural(F.col("text"))
    final, picks = retrieval.budget(p)
    return table(spark, d, "documents").select("doc_id", p.alias("procedural"), final.cast("bigint").alias("final"), picks.cast("bigint").alias("picks"))


@query(f"""WITH {HITS}, f AS (SELECT *, first_value(source) OVER w AS s1, first_value(page) OVER w AS p1 FROM hits WINDOW w AS (PARTITION BY query ORDER BY ord))
SELECT query, key, rank FROM (SELECT query, key, row_number() OVER (PARTITION BY query ORDER BY CASE WHEN source IS NOT DISTINCT FROM s1 AND page IS NOT DISTINCT FROM p1 THEN 0 ELSE 1 END, ord) AS rank FROM f) WHERE rank <= 6""")
def procedural_regroup(spark, d):
    h = _hits(spark, d).withColumn("rank", F.col("order"))
    return retrieval.regroup(h, F.struct("source", "page"), 6, F.lit(True)).select("query", "key", F.col("rank").cast("bigint").alias("rank"))


# --- context ---------------------------------------------------------------------------------------------------------


HYPHENATED = r"regexp_extract(t, '^(.{0,591}[\p{L}_]{2}-)[\p{L}_]-?[\p{L}_]', 1)"


@query(f"""WITH c AS (SELECT doc_id, {COLLAPSE.format("text")} AS t FROM documents), k AS (SELECT doc_id, t, regexp_extract(t, '^(.{{1,594}}) ', 1) AS a, {HYPHENATED} AS b FROM c)
SELECT doc_id, CASE WHEN length(t) <= 600 THEN t WHEN greatest(length(a), length(b)) = 0 THEN '[...]' ELSE CASE WHEN length(a) >= length(b) THEN a ELSE b END || ' [...]' END AS text FROM k""")
def shorten_text(spark, d):
    return table(spark, d, "documents").select("doc_id", X.shorten(F.col("text"), 600).alias("text"))


def _meta(d: DataFrame) -> DataFrame:
    """Hits with document metadata as a struct."""
    none = {"image_path": "string", "vision_label": "string", "h1": "string", "h2": "string", "h3": "string", **{f: "boolean" for f in assembly.FLAGS}}
    return d.withColumn("metadata", F.struct("source", "page", "source_type", *[F.lit(None).cast(t).alias(n) for n, t in none.items()])).withColumn("rank", F.col("order"))


@query(f"""WITH {HITS}, g AS (SELECT query, source, page, min(ord) AS rank, {STRIP.format("string_agg(document, ' ' ORDER BY ord)")} AS t FROM hits GROUP BY query, source, page)
SELECT query, source, page, rank, CASE WHEN length(t) <= 1600 THEN t ELSE regexp_replace(substr(t, 1, 1600), ' [^ ]*$', '') END AS text FROM g""")
def merge_by_page(spark, d):
    return assembly.merge_by_page(_meta(_hits(spark, d)).drop("source", "page")).drop("metadata")


@query(f"""WITH {HITS}, asked AS (SELECT query, source, page, min(ord) AS rank FROM hits WHERE source IS NOT NULL AND page IS NOT NULL GROUP BY 1, 2, 3),
img AS (SELECT source, page, image_path, row_number() OVER (PARTITION BY source, page ORDER BY reading_id) AS n FROM (SELECT DISTINCT reading_id, source, page, image_path FROM image_readings) WHERE image_path <> '' AND page IS NOT NULL),
j AS (SELECT a.query, a.source, a.page, i.image_path, i.n, row_number() OVER (PARTITION BY a.query ORDER BY a.rank, i.n) AS k FROM asked a JOIN img i ON a.source = i.source AND a.page = i.page WHERE i.n <= 3)
SELECT query, source, page, image_path, k AS n FROM (SELECT *, row_number() OVER (PARTITION BY query, image_path ORDER BY k) AS once FROM j WHERE k - n < 8) WHERE once = 1""")
def page_images(spark, d):
    pages = _hits(spark, d).select("query", "source", "page", F.col("order").alias("rank"))
    pictures = table(spark, d, "image_readings").select("reading_id", "source", "page", "image_path").distinct()
    return assembly.page_images(pages, pictures, "reading_id").select("query", "source", "page", "image_path", F.col("n").cast("bigint").alias("n"))


@query(f"""SELECT DISTINCT reading_id, image_path AS abs_path, u AS file_url, {BASENAME.format("image_path")} AS filename, '[' || {BASENAME.format("image_path")} || '](' || u || ')' AS md_link FROM (SELECT reading_id, image_path, 'file://' || replace(url_encode(image_path), '%2F', '/') AS u FROM image_readings)""")
def image_links(spark, d):
    return assembly.links(table(spark, d, "image_readings").select("reading_id", "image_path").distinct()).select("reading_id", "abs_path", "file_url", "filename", "md_link")


LABEL = _Fragment(f"""'Source ' || {{1}} || ': ' || CASE WHEN {{0}}.image_path <> '' AND (coalesce({{0}}.caption, false) OR coalesce({{0}}.ocr, false) OR coalesce({{0}}.chartqa, false)) THEN {BASENAME.format("{0}.image_path")} || ' (from image)' ELSE {NAME} END
|| coalesce(' (' || nullif(concat_ws('/', {", ".join(f"CASE WHEN {{0}}.{f} THEN '{f}' END" for f in assembly.FLAGS)}), '') || ')', '') || coalesce(' (page ' || {{0}}.page || ')', '')""")


@query(f"SELECT DISTINCT row_id, {LABEL.format('metadata', 'row_id')} AS label FROM (SELECT row_id, metadata FROM store_rows WHERE metadata IS NOT NULL)")
def source_label(spark, d):
    return table(spark, d, "store_rows").where(M.isNotNull()).select("row_id", assembly.label(M, F.col("row_id")).alias("label")).distinct()


CITE = f"""coalesce(nullif({BASENAME.format("source")}, ''), 'unknown') || coalesce(', page ' || page, '')"""


@query(f"""WITH {HITS} SELECT query, row_number() OVER (PARTITION BY query ORDER BY r) AS n, line FROM (SELECT query, {CITE} AS line, min(ord) AS r FROM hits GROUP BY 1, 2)""")
def unique_citations(spark, d):
    return assembly.citations(_meta(_hits(spark, d))).select("query", F.col("n").cast("bigint").alias("n"), "line")


def _prompts(hits: DataFrame) -> DataFrame:
    blocks = hits.groupBy("query", "question").agg(F.array_sort(F.collect_list(F.struct("rank", assembly.label(M, F.col("rank")).alias("block")))).alias("b"))
    lines = assembly.citations(hits).groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("c"))
    return blocks.join(lines, "query").select("query", assembly.prompt(F.col("question"), F.transform("b", lambda x: x["block"]), F.transform("c", lambda x: x["line"])).alias("prompt"))


_INTRO = "\n".join(assembly.INSTRUCTIONS).replace("'", "''")


@query(f"""WITH {HITS}, b AS (SELECT query, any_value(question) AS question, string_agg('Source ' || ord || ': ' || coalesce(nullif({BASENAME.format("source")}, ''), 'unknown') || coalesce(' (page ' || page || ')', ''), chr(10) ORDER BY ord) AS blocks FROM hits GROUP BY query),
c AS (SELECT query, string_agg(line, chr(10) ORDER BY r) AS lines FROM (SELECT query, {CITE} AS line, min(ord) AS r FROM hits GROUP BY 1, 2) GROUP BY query)
SELECT query, '{_INTRO}' || chr(10) || chr(10) || 'Question: ' || question || chr(10) || chr(10) || blocks || chr(10) || chr(10) || 'Citation(s):' || chr(10) || chr(10) || lines AS prompt FROM b JOIN c USING (query)""")
def prompt_context(spark, d):
    return _prompts(_meta(_hits(spark, d)))


def _conversations(spark, d) -> DataFrame:
    """Payload texts as messages: a system one, then the user's and the assistant's in turn. Repeated payloads are equal."""
    role = lambda i: F.when(i == 0, "system").when(i % 2 == 1, "user").otherwise("assistant")
    return table(spark, d, "embed_payloads").select("payload_id", "txt_docs").distinct().select("payload_id", F.transform("txt_docs", lambda x, i: F.struct(role(i).alias("role"), x.alias("content"))).alias("api"))


@query(f"""SELECT payload_id, nullif({STRIP.format("m")}, '') AS message FROM (SELECT DISTINCT payload_id, txt_docs[CASE WHEN len(txt_docs) % 2 = 0 THEN len(txt_docs) ELSE len(txt_docs) - 1 END] AS m FROM embed_payloads)""")
def last_user_message(spark, d):
    none = F.lit(None).cast("string")
    return _conversations(spark, d).select("payload_id", embedding.question(F.col("api"), none, none).alias("message"))


_GUARDS = [x.replace("'", "''") for x in (assembly.GUARD, assembly.FIGURE_GUARD)]


@query(f"""SELECT payload_id, concat_ws(chr(10), CASE WHEN len(txt_docs) > 0 THEN 'system: ' || coalesce(txt_docs[1], '') END, 'system: {_GUARDS[0]}', CASE WHEN payload_id % 2 = 0 THEN 'system: {_GUARDS[1]}' END, 'user: prompt') AS messages FROM (SELECT DISTINCT payload_id, txt_docs FROM embed_payloads)""")
def api_messages(spark, d):
    out = assembly.api_messages(F.col("api"), F.lit("prompt"), F.col("payload_id") % 2 == 0)
    line = lambda m: F.concat(m["role"], F.lit(": "), F.coalesce(m["content"], F.lit("")))
    return _conversations(spark, d).select("payload_id", F.array_join(F.transform(out, line), "\n").alias("messages"))


@query("""SELECT DISTINCT row_id, CAST(CASE WHEN regexp_full_match(x, '[0-9]+') THEN x ELSE '0' END AS BIGINT) AS request_id FROM (SELECT row_id, coalesce(nullif(nullif(regexp_replace(id, '^t', ''), ''), '0'), CAST(row_id AS VARCHAR)) AS x FROM store_rows)""")
def request_id(spark, d):
    return table(spark, d, "store_rows").select("row_id", embedding.request_id(F.regexp_replace("id", "^t", ""), F.col("row_id")).alias("request_id")).distinct()


# --- whole plans -----------------------------------------------------------------------------------------------------


@query()
def embed_text(spark, d):
    docs = table(spark, d, "documents")
    return docs.select("doc_id", embedding.encoder()(F.col("text")).alias("embedding"))


@query()
def ingest_end_to_end(spark, d):
    docs = table(spark, d, "text_docs").select(F.col("item_id").alias("ord"), "page_content", "metadata")
    readings = table(spark, d, "image_readings")
    pictures = dedupe.first_rows(readings, {"_k": F.col("reading_id")}, [F.col("read_at"), F.col("image_path"), F.col("ocr")], readings.columns)
    meta = F.col("m").withField("source", F.col("source")).withField("page", F.col("page")).withField("image_path", F.col("image_path")).withField("source_type", F.lit("image_text")).withField("vision_label", F.col("vision_label"))
    empty = F.from_json(F.lit("{}"), docs.schema["metadata"].dataType.simpleString()).alias("m")
    fused = pictures.select((F.col("reading_id") + 1_000_000_000).alias("ord"), images.fuse(F.col("caption"), F.col("chartqa"), F.col("ocr")).alias("page_content"), "source", "page", "image_path", "vision_label", empty)
    return pipeline.ingest(docs.unionByName(fused.select("ord", "page_content", meta.alias("metadata"))), "ord")


@query()
def retrieve_end_to_end(spark, d):
    asked = table(spark, d, "eval_items").select(F.col("item_id").alias("request_id"), F.col("text").alias("message"), embedding.encoder()(F.col("text")).alias("embeddings"), F.array(F.struct(F.lit("system").alias("role"), F.col("suite").alias("content"))).alias("api"))
    rows = _stored(spark, d).select(F.col("row_id").alias("key"), "document", "metadata", "embedding", "kind")
    pictures = table(spark, d, "image_readings").select(F.col("reading_id").alias("key"), "source", "page", "image_path").distinct()
    replies = pipeline.retrieve(asked, rows, pictures)
    return replies.select("request_id", "status", "message", F.element_at("api", -1)["content"].alias("prompt"), F.size(F.element_at("value", 1)["document"]).alias("n_documents"), F.coalesce(F.size("images"), F.lit(0)).alias("n_images"))


