"""The two plans of the engine: ingest documents into the store, and answer a batch of questions from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomquill.config import EngineConfig
from loomquill.functions.text import is_procedural
from loomquill.operators import assembly, chunking, dedupe, embedding, images, retrieval, store
from loomquill.session import cut


def ingest(docs: DataFrame, order: str, config: EngineConfig | None = None, provider=None) -> DataFrame:
    """Store rows (id, document, metadata, embedding, base, kind) from documents (``order``, page_content, metadata).

    Texts and image texts are deduplicated apart and split alike; ids depend on the content, so that nothing is added
    twice. The shuffles are the two of the deduplication.
    """
    config = config or EngineConfig()
    from_image = images.is_image_text()
    out = {}
    for name, part in (("txt", docs.where(~from_image)), ("img_txt", docs.where(from_image))):
        first = dedupe.documents(part.where(F.col("page_content").isNotNull()), F.col(order), keep=[order, "page_content", "metadata"])
        keyed = first.withColumn("_key", F.struct(order, "metadata", F.md5("page_content").alias("digest")))
        pieces = chunking.chunks(keyed, "_key", "page_content", config)
        meta = F.col("_key.metadata")
        if config.propagate_headings:
            meta = meta.withField("h1", F.col("h1")).withField("h2", F.col("h2")).withField("h3", F.col("h3"))
        meta = meta.withField("split_method", F.coalesce(meta["split_method"], F.col("split_method")))
        out[name] = pieces.select(F.struct(F.col(f"_key.{order}").alias("doc"), "section_ord", "piece_ord", "_key.digest").alias("ord"), F.col("chunk").alias("page_content"), meta.alias("metadata"))
    stubs = docs.where(from_image).select(F.struct(F.col(order).alias("doc"), F.lit(0).alias("section_ord"), F.lit(0).alias("piece_ord"), F.md5("page_content").alias("digest")).alias("ord"), "page_content", "metadata")
    embedded = embedding.assembled(out["txt"], out["img_txt"], stubs, provider or config.text_model)
    rows = store.store_rows(embedded, config.base)
    key = store.content_id(F.col("base"), F.col("kind"), F.col("metadata.source"), F.col("metadata.page"), F.to_json(F.struct("ord.digest", "ord.section_ord", "ord.piece_ord")), F.col("document"))
    return rows.withColumn("id", key).select("id", "document", "metadata", "embedding", "base", "kind")


def answer(requests: DataFrame, stored: DataFrame, image_rows: DataFrame, config: EngineConfig | None = None, provider=None, **more) -> DataFrame:
    """Replies to requests as they come in (``schema.REQUEST_DDL``): those with a question are embedded and answered."""
    config = config or EngineConfig()
    asked = cut(embedding.encoded_requests(requests, provider or config.text_model))
    return retrieve(asked, stored, image_rows, config, **more)


def retrieve(requests: DataFrame, stored: DataFrame, image_rows: DataFrame, config: EngineConfig | None = None, scorer=retrieval.overlap_score, index: DataFrame | None = None) -> DataFrame:
    """One reply per request (request_id, message, embeddings, api) from store rows (key, document, metadata, embedding, kind).

    ``key`` is unique and orders the store; ``image_rows`` are (key, source, page, image_path). ``scorer`` is a column
    function of a question and a document; ``index`` are kept postings of the store's texts (``retrieval.kept_postings``).
    """
    config = config or EngineConfig()
    asked = requests.select(F.col("request_id").alias("query"), F.col("message").alias("question"), F.col("embeddings").alias("vector"))
    procedural = is_procedural(F.col("question"))
    final, picks = retrieval.budget(procedural, config.top_k, config.top_k_mmr)
    vectors = stored.where(F.col("kind").isin("text", "images")).select("key", F.col("embedding").alias("vector"), "kind")
    near = retrieval.nearest(vectors, asked.select(F.col("query").alias("key"), "vector"), config.candidates(), part="kind")
    near = near.withColumn("rank", F.col("rank") + F.when(F.col("part") == "images", 1_000_000).otherwise(0)).drop("part")
    candidates = near.join(vectors, "key").join(asked.select("query", F.col("vector").alias("query_vector")), "query")
    chosen = retrieval.mmr_select(candidates, k=max(config.top_k_mmr, 24), weight=0.4)
    chosen = chosen.join(asked.select("query", picks.alias("_picks")), "query").where(F.col("pick") <= F.col("_picks"))
    texts = stored.where(F.col("kind") == "text").select("key", F.col("document").alias("text"))
    words = retrieval.bm25(texts, asked.where(F.col("question") != "").select("query", F.col("question").alias("text")), config.top_k_bm25, index)
    merged = dedupe.bag_union(chosen.select("query", "key", F.col("pick").alias("rank"), F.lit("mmr").alias("source")), words.select("query", "key", F.col("rank").cast("long").alias("rank"), F.lit("bm25").alias("source")))
    if config.dedupe_hybrid:
        merged = dedupe.first_rows(merged, {"_q": F.col("query"), "_k": F.col("key")}, [F.col("order")], merged.columns)
    full = merged.join(stored.select("key", "document", "metadata"), "key").join(asked.select("query", "question", procedural.alias("procedural"), final.alias("final")), "query")
    scored = full.withColumn("score", F.round(scorer(F.col("question"), F.col("document")), 9))
    ranked = retrieval.gate(scored, max(6, config.top_k)).where((F.coalesce(F.col("question"), F.lit("")) == "") | (F.col("rank") <= F.col("final")))
    m = F.col("metadata")
    sections = ranked.select("*", *[m[x].alias(f"_{x}") for x in ("source", "page", "h1", "h2", "h3")])
    capped = dedupe.cap_sections(sections, ["query", "_source", "_page", "_h1", "_h2", "_h3"])
    hits = retrieval.regroup(capped, retrieval.section_key(m), F.col("final"), F.col("procedural"))
    # some hits per request, which five parts of the reply read: cut, so that the search runs once
    hits = cut(hits.select("query", "question", "rank", "document", "metadata"))
    merged_pages = assembly.merge_by_page(hits)
    figures = assembly.links(assembly.page_images(merged_pages.select("query", "source", "page", "rank"), image_rows, "key"))
    ordered = hits.groupBy("query", "question").agg(F.array_sort(F.collect_list(F.struct("rank", assembly.snippet(m, F.col("rank"), F.col("document")).alias("block")))).alias("b"))
    lines = assembly.citations(hits).groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("c"))
    parts = ordered.join(lines, "query", "left").join(assembly.figure_lines(figures), "query", "left")
    prompts = parts.select("query", assembly.prompt(F.col("question"), F.transform("b", lambda x: x["block"]), F.transform("c", lambda x: x["line"]), F.coalesce("figures", F.array().cast("array<string>"))).alias("prompt"))
    return assembly.envelope(requests, merged_pages, figures, prompts)
