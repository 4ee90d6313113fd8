"""Retrieval for many questions at once: vectors, MMR, BM25, reranking, gates and section order.

Every table of hits is keyed by the request, so one plan serves a whole batch or stream of questions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomquill.functions.text import words

#: Query vectors are sent to the corpus in blocks of so many; their size is known before (a block of 64 is 1 MB).
QUERY_BLOCK = 4096


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))


def normalise(v: Column) -> Column:
    """Divided by its length, plus so little that zero vectors stay zero."""
    n = l2_norm(v) + 1e-12
    return F.transform(v, lambda x: x.cast("double") / n)


class TopN:
    """The n nearest of a partition's vectors, per part of the corpus, for each query of a block: (query, part, key, measure)."""

    def __init__(self, queries, n: int, cosine: bool, at_once: int = 256):
        self.queries, self.n, self.cosine, self.at_once = queries, n, cosine, at_once

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q = self.queries.value
        best: dict[tuple[int, str | None], tuple[np.ndarray, ...]] = {}  # by first query and part: query, key, measure
        for b in batches:
            lists = b.column(1)
            keep = np.flatnonzero(np.asarray(pa.compute.fill_null(pa.compute.equal(pa.compute.list_value_length(lists), q.shape[1]), False)))
            if not len(keep):
                continue
            v = np.array(pa.compute.fill_null(lists.take(pa.array(keep)).flatten().cast(pa.float64()), float("nan"))).reshape(-1, q.shape[1])
            good = np.isfinite(v).all(axis=1)
            v, keep = v[good], keep[good]
            keys, parts = np.asarray(b.column(0).cast(pa.int64()))[keep], np.array(b.column(2).take(pa.array(keep)).to_pylist(), dtype=object)
            if self.cosine:
                v = v / (np.sqrt((v * v).sum(axis=1, keepdims=True)) + 1e-12)
            for part in set(parts.tolist()):
                own = np.flatnonzero(parts == part)
                w, k = v[own], keys[own]
                length = (w * w).sum(axis=1)
                for at in range(0, len(q), self.at_once):
                    some = q[at : at + self.at_once]
                    m = 1 - some @ w.T if self.cosine else np.maximum((some * some).sum(axis=1)[:, None] + length - 2 * (some @ w.T), 0)
                    best[at, part] = self.better(best.get((at, part)), np.round(m, 9), k)
        for (at, part), (query, key, m) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(names[at + query]), pa.array([part] * len(key), pa.string()), pa.array(key), pa.array(1 - m if self.cosine else m)], names=["query", "part", "key", "measure"])

    def better(self, held: tuple[np.ndarray, ...] | None, m: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """The n best of each query among those held and the new ones, smaller keys first among equal ones."""
        if len(keys) > self.n:
            row, col = np.nonzero((m <= np.partition(m, self.n - 1, axis=1)[:, self.n - 1 : self.n]) & (m < np.inf))
        else:
            row, col = np.divmod(np.arange(m.size), len(keys))
        found = (row, keys[col], m[row, col])
        if held is not None:
            found = tuple(np.concatenate(x) for x in zip(held, found, strict=True))
        order = np.lexsort((found[1], found[2], found[0]))
        row, key, m = (x[order] for x in found)
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        return tuple(x[rank < self.n] for x in (row, key, m))


def nearest(corpus: DataFrame, queries: DataFrame, n: int, cosine: bool = False, block: int = QUERY_BLOCK, part: str | None = None) -> DataFrame:
    """(query, key, measure, rank): for each query vector the n nearest of the corpus by squared L2 distance, or cosine.

    Both inputs are (key BIGINT, vector). With ``part``, a string column of the corpus, it is (query, part, key, measure,
    rank) with the n nearest of each part, in the same single scan. Queries are a stated set: they go to the corpus in
    blocks of ``block``, each partition keeps n per query, and only those are shuffled. Exact; measures are rounded to 9
    places, ties go to the smaller key; vectors that are null, of another length or not finite take no part.
    """
    rows = queries.where(F.col("vector").isNotNull()).orderBy("key")
    spark, parts = corpus.sparkSession, []
    held: list[tuple[int, list[float]]] = []
    searched = corpus.select("key", "vector", (F.col(part) if part else F.lit(None)).cast("string").alias("part"))

    def send() -> None:
        q = np.array([v for _, v in held], dtype=np.float64)
        if cosine:
            q = q / (np.sqrt((q * q).sum(axis=1, keepdims=True)) + 1e-12)
        shared = spark.sparkContext.broadcast((np.array([k for k, _ in held], dtype=np.int64), q))
        parts.append(searched.mapInArrow(TopN(shared, n, cosine), "query long, part string, key long, measure double"))

    for r in rows.toLocalIterator():
        if not all(x is not None and np.isfinite(x) for x in r["vector"]) or held and len(r["vector"]) != len(held[0][1]):
            continue
        held.append((r["key"], list(r["vector"])))
        if len(held) == block:
            send()
            held = []
    if held:
        send()
    columns = ["query", *(["part"] if part else []), "key", "measure"]
    if not parts:
        return spark.createDataFrame([], "query long, part string, key long, measure double, rank int").select(*columns, "rank")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = [F.desc("measure"), F.col("key")] if cosine else [F.col("measure"), F.col("key")]
    w = Window.partitionBy("query", "part").orderBy(*order)
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select(*columns, "rank")


def mmr(query: np.ndarray, vectors: np.ndarray, k: int, weight: float) -> list[int]:
    """Positions picked by maximal marginal relevance on unit vectors; ties go to the first. O(k n d)."""
    if not len(vectors):
        return []
    relevance = np.round(vectors @ query, 9)
    worst = np.full(len(vectors), -np.inf)
    picked = [int(relevance.argmax())]
    free = np.ones(len(vectors), dtype=bool)
    while len(picked) < min(k, len(vectors)):
        free[picked[-1]] = False
        worst = np.maximum(worst, np.round(vectors @ vectors[picked[-1]], 9))
        score = np.where(free, np.round(weight * relevance - (1 - weight) * worst, 9), -np.inf)
        picked.append(int(score.argmax()))
    return picked


def mmr_select(hits: DataFrame, k: int = 20, weight: float = 0.4) -> DataFrame:
    """(query, key, pick) from (query, query_vector, key, vector, rank); a request has some 160 candidates, set by its budget."""

    def one(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("rank")
        v = np.stack(f["vector"].to_numpy()).astype(np.float64)
        q = np.asarray(f["query_vector"].iloc[0], dtype=np.float64)
        v = v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-12)
        picks = mmr(q / (np.linalg.norm(q) + 1e-12), v, k, weight)
        return pd.DataFrame({"query": f["query"].iloc[0], "key": f["key"].to_numpy()[picks], "pick": np.arange(1, len(picks) + 1)})

    return hits.select("query", "query_vector", "key", "vector", "rank").groupBy("query").applyInPandas(one, "query long, key long, pick long")


# --- BM25 ------------------------------------------------------------------------------------------------------------

K1, B, EPSILON = 1.5, 0.75, 0.25


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        tokens = [t.split() if t else [] for t in f["text"]]
        counts = [Counter(t) for t in tokens]
        yield pd.DataFrame({"key": f["key"], "length": [len(t) for t in tokens], "terms": [list(c) for c in counts], "tfs": [list(c.values()) for c in counts]})


def postings(docs: DataFrame) -> DataFrame:
    """(key, length, terms, tfs) of (key BIGINT, text): lower-cased tokens between white space with their counts.

    One row per document, so that a document is scored where it lies: neither a term that most documents have nor a
    question's hits are gathered in one place.
    """
    return docs.select("key", F.lower("text").alias("text")).mapInPandas(_counted, "key long, length int, terms array<string>, tfs array<int>")


def kept_postings(docs: DataFrame, folder: str, version: str) -> DataFrame:
    """Postings kept below ``folder`` for one snapshot of the store, made if they aren't there; another version is another
    folder, so an index is never older than what it serves."""
    if not version.replace("-", "").replace("_", "").isalnum():
        raise ValueError("a version must be letters, digits, hyphens and underscores")
    path = f"{folder}/version={version}"
    spark = docs.sparkSession
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        postings(docs).write.mode("ignore").parquet(path)
        return spark.read.parquet(path)


def term_weights(posted: DataFrame, n_docs: Column | int) -> DataFrame:
    """(term, df, idf): negative weights become a quarter of the mean one."""
    df = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    raw = df.withColumn("raw", F.log(F.lit(n_docs) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5))
    mean = raw.agg(F.avg("raw").alias("mean"))  # one row
    return raw.crossJoin(F.broadcast(mean)).select("term", "df", F.when(F.col("raw") < 0, EPSILON * F.col("mean")).otherwise(F.col("raw")).alias("idf"))


class Scores:
    """The k best documents of a partition for each question of a block, and the scores of the keys in ``always``."""

    def __init__(self, asked, k: int, mean_length: float, always: list[int]):
        self.asked, self.k, self.mean_length, self.always = asked, k, mean_length, always

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, terms, start, of, weight = self.asked.value
        known = pa.array(terms, pa.string())
        top = TopN(None, self.k, False)
        held = None
        for whole in batches:
            for at in range(0, len(whole), 1000):
                b = whole.slice(at, 1000)
                keys, lists = np.asarray(b.column(0)), b.column(2)
                size = np.asarray(pa.compute.list_value_length(lists)).astype(np.int64)
                term = np.asarray(pa.compute.fill_null(pa.compute.index_in(lists.flatten(), known), -1))
                hit = np.flatnonzero(term >= 0)
                doc = np.repeat(np.arange(len(b)), size)[hit]
                tf = np.asarray(b.column(3).flatten())[hit].astype(np.float64)
                impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * np.asarray(b.column(1))[doc] / self.mean_length))
                # each hit once for every question that has the term
                many = (start[1:] - start[:-1])[term[hit]]
                entry = np.repeat(start[term[hit]] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
                place = of[entry] * len(b) + np.repeat(doc, many)
                score = np.bincount(place, weight[entry] * np.repeat(impact, many), len(names) * len(b)).astype(np.float64).reshape(len(names), len(b))  # of nothing it counts in integers
                there = np.bincount(place, minlength=len(names) * len(b)).reshape(len(names), len(b)) > 0
                score = np.round(score, 9)
                extra = np.flatnonzero(np.isin(keys, self.always))
                if len(extra):
                    q = np.repeat(np.arange(len(names)), len(extra))
                    k = np.tile(extra, len(names))
                    yield self.batch(names[q], keys[k], score[q, k])
                held = top.better(held, np.where(there, -score, np.inf), keys)
        if held is not None:
            query, key, m = (x[np.isfinite(held[2])] for x in held)
            yield self.batch(names[query], key, -m)

    @staticmethod
    def batch(query, key, score) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(key), pa.array(score)], names=["query", "key", "score"])


def bm25(docs: DataFrame, questions: DataFrame, k: int = 10, posted: DataFrame | None = None, block: int = 1024) -> DataFrame:
    """(query, key, score, rank) of (key BIGINT, text) by (query BIGINT, text): Okapi weights, a term counts as often as it is asked.

    Documents without any of the terms have score 0 and fill up the k, smallest keys first. Keys are unique. Questions are
    a stated set: they go to the postings in blocks of ``block``, every partition scores its own documents and keeps k of
    them per question, and only those are shuffled. Postings are cut, as they serve the statistics and the scores, unless
    kept ones are given (``docs`` isn't read then).
    """
    from loomquill.session import cut

    spark = questions.sparkSession
    posted = cut(postings(docs)) if posted is None else posted
    totals = posted.agg(F.count("*").alias("n"), F.sum("length").alias("words")).first()
    n_docs, mean_length = totals["n"], (totals["words"] or 0) / max(1, totals["n"])
    # bounded: only these can fill up
    first = [r["key"] for r in posted.select("key").orderBy("key").limit(2 * k).collect()]
    asked = questions.select("query", F.explode_outer(words(F.lower("text"))).alias("term")).groupBy("query", "term").agg(F.count("*").alias("times"))
    weighted = cut(asked.join(term_weights(posted, n_docs), "term", "left").select("query", "term", (F.col("times") * F.col("idf")).alias("weight")))
    parts, held, ids = [], [], []

    def send() -> None:
        names = np.array(sorted({r["query"] for r in held}), dtype=np.int64)
        rows = sorted((r["term"], int(np.searchsorted(names, r["query"])), r["weight"]) for r in held if r["weight"] is not None)
        terms = list(dict.fromkeys(r[0] for r in rows))
        number = {t: i for i, t in enumerate(terms)}
        start = np.searchsorted(np.array([number[r[0]] for r in rows], dtype=np.int64), np.arange(len(terms) + 1))
        shared = spark.sparkContext.broadcast((names, terms, start, np.array([r[1] for r in rows], dtype=np.int64), np.array([r[2] for r in rows], dtype=np.float64)))
        parts.append(posted.select("key", "length", "terms", "tfs").mapInArrow(Scores(shared, k, max(mean_length, 1e-9), first), "query long, key long, score double"))

    for r in weighted.orderBy("query").toLocalIterator():
        if not ids or ids[-1] != r["query"]:
            if len(ids) == block:
                send()
                held, ids = [], []
            ids.append(r["query"])
        held.append(r)
    if held:
        send()
    if not parts:
        return spark.createDataFrame([], "query long, key long, score double, rank int")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    w = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return found.distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


# --- reranking -------------------------------------------------------------------------------------------------------


def overlap_score(question: Column, document: Column) -> Column:
    """The default pair scorer: the share of the question's distinct words that the document has."""
    asked = F.array_distinct(words(F.lower(question)))
    there = F.array_distinct(words(F.lower(F.coalesce(F.nullif(document, F.lit("")), F.lit(" ")))))
    return F.when(F.size(asked) > 0, F.size(F.array_intersect(asked, there)) / F.size(asked)).otherwise(F.lit(0.0))


def rerank(hits: DataFrame, keep: int, question: str = "question", document: str = "document", order: str = "order", scorer=overlap_score) -> DataFrame:
    """Adds ``score`` and ``rank``; the first ``keep`` per request by score, equal ones in their order."""
    scored = hits.withColumn("score", F.round(scorer(F.col(question), F.col(document)), 9))
    w = Window.partitionBy("query").orderBy(F.desc("score"), order)
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def gate(hits: DataFrame, keep: int, least: float = 0.30) -> DataFrame:
    """Final hits of scored ones (query, question, source 'mmr' or 'bm25', order, score): the best ``keep`` by score, or the
    first ``keep`` of BM25 if no score reaches ``least`` and there are any; all of them for an empty question."""
    all_of = Window.partitionBy("query")
    marked = hits.withColumn("_top", F.max("score").over(all_of)).withColumn("_bm25", F.max(F.col("source") == "bm25").over(all_of)).withColumn("_asked", F.coalesce(F.col("question") != "", F.lit(False)))
    weak = F.col("_asked") & (F.col("_top") < least) & F.col("_bm25")
    kept = marked.withColumn("_weak", weak).where(~F.col("_weak") | (F.col("source") == "bm25"))
    order = Window.partitionBy("query").orderBy(F.when(F.col("_weak") | ~F.col("_asked"), 0.0).otherwise(-F.col("score")), "order")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(~F.col("_asked") | (F.col("rank") <= keep))
    return ranked.drop("_top", "_bm25", "_asked", "_weak")


def budget(procedural: Column, top_k: int = 3, top_k_mmr: int = 20) -> tuple[Column, Column]:
    """(final hits, MMR picks): wider for questions about procedures."""
    return F.when(procedural, F.greatest(F.lit(top_k), F.lit(6))).otherwise(F.lit(top_k)), F.when(procedural, F.greatest(F.lit(top_k_mmr), F.lit(24))).otherwise(F.lit(top_k_mmr))


def regroup(hits: DataFrame, section: Column, keep: Column | int, procedural: Column) -> DataFrame:
    """For procedures: hits of the best hit's section first, in rank order, then the others; cut to ``keep``."""
    w = Window.partitionBy("query").orderBy("rank")
    marked = hits.withColumn("_section", section).withColumn("_same", F.col("_section").eqNullSafe(F.first("_section").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    order = Window.partitionBy("query").orderBy(F.when(procedural & ~F.col("_same"), 1).otherwise(0), "rank")
    again = marked.withColumn("rank", F.row_number().over(order)).drop("_section", "_same")
    return again.where(~procedural | (F.col("rank") <= keep))


def section_key(metadata: Column) -> Column:
    return F.struct(metadata["source"], metadata["page"], metadata["h1"], metadata["h2"])


