"""Embedding through providers, and the requests that come with questions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomquill.functions.text import strip
from loomquill.operators.chunking import TOKEN
from loomquill.operators.images import stub


class HashEmbedder:
    """The default text embedder: signed feature hashing of tokens, scaled to length 1. Real models have the same method."""

    def __init__(self, dimensions: int = 64):
        self.dimensions = dimensions

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dimensions), dtype=np.float64)
        for row, text in zip(out, texts, strict=True):
            for t in TOKEN.findall(text.lower()):
                h = int.from_bytes(hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
                row[h % self.dimensions] += 1 if h >> 63 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norm, out=out, where=norm > 0)


#: Embedding providers by name: functions that make an object with ``encode(texts) -> array``, as ``HashEmbedder`` is.
PROVIDERS: dict[str, Callable[[], object]] = {"hash-64": HashEmbedder, "hash-256": lambda: HashEmbedder(256)}


def register(name: str, make: Callable[[], object]) -> None:
    """Lets ``make``, which the workers call once each, be chosen by name."""
    PROVIDERS[name] = make


def encoder(provider=None):
    """A column function from texts to vectors, by a provider or the name of a registered one, which is then made on each
    worker, once. A null text is embedded as empty."""
    if isinstance(provider, str) and provider not in PROVIDERS:
        raise ValueError(f"no embedding provider is registered as {provider}")
    make = PROVIDERS[provider] if isinstance(provider, str) else (lambda: provider or HashEmbedder())

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        made = make()
        for b in batches:
            yield pd.Series(list(made.encode([x or "" for x in b]).astype(np.float32)))

    return run


def assembled(text_chunks: DataFrame, image_chunks: DataFrame, images: DataFrame, provider=None, pixels=None) -> DataFrame:
    """(stream, ord, document, metadata, embedding): text, image text and stubs of images that have a path; with ``pixels``,
    a provider over ``content``, their pixel vectors too. Inputs: ord, page_content, metadata."""
    embed = encoder(provider)
    m = F.col("metadata")
    stubs = images.where(m["image_path"].isNotNull() & (m["image_path"] != "")).withColumn("page_content", stub(m["source"], m["page"], m["image_path"], m["vision_label"]))
    out = None
    for name, part in (("txt", text_chunks), ("img_txt", image_chunks), ("img_stub", stubs)):
        rows = part.select(F.lit(name).alias("stream"), "ord", F.col("page_content").alias("document"), "metadata", embed(F.col("page_content")).alias("embedding"))
        out = rows if out is None else out.unionByName(rows)
    if pixels is not None:
        out = out.unionByName(stubs.select(F.lit("img").alias("stream"), "ord", F.col("page_content").alias("document"), "metadata", pixels(F.col("content")).alias("embedding")))
    return out


def question(api: Column, message: Column, text: Column) -> Column:
    """The last message of a user, or else the request's message, or else its text; null if all are blank."""
    last = F.try_element_at(F.filter(api, lambda m: m["role"] == "user"), F.lit(-1))["content"]
    return F.coalesce(F.nullif(strip(last), F.lit("")), F.nullif(strip(message), F.lit("")), F.nullif(strip(text), F.lit("")))


def first_id(*values: Column) -> Column:
    """The first value that is neither null, empty nor 0, as a number if it is one, else null."""
    return F.coalesce(*[F.when((v.cast("string") != "") & (v.cast("string") != "0"), v.cast("string")) for v in values]).try_cast("bigint")


def request_id(*values: Column) -> Column:
    """The first value that is neither null, empty nor 0; 0 unless it is all digits."""
    first = F.coalesce(*[F.when((v.cast("string") != "") & (v.cast("string") != "0"), v.cast("string")) for v in values])
    return F.coalesce(F.when(first.rlike("^[0-9]+$"), first.try_cast("bigint")), F.lit(0).cast("bigint"))


def encoded_requests(requests: DataFrame, provider=None) -> DataFrame:
    """(request_id, message, embeddings, api, metadata) of the requests that have a question; others are dropped. The id is
    the request's, or that in its metadata."""
    asked = requests.withColumn("message", question(F.col("api"), F.col("message"), F.col("text"))).where(F.col("message").isNotNull())
    return asked.select(request_id(F.col("requestId"), F.col("request_id"), F.col("metadata")["requestId"], F.col("metadata")["request_id"]).alias("request_id"), "message", encoder(provider)(F.col("message")).alias("embeddings"), "api", "metadata")
