"""Evaluation passages inside a corpus, verbatim or with other numbers, names and units.

Every text becomes a list of words in which numbers, units and names are typed placeholders; windows of ten words are
hashed on that template and joined by hash. The slots of a joined pair are then compared: equal slots are a verbatim
leak, a consistent one-to-one exchange of slot values is a re-parameterised question. The items' distinct window hashes
go to the corpus scan as a filter while they are few (their number is counted first); beyond that all windows of the
corpus are shuffled to the same join, with the same result. Which words are names is decided over all items by one
aggregation of their words; the scan gets 8 bytes a word. A template that many documents have is split over tasks.

Defined results: a word is a maximal run of letters and digits in lower case; null, empty and shorter texts match
nothing; rows without an id are ignored; rows repeated under one id are one record and give one row; equal texts under several ids each give their rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomquill.session import cut

WINDOW = 10
#: Up to this many distinct window hashes of items (8 bytes each) are sent to the scan of the corpus.
MOST_HASHES = 2_000_000
#: Distinct words of all items (8 bytes each) that a scan can be given; more are refused, as the templates would differ.
MOST_WORDS = 16_000_000
#: A window counts as re-parameterised only with so many words that are no slots: ten numbers are any ten numbers.
LEAST_FIXED = 4
#: Windows of one template in one task of the join; a template with more is split.
MOST_WINDOWS = 50_000
WORD = regex.compile(r"[\p{L}\p{N}]+")
#: Names of units in lower case.
UNITS = frozenset("ampere amperes bar bars celsius centimetre centimetres centimeter centimeters cm db decibel decibels degree degrees fahrenheit foot feet g gram grams hour hours hz hertz inch inches joule joules kelvin kg kilogram kilograms kilometre kilometres kilometer kilometers kilopascal kilopascals kilowatt kilowatts km kpa kw litre litres liter liters metre metres meter meters mile miles millimetre millimetres millimeter millimeters minute minutes mm newton newtons ohm ohms pascal pascals percent revolution revolutions rpm second seconds tonne tonnes volt volts watt watts".split())
NUMBER, UNIT, NAME = "\x01n", "\x01u", "\x01p"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _hash(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"))


def _item_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, inside, small) of a batch of items: each word in lower case, whether it stands with a capital inside a
    sentence, and whether it stands without one."""
    for f in frames:
        seen: dict[str, list[bool]] = {}
        for text in f["text"]:
            for m in WORD.finditer(text or ""):
                w = m.group()
                found = seen.setdefault(w.lower(), [False, False])
                if w[0].isupper():
                    before = text[max(0, m.start() - 50) : m.start()].rstrip()
                    found[0] |= bool(before) and before[-1] not in ".!?:;\"“”'("
                else:
                    found[1] = True
        yield pd.DataFrame([(w, *x) for w, x in seen.items()], columns=["word", "inside", "small"])


def item_words(items: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of all words of the items, and of the names among them: words that stand with a capital inside
    sentences and never without one."""
    per = items.select("text").mapInPandas(_item_words, "word string, inside boolean, small boolean")
    words = per.groupBy("word").agg(F.max("inside").alias("inside"), F.max("small").alias("small"))
    hashed = words.select((F.col("inside") & ~F.col("small") & ~F.col("word").rlike(r"\p{N}")).alias("name"), _hashed("word").alias("h"))
    found = hashed.limit(MOST_WORDS + 1).toPandas()
    if len(found) > MOST_WORDS:
        raise ValueError(f"the items have more than {MOST_WORDS} distinct words; search them in several sets")
    h = found["h"].to_numpy(dtype=np.int64).view(np.uint64)
    return np.sort(h), np.sort(h[found["name"].to_numpy(dtype=bool)])


@F.pandas_udf(T.LongType())
def _hashed(words: pd.Series) -> pd.Series:
    return pd.Series(np.array([_hash(w) for w in words], dtype=np.uint64).view(np.int64))


def _among(h: int, hashes: np.ndarray) -> bool:
    i = int(np.searchsorted(hashes, np.uint64(h)))
    return i < len(hashes) and int(hashes[i]) == h


class Windows:
    """Windows of template hashes over a frame of texts; kept where ``wanted`` has the hash, or all of them. ``shared`` is a
    broadcast of (hashes of the items' words, hashes of names, hashes of windows or None)."""

    def __init__(self, shared, of_items: bool):
        self.shared, self.of_items, self.codes = shared, of_items, {}

    def template(self, word: str) -> tuple[int, bool]:
        """Hash of a word or its placeholder, and whether it is a placeholder."""
        code = self.codes.get(word)
        if code is None:
            low = word.lower()
            h = _hash(low)
            shape = NUMBER if any(c.isdigit() for c in low) else UNIT if low in UNITS else NAME if _among(h, self.names) else ""
            if not shape and not self.of_items and word[0].isupper() and not word.isupper() and not _among(h, self.known):
                shape = NAME  # a capitalised word that no item has can only stand for another name
            if len(self.codes) > 500_000:
                self.codes = {}
            code = self.codes[word] = (_hash(shape) if shape else h, bool(shape))
        return code

    def __call__(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        self.known, self.names, wanted = self.shared.value
        self.wanted = None if self.of_items else wanted
        powers = np.array([pow(int(FACTOR), WINDOW - 1 - i, 2**64) for i in range(WINDOW)], dtype=np.uint64)
        for f in frames:
            found = [WORD.findall(x) if x else [] for x in f["text"]]
            size = np.array([len(x) for x in found])
            flat = [w for x in found for w in x]
            n = len(flat) - WINDOW + 1
            if n < 1:
                continue
            codes = [self.template(w) for w in flat]
            h = np.fromiter((c for c, _ in codes), dtype=np.uint64, count=len(flat))
            fixed = np.concatenate(([0], np.cumsum([not slot for _, slot in codes])))
            key = np.zeros(n, dtype=np.uint64)
            for i, p in enumerate(powers):
                key += h[i : i + n] * p
            doc = np.repeat(np.arange(len(f)), size)
            hit = doc[:n] == doc[WINDOW - 1 :]
            if self.wanted is not None:
                at = np.searchsorted(self.wanted, key)
                hit &= self.wanted[np.minimum(at, len(self.wanted) - 1)] == key if len(self.wanted) else False
            at = np.flatnonzero(hit)
            if not len(at):
                continue
            start = np.concatenate(([0], np.cumsum(size)))
            texts = [[w.lower() for w in flat[i : i + WINDOW]] for i in at.tolist()]
            yield pd.DataFrame({"id": f["id"].to_numpy()[doc[at]], "pos": (at - start[doc[at]]).astype(np.int32), "template": key[at].view(np.int64), "exact": [_hash(" ".join(t)) - 2**63 for t in texts], "fixed": (fixed[at + WINDOW] - fixed[at]).astype(np.int32), "words": texts})


SCHEMA = "id long, pos int, template long, exact long, fixed int, words array<string>"


def windows(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Template windows of the corpus (those that can join) and of the items: (id, pos, template, exact, fixed, words)."""
    context = docs.sparkSession.sparkContext
    known, names = item_words(items)
    of_items = items.where(F.col("id").isNotNull()).select("id", "text").mapInPandas(Windows(context.broadcast((known, names, None)), True), SCHEMA)
    hashes = of_items.select("template").distinct().limit(MOST_HASHES + 1).toPandas()["template"].to_numpy(dtype=np.int64)
    wanted = np.sort(hashes.view(np.uint64)) if len(hashes) <= MOST_HASHES else None
    return docs.where(F.col("id").isNotNull()).select("id", "text").mapInPandas(Windows(context.broadcast((known, names, wanted)), False), SCHEMA), of_items


def verbatim(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) where the slots of a joined template window are equal too: ten consecutive equal words.

    Both inputs are (id, text). The join is on the template and on the words, so a template that many items share
    doesn't multiply rows; windows are made distinct before the join.
    """
    of_docs, of_items = windows(docs, items)
    left = of_docs.select(F.col("id").alias("doc_id"), "template", "exact", "words").distinct()
    right = of_items.select(F.col("id").alias("item_id"), "template", "exact", "words").distinct()
    return left.join(right, ["template", "exact", "words"]).select("doc_id", "item_id").distinct()


def consistent(theirs: Column, ours: Column) -> Column:
    """Whether the words of two windows exchange one-to-one: as many distinct pairs as distinct words on either side."""
    pairs = F.size(F.array_distinct(F.arrays_zip(theirs.alias("a"), ours.alias("b"))))
    return (pairs == F.size(F.array_distinct(theirs))) & (pairs == F.size(F.array_distinct(ours)))


def leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, kind, n_windows, first_pos): kind 'verbatim', or 're-parameterised' if no window is verbatim.

    A window whose slots differ counts only with LEAST_FIXED words that are no slots. Windows of one text at several places
    of a document are joined once; a template that more than MOST_WINDOWS windows of the corpus have is split by document,
    the items' few windows of it going to every part.
    """
    of_docs, of_items = windows(docs, items)
    left = cut(of_docs.groupBy(F.col("id").alias("doc_id"), "template", "fixed", F.col("words").alias("found")).agg(F.collect_set("pos").alias("at")))
    right = of_items.select(F.col("id").alias("item_id"), "template", "words").distinct()
    parts = left.groupBy("template").count().select("template", F.ceil(F.col("count") / MOST_WINDOWS).cast("int").alias("parts"))
    right = right.join(parts, "template").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left = left.join(parts.where("parts > 1"), "template", "left").withColumn("part", F.pmod(F.hash("doc_id"), F.coalesce("parts", F.lit(1))))
    pairs = left.drop("parts").join(right.drop("parts"), ["template", "part"]).withColumn("same", F.col("words") == F.col("found"))
    pairs = pairs.where(F.col("same") | (F.col("fixed") >= LEAST_FIXED) & consistent(F.col("words"), F.col("found")))
    places = pairs.select("doc_id", "item_id", "same", F.explode("at").alias("pos"))
    grouped = places.groupBy("doc_id", "item_id").agg(F.max("same").alias("same"), F.countDistinct("pos").alias("n_windows"), F.min("pos").cast("long").alias("first_pos"))
    return grouped.select("doc_id", "item_id", F.when(F.col("same"), "verbatim").otherwise("re-parameterised").alias("kind"), "n_windows", "first_pos")
