"""Near-duplicate texts: an inverted join on the coordinates of signatures.

A text's signature has COORDINATES values, each made of three min-hashes over its runs of words, so that two texts of
similarity s agree in a coordinate with probability s cubed, and phrases that many texts share hardly ever make a list. Texts are posted under each (coordinate, value); lists are
counted after a map-side combine, and lists of one text go. Of its lists of more than LIST_SHORT texts a text leaves out
the longest, AGREE - 1 at most: two texts that agree in AGREE coordinates still meet in a list that both keep (the
prefix). The texts that keep a list meet all of it; what two texts both leave out is counted when they meet elsewhere. So
collisions are counted in full, and pairs with AGREE of them are compared exactly on their sets of runs.

Texts with equal word sequences form one class before anything is posted, so copies cost one row per task. Lists of more
than LIST_BLOCK texts are joined in blocks of that size: no task holds a whole list. With 44 coordinates and 2 agreements
a pair of similarity 0.6 is missed with probability 3e-4, one of 0.65 with 1e-5, one of 0.7 with 2e-7. Values are kept in VALUE
bytes: by those that are equal by chance a pair is only compared for nothing. At the other parameters in use, five words and
0.8, a pair just at the threshold is missed with probability 1e-12.

``alike_pairs`` gives all pairs, so its result is quadratic in a family of texts that are all alike. ``groups`` gives each text
its group (the connected component of its links) in rows that grow with the texts: in a list of more than LIST_SHORT texts
each one is first compared with the list's smallest only (a star). A list whose texts are then one group has no more to say;
texts of the others are compared with those of other groups in the same list. So no link between groups is left out.

Defined results: words are maximal runs of letters and digits in lower case; null texts and texts with fewer words than a
run has none and are alike to nothing; rows repeated under one key are one record (of unequal ones each text counts);
empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomquill.session import cut

WORD = regex.compile(r"[\p{L}\p{N}]+")
COORDINATES, JOINED, AGREE, VALUE, LIST_SHORT, LIST_BLOCK = 44, 3, 2, 5, 200, 2000
#: Up to this many texts in candidate pairs, their keys (some 30 bytes each) are broadcast to the scan of the texts.
MOST_WANTED = 300_000
#: Classes of equal texts up to this size are written out as pairs; larger ones as pairs with their smallest member.
PAIRED = 256
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64 bits (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Runs:
    """Hashes of the runs of words of a batch of texts, with the start of each text's runs."""

    def __init__(self, run: int):
        self.run, self.codes = run, {}

    def code(self, word: str) -> int:
        c = self.codes.get(word)
        if c is None:
            c = self.codes[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return c

    def __call__(self, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.codes) > 500_000:
            self.codes = {}
        size = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.fromiter((self.code(w) for x in words for w in x), dtype=np.uint64, count=int(size.sum()))
        n = max(0, len(flat) - self.run + 1)
        key = np.zeros(n, dtype=np.uint64)
        for i in range(self.run):
            key = _mix(key * GOLDEN + flat[i : n + i] + np.uint64(i))
        doc = np.repeat(np.arange(len(words)), size)
        inside = doc[:n] == doc[self.run - 1 :][:n]
        counts = np.maximum(size - self.run + 1, 0)
        return key[inside], np.concatenate(([0], np.cumsum(counts)))


def _words(texts: list[str | None]) -> list[list[str]]:
    return [WORD.findall(t.lower()) if t else [] for t in texts]


class Signatures:
    """(tbl, key, h1, h2, coordinate values) of the texts that have runs; h1 and h2 name the word sequence."""

    def __init__(self, run: int):
        self.run = run

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the runs' hashes are mixed well, so odd factors give as good as independent orders
        factors = _mix(np.arange(1, JOINED * COORDINATES + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
        runs = Runs(self.run)
        for whole in batches:
            for at in range(0, len(whole), 2000):
                b = whole.slice(at, 2000)
                words = _words(b.column(2).to_pylist())
                key, start = runs(words)
                kept = np.flatnonzero(np.diff(start) > 0)
                if not len(kept):
                    continue
                mins = np.stack([np.minimum.reduceat(key * f, start[kept]) for f in factors])
                values = np.broadcast_to(np.arange(COORDINATES, dtype=np.uint64)[:, None], (COORDINATES, len(kept)))
                for j in range(JOINED):
                    values = _mix(values * GOLDEN + mins[j::JOINED])
                names = [xxhash.xxh128_digest(" ".join(words[i]).encode("utf-8", "surrogatepass")) for i in kept]
                h = np.frombuffer(b"".join(names), dtype="<i8").reshape(-1, 2)
                rows = pa.array(kept)
                low = np.ascontiguousarray(values.T).astype("<u8").view(np.uint8).reshape(len(kept), COORDINATES, 8)[:, :, :VALUE]
                raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(VALUE * COORDINATES), len(kept), [None, pa.py_buffer(low.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), raw], names=["tbl", "key", "h1", "h2", "coordinates"])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, post) for each coordinate of (node, tbl, coordinates): a value belongs to one collection."""
    for whole in batches:
        for at in range(0, len(whole), 2000):
            b = whole.slice(at, 2000)
            values = np.zeros((len(b), COORDINATES, 8), dtype=np.uint8)
            values[:, :, :VALUE] = np.frombuffer(b"".join(b.column(2).to_pylist()), dtype=np.uint8).reshape(len(b), COORDINATES, VALUE)
            post = values.view("<i8")[:, :, 0] ^ np.asarray(b.column(1)).astype(np.int64)[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(b.column(0)), COORDINATES)), pa.array(post.ravel())], names=["node", "post"])


class RunSets:
    """(tbl, cls, sorted distinct runs) of the texts of candidate pairs."""

    def __init__(self, run: int):
        self.run = run

    def __call__(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = Runs(self.run)
        for f in frames:
            key, start = runs(_words(f["text"].tolist()))
            sets = [np.unique(key[a:b]).view(np.int64) for a, b in zip(start[:-1], start[1:], strict=True)]
            yield pd.DataFrame({"tbl": f["tbl"], "cls": f["cls"], "runs": sets})


SIGNATURE = "tbl int, key long, h1 long, h2 long, coordinates binary"


def signatures(texts: DataFrame, run: int) -> DataFrame:
    return cut(texts.select("tbl", "key", "text").where(F.col("key").isNotNull() & F.col("text").isNotNull()).mapInArrow(Signatures(run), SIGNATURE))


def class_table(signed: DataFrame) -> DataFrame:
    """(tbl, h1, h2, cls, many, coordinates): one row per distinct word sequence, cls its smallest key."""
    same = F.max("coordinates").alias("coordinates")  # equal in a class
    return signed.groupBy("tbl", "h1", "h2").agg(F.min("key").alias("cls"), (F.min("key") < F.max("key")).alias("many"), same)


def node(tbl: Column, key: Column) -> Column:
    """One number for a collection (0 to 15) and a key in it (below 2**59)."""
    return key * 16 + tbl


def lists(one: DataFrame) -> DataFrame:
    """(post, node, n, hub): where each class is posted, with the number of classes in that list and the smallest of them."""
    posted = one.select(node(F.col("tbl"), F.col("cls")).alias("node"), "tbl", "coordinates").mapInArrow(_postings, "node long, post long")
    return posted.join(posted.groupBy("post").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1"), "post")


def candidates(met: DataFrame, agree: int = AGREE, apart: bool = False) -> DataFrame:
    """(a, b) with a < b: class pairs with ``agree`` collisions in lists (post, node, n). With ``apart`` lists have a column
    ``grp`` too, and only pairs of different groups are given."""
    if not apart:
        met = met.withColumn("grp", F.lit(0))
    # the prefix: short lists, and of the others all but the agree - 1 longest; a text has COORDINATES of them at most
    own = met.groupBy("node", "grp").agg(F.sort_array(F.collect_list(F.struct("n", "post"))).alias("own")).where(F.size("own") >= agree)
    flagged = F.transform("own", lambda x, i: F.struct(x["n"].alias("n"), x["post"].alias("post"), ((x["n"] <= LIST_SHORT) | (i <= F.size("own") - agree)).alias("kept")))
    out = F.transform(F.filter(flagged, lambda x: ~x["kept"]), lambda x: x["post"])
    each = own.select("node", "grp", out.alias("out"), F.explode(flagged).alias("x"))
    blocks = F.ceil(F.col("x.n") / LIST_BLOCK).cast("int")
    left = each.where("x.kept").select("x.post", F.pmod(F.hash("node"), blocks).alias("block"), F.col("node").alias("a"), F.col("grp").alias("grp_a"), F.col("out").alias("out_a"))
    right = each.select("x.post", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.col("node").alias("b"), F.col("grp").alias("grp_b"), F.col("x.kept").alias("both"), F.col("out").alias("out_b"))
    # a list that both leave out makes no pair, but counts for pairs that meet elsewhere
    meeting = left.join(right, ["post", "block"]).where("a < b or (not both and a != b)")
    if apart:
        meeting = meeting.where("grp_a != grp_b")
    pairs = meeting.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.size(F.array_intersect("out_a", "out_b")).alias("more"))
    return pairs.groupBy("a", "b").agg((F.count("*") + F.max("more")).alias("all")).where(F.col("all") >= agree).select("a", "b")


@F.pandas_udf(T.DoubleType())
def overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of the common elements of two sorted arrays without repeats in those of either."""

    def one(x: np.ndarray, y: np.ndarray) -> float:
        both = len(x) + len(y) - len(np.unique(np.concatenate((x, y))))
        return both / (len(x) + len(y) - both)

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)])


def compared(texts: DataFrame, pairs: DataFrame, least: float, run: int) -> DataFrame:
    """(tbl, a, b, similarity) of the pairs of nodes (a, b) whose similarity is ``least`` or more; a and b are keys again."""
    met = cut(pairs.select(F.pmod("a", F.lit(16)).cast("int").alias("tbl"), F.shiftright("a", 4).alias("a"), F.shiftright("b", 4).alias("b")))
    wanted = met.select("tbl", F.explode(F.array("a", "b")).alias("cls")).distinct()
    if wanted.limit(MOST_WANTED + 1).count() <= MOST_WANTED:
        wanted = F.broadcast(wanted)  # else the texts are shuffled to it
    rows = texts.select("tbl", F.col("key").alias("cls"), "text").where(F.col("text").isNotNull())
    sets = rows.join(wanted, ["tbl", "cls"]).mapInPandas(RunSets(run), "tbl int, cls long, runs array<long>")
    # of unequal texts under one key the one with fewest runs stands for it; equal rows are one
    known = sets.groupBy("tbl", "cls").agg(F.min_by("runs", F.size("runs")).alias("runs"))
    left, right = (known.select("tbl", F.col("cls").alias(x), F.col("runs").alias(f"runs_{x}")) for x in "ab")
    beside = met.join(left, ["tbl", "a"]).join(right, ["tbl", "b"])
    return beside.select("tbl", "a", "b", overlap("runs_a", "runs_b").alias("similarity")).where(F.col("similarity") >= least)


def class_pairs(texts: DataFrame, signed: DataFrame, least: float, run: int, agree: int = AGREE) -> DataFrame:
    """(tbl, a, b, similarity) with a < b: all pairs of classes found whose similarity is ``least`` or more."""
    return compared(texts, candidates(lists(class_table(signed)), agree), least, run)


def membership(signed: DataFrame) -> DataFrame:
    """(tbl, cls, key) of the classes with several members, and their size."""
    several = signed.groupBy("tbl", "h1", "h2").agg(F.min("key").alias("cls"), F.max("key").alias("last")).where("cls < last").drop("last")
    return signed.select("tbl", "h1", "h2", "key").join(several, ["tbl", "h1", "h2"]).select("tbl", "cls", "key").distinct()


def alike_pairs(texts: DataFrame, least: float = 0.6, run: int = 3, agree: int = AGREE, paired: int = PAIRED) -> DataFrame:
    """(tbl, a, b) with a < b: keys whose texts are alike by ``least`` or more. ``texts``: (tbl INT, key BIGINT, text).

    Equal texts have similarity 1. Classes with up to ``paired`` members are written out in full; of a larger class every
    member comes with the smallest one, and links to other classes are those of that one. Nothing is lost thereby: equal
    texts have the same links.
    """
    signed = signatures(texts, run)
    members = cut(membership(signed))
    large = members.groupBy("tbl", "cls").count().where(F.col("count") > paired).select("tbl", "cls")
    small = members.join(large, ["tbl", "cls"], "left_anti")
    between = class_pairs(texts, signed, least, run, agree).select("tbl", "a", "b")
    for side in ("a", "b"):
        of = small.select("tbl", F.col("cls").alias(side), F.col("key").alias("_key"))
        between = between.join(of, ["tbl", side], "left").withColumn(side, F.coalesce("_key", side)).drop("_key")
    across = between.select("tbl", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    inside = small.select("tbl", "cls", F.col("key").alias("a")).join(small.select("tbl", "cls", F.col("key").alias("b")), ["tbl", "cls"]).where("a < b").select("tbl", "a", "b")
    stars = members.join(large, ["tbl", "cls"], "left_semi").where("cls < key").select("tbl", F.col("cls").alias("a"), F.col("key").alias("b"))
    return across.unionByName(inside).unionByName(stars).where("a < b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, grp): the smallest node of the connected component of each node that has a link (a, b).

    Alternating stars: every node's larger neighbours are hung on its smallest neighbour, then its smaller ones are, until
    nothing changes; the number of rounds grows with the logarithm of the longest chain. Minima are combined on the map side,
    and a node with many links is one row on one side of the join, whose other side Spark splits where it is skewed.
    """
    edges, before = cut(links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high").distinct()), None
    while True:
        both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(edges.select(F.col("high").alias("u"), F.col("low").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("low"), F.col("v").alias("high")).where("low < high").distinct()
        least = large.groupBy(F.col("high").alias("u")).agg(F.min("low").alias("m"))
        hung = large.join(least, large["high"] == least["u"]).select("u", "m", "low")
        small = hung.select(F.col("m").alias("low"), F.col("u").alias("high")).unionByName(hung.select(F.col("m").alias("low"), F.col("low").alias("high")))
        edges = cut(small.where("low < high").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    return edges.select(F.col("high").alias("node"), F.col("low").alias("grp")).unionByName(edges.select(F.col("low").alias("node"), F.col("low").alias("grp")).distinct())


def groups(texts: DataFrame, least: float = 0.8, run: int = 5, agree: int = AGREE) -> DataFrame:
    """(tbl, key, group_id, n_members): every text that has runs with its group of near-duplicates, whose smallest key is
    group_id. A group is a connected component of texts alike by ``least`` or more; n_members counts its keys."""
    signed = signatures(texts, run)
    met = cut(lists(class_table(signed)))
    # short lists in full; what two texts have in common in longer ones counts when they meet in a short one
    long = F.col("n") > LIST_SHORT
    out = met.where(long).groupBy("node").agg(F.collect_list("post").alias("out"))  # COORDINATES of them at most
    brief = met.where(~long).join(out, "node", "left").select("post", "node", F.coalesce("out", F.array().cast("array<bigint>")).alias("out"))
    left, right = (brief.select("post", F.col("node").alias(x), F.col("out").alias(f"out_{x}")) for x in "ab")
    close = left.join(right, "post").where("a < b").select("a", "b", F.size(F.array_intersect("out_a", "out_b")).alias("more"))
    close = close.groupBy("a", "b").agg((F.count("*") + F.max("more")).alias("all")).where(F.col("all") >= agree).select("a", "b")
    star = met.where(long & (F.col("node") > F.col("hub"))).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    named = lambda found: found.select(node(F.col("tbl"), F.col("a")).alias("a"), node(F.col("tbl"), F.col("b")).alias("b"))
    links = cut(named(compared(texts, close.unionByName(star).distinct(), least, run)))
    of = components(links)
    # long lists whose texts aren't one group yet
    placed = met.where(long).select("post", "node", "n").join(of, "node", "left").withColumn("grp", F.coalesce("grp", "node"))
    several = placed.groupBy("post").agg(F.min("grp").alias("first"), F.max("grp").alias("last")).where("first < last").select("post")
    rest = cut(placed.join(several, "post"))
    if not rest.isEmpty():
        of = components(links.unionByName(named(compared(texts, candidates(rest, agree, apart=True), least, run))))
    one = signed.groupBy("tbl", "h1", "h2").agg(F.min("key").alias("cls"))
    keys = signed.select("tbl", "h1", "h2", "key").join(one, ["tbl", "h1", "h2"]).select("tbl", "key", node(F.col("tbl"), F.col("cls")).alias("node")).distinct()
    found = keys.join(of, "node", "left").select("tbl", "key", F.shiftright(F.coalesce("grp", "node"), 4).alias("group_id"))
    sizes = found.groupBy("tbl", "group_id").agg(F.countDistinct("key").alias("n_members"))
    return found.join(sizes, ["tbl", "group_id"]).select("tbl", "key", "group_id", "n_members")
