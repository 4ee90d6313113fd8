"""The k most similar vectors of every vector: a forest of sorted arrays of long hash strings.

Each tree hashes a vector to 64 signs of random projections and keeps all hash strings of a collection in one sorted array, so
vectors with a long common prefix lie side by side. A search descends in every tree to the longest prefixes that match, looks
at the vectors beside that place, and ascends to shorter prefixes, whose stretches of the array are longer:

* in all trees together, one bit at a time from PREFIX bits up, until the trees' stretches hold BUDGET vectors
  (the synchronous ascent; what a prefix holds is counted once, for the first PREFIX bits of each tree);
* not that far where it can't help: the k-th best similarity among the longest matches gives the depth at which any vector
  that is still better would have been met in one of the trees with probability 1 - MISS. So dense groups of near-copies
  stop at long prefixes.

The sorted arrays are cut into parts at borders of PREFIX bits. Whatever lies within a stretch is compared wherever its parts
are: a vector whose stretch reaches over a part's edge is sent to the other parts as a query. A prefix of more than MOST
vectors is cut into chunks, and every two chunks are compared as a part of their own, so that no task grows with it.
Nothing is fitted; every vector is indexed. BUDGET is the price of recall: the work is (queries x (BUDGET + what PREFIX
bits hold)), and with budget = the number of vectors the search is exact.

Equal vectors are one class: it is searched once, and its members, of which any vector needs at most the k + 1 smallest ids,
are put back at the end. Trees compare components of 16 bits (error of a cosine some 1e-5). Where two cosines of a list, or a
cosine and ``least``, are closer than CLOSE, the pair's cosine is computed again from the vectors themselves; so 16 bits
decide no rank, but in a list with more than 4 k candidates within CLOSE of the last place.

Defined results: vectors that are null, of another length, all zero, or with a null, NaN or infinite element take no part;
rows repeated under one key are one record; equal cosines (to 12 places) rank the smaller key first; fewer than k vectors or
an empty table give what there is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomquill.session import cut

DIMENSIONS, K, LEAST, TREES = 64, 10, 0.85, 10
SEED, PART_ROWS = 20240229, 100_000
PREFIX, BUDGET, MISS = 10, 2000, 0.005
#: Rows searched at once, and how many beside them are looked at before the ascent.
BLOCK, BESIDE, TILE = 256, 64, 2048
#: A prefix of more rows is cut into chunks of half as many.
MOST = 40_000
CLOSE = 4e-5
MEMBER, SECOND, QUERY = 0, 1, 2  # roles of a row in a part


def _accepted(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(2)
            full = np.asarray(pa.compute.fill_null(pa.compute.equal(pa.compute.list_value_length(lists), dimensions), False))
            kept = np.flatnonzero(full)
            if not len(kept):
                continue
            flat = lists.take(pa.array(kept)).flatten()
            v = np.array(pa.compute.fill_null(flat.cast(pa.float64()), float("nan"))).reshape(-1, dimensions)
            top = np.abs(v).max(axis=1)  # NaN and infinity pass through
            good = np.isfinite(top) & (top > 0)
            v, top, rows = v[good] + 0.0, top[good], pa.array(kept[good])
            q = np.rint(v / top[:, None] * 32767).astype("<i2")
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * dimensions), len(q), [None, pa.py_buffer(q.tobytes())]).cast(pa.binary())
            same = np.array([xxhash.xxh128_digest(x.tobytes()) for x in v], dtype="V16").view("<i8").reshape(-1, 2)
            names = ["tbl", "key", "asked", "h1", "h2", "q"]
            yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), b.column(3).take(rows), pa.array(same[:, 0].copy()), pa.array(same[:, 1].copy()), raw], names=names)

    return run


def _vectors(column: pa.Array, dimensions: int) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, dtype="<i2").reshape(-1, dimensions).astype(np.float32)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt(np.einsum("ij,ij->i", v, v, dtype=np.float64))[:, None].astype(np.float32)


class Hashes:
    """Hash strings of vectors as longs, one column for each tree."""

    def __init__(self, trees: int, dimensions: int):
        self.trees, self.dimensions = trees, dimensions
        self.planes = np.random.default_rng(SEED).standard_normal((dimensions, 64 * trees)).astype(np.float32)

    def __call__(self, v: np.ndarray) -> np.ndarray:
        bits = (v @ self.planes) > 0
        return np.packbits(bits.reshape(len(v), self.trees, 64), axis=2).view(">i8").reshape(len(v), self.trees).astype(np.int64)


def _buckets(array: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of (array, first PREFIX bits), in the order of (array, hash)."""
    return (array << PREFIX) + (hashes >> (64 - PREFIX)) + (1 << (PREFIX - 1))


def _counted(trees: int, dimensions: int):
    """(bucket, n) of (tbl, cls, asked, q)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(trees, dimensions)
        for b in batches:
            array = np.asarray(b.column(0)).astype(np.int64)[:, None] * trees + np.arange(trees)
            bucket, many = np.unique(_buckets(array, hashes(_vectors(b.column(3), dimensions))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(many)], names=["bucket", "n"])

    return run


class Parts:
    """How the forest is cut, and how many rows each prefix holds. Several buckets share a part; one of more than ``most`` rows
    is cut into chunks, with a part for each chunk and for every two of them, so that all its pairs still meet."""

    def __init__(self, buckets: np.ndarray, sizes: np.ndarray, rows: int, most: int):
        order = np.argsort(buckets)
        self.buckets, self.sizes = buckets[order], sizes[order]
        self.before = np.concatenate(([0], np.cumsum(self.sizes)))
        self.chunks = np.where(self.sizes > most, -(-2 * self.sizes // most), 1)
        self.first = np.zeros(len(sizes), dtype=np.int64)
        at, filled = -1, rows
        own: list[int] = []  # the parts in which rows are members, in order
        self.own_first, self.own_last = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
        for i, (n, c) in enumerate(zip(self.sizes.tolist(), self.chunks.tolist(), strict=True)):
            if c > 1:
                self.first[i] = at + 1
                self.own_first[i] = len(own)
                own += [at + 1 + h * (h + 1) // 2 + h for h in range(c)]
                at, filled = at + c * (c + 1) // 2, rows
            else:
                if filled + n > rows:
                    at, filled = at + 1, 0
                    own.append(at)
                self.first[i], filled = at, filled + n
                self.own_first[i] = len(own) - 1
            self.own_last[i] = len(own) - 1
        self.own = np.array(own, dtype=np.int64)
        self.count = at + 1

    def under(self, bucket: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of places in ``buckets`` of what has the first ``bits`` bits in common with each bucket."""
        wide = np.int64(1) << (PREFIX - bits)
        low = bucket // wide * wide
        return np.searchsorted(self.buckets, low), np.searchsorted(self.buckets, low + wide)

    def levels(self, buckets: np.ndarray, budget: int) -> np.ndarray:
        """The synchronous ascent: for rows of (rows x trees) buckets the most bits, PREFIX at most, of which the trees
        together hold ``budget`` rows; 0 if there are fewer."""
        level = np.zeros(len(buckets), dtype=np.int64)
        for bits in range(1, PREFIX + 1):
            low, high = self.under(buckets, np.int64(bits))
            level[(self.before[high] - self.before[low]).sum(axis=1) >= budget] = bits
        return level

    def members(self, bucket: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, part, role): rows of a cut bucket come once for each of its chunks."""
        i = np.searchsorted(self.buckets, bucket)
        first, chunks = self.first[i], self.chunks[i]
        row = np.repeat(np.arange(len(bucket)), chunks)
        other = np.arange(len(row)) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        mixed = cls.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        own = ((mixed >> np.uint64(33)) % chunks.astype(np.uint64)).astype(np.int64)[row]
        low, high = np.minimum(own, other), np.maximum(own, other)
        return row, first[row] + high * (high + 1) // 2 + low, np.where(own > other, SECOND, MEMBER)

    def beyond(self, bucket: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, part): the parts besides its own that a row's stretch of ``level`` bits reaches."""
        wide = np.flatnonzero((level >= 0) & (level < PREFIX))
        low, high = self.under(bucket[wide], level[wide])
        first, last = self.own_first[low], self.own_last[high - 1]
        many = last - first + 1
        row = np.repeat(wide, many)
        part = self.own[np.repeat(first - np.cumsum(many) + many, many) + np.arange(int(many.sum()))]
        away = part != self.first[np.searchsorted(self.buckets, bucket)][row]
        return row[away], part[away]


class Trees:
    """Rows of the forest: (part, role, array, hash, cls, level, q); ``array`` is the number of a collection's tree, ``level``
    how far the row ascends, -1 if it isn't asked."""

    def __init__(self, trees: int, dimensions: int, parts, budget: int):
        self.trees, self.dimensions, self.parts, self.budget = trees, dimensions, parts, budget

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, parts = Hashes(self.trees, self.dimensions), self.parts.value
        for b in batches:
            packed = hashes(_vectors(b.column(3), self.dimensions))
            array = np.asarray(b.column(0)).astype(np.int64)[:, None] * self.trees + np.arange(self.trees)
            buckets, cls = _buckets(array, packed), np.asarray(b.column(1))
            level = np.where(np.asarray(b.column(2)), parts.levels(buckets, self.budget), -1)
            for t in range(self.trees):
                row, part, role = parts.members(buckets[:, t], cls)
                other, away = parts.beyond(buckets[:, t], level)
                row, part, role = np.concatenate((row, other)), np.concatenate((part, away)), np.concatenate((role, np.full(len(other), QUERY)))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(role.astype(np.int8)), pa.array(array[row, t].astype(np.int32)), pa.array(packed[row, t]), b.column(1).take(at), pa.array(level[row].astype(np.int8)), b.column(3).take(at)], names=["part", "role", "array", "hash", "cls", "level", "q"])


def depth(cosine: np.ndarray, trees: int, miss: float = MISS) -> np.ndarray:
    """The most bits at which vectors of a similarity share a prefix in one of the trees with probability 1 - ``miss``."""
    same = 1 - np.arccos(np.clip(cosine, -1.0, 1.0)) / math.pi  # that one bit is equal
    met = 1 - miss ** (1 / trees)
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(np.log(met) / np.log(np.clip(same, 1e-9, 1 - 1e-9))), 0, 64).astype(np.int64)


class Search:
    """Reads the sorted parts of the forest and gives the pairs in which one is among the k best of the other."""

    def __init__(self, k: int, least: float, dimensions: int, trees: int, block: int = BLOCK):
        self.k, self.least, self.dimensions, self.trees, self.block = k, least, dimensions, trees, block

    def arrays(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        """(role, array, hash, cls, level, unit vector) of each array's piece in a part."""
        held: list[tuple[np.ndarray, ...]] = []
        last = None
        for b in batches:
            part, array = np.asarray(b.column(0)).astype(np.int64), np.asarray(b.column(2)).astype(np.int64)
            columns = (*(np.asarray(b.column(i)) for i in (1, 2, 3, 4, 5)), _unit(_vectors(b.column(6), self.dimensions)))
            piece = (part << 32) + array
            for x in np.split(np.arange(len(b)), np.flatnonzero(np.diff(piece)) + 1):
                if not len(x):
                    continue
                if held and piece[x[0]] != last:
                    yield tuple(np.concatenate(c) for c in zip(*held, strict=True))
                    held = []
                last = piece[x[0]]
                held.append(tuple(c[x[0] : x[-1] + 1] for c in columns))
        if held:
            yield tuple(np.concatenate(c) for c in zip(*held, strict=True))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for role, array, *rest in self.arrays(batches):
            asked = rest[2] >= 0
            if (role == SECOND).any():  # two chunks of a bucket: only what is between them
                sides = [(role == MEMBER, role == SECOND), (role == SECOND, role == MEMBER)]
            else:
                sides = [(role != SECOND, role == MEMBER)]
            for mine, around in sides:
                m, a = np.flatnonzero(mine & asked), np.flatnonzero(around)
                for at in range(0, len(m) if len(a) else 0, self.block):
                    found = self.searched([x[m[at : at + self.block]] for x in rest], [x[a] for x in rest] if at == 0 else None)
                    if found is not None:
                        cls, other, cos = found
                        tbl = np.full(len(cls), array[0] // self.trees, dtype=np.int32)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (tbl, cls, other, cos)], names=["tbl", "a", "b", "cos"])

    def searched(self, mine: list[np.ndarray], around: list[np.ndarray] | None) -> tuple[np.ndarray, ...] | None:
        """(smaller class, larger class, cosine) of the best around a block of rows; ``around`` is kept for the next blocks."""
        if around is not None:
            self.around = around
        hashes, cls, floor, v = mine
        where, others, _, w = self.around
        # the descent: what is beside the places of the longest matches
        place = np.searchsorted(where, hashes)
        low, high = max(0, int(place.min()) - BESIDE), min(len(where), int(place.max()) + BESIDE)
        s = v @ w[low:high].T
        s[cls[:, None] == others[None, low:high]] = -2
        kth = np.full(len(v), self.least, dtype=np.float32)
        if high - low > self.k:
            kth = np.maximum(kth, np.partition(s, -self.k, axis=1)[:, -self.k])
        # the ascent
        bits = np.maximum(depth(kth.astype(np.float64), self.trees), floor)
        free = np.minimum(64 - bits, 63)
        start = np.where(bits == 0, np.iinfo(np.int64).min, hashes >> free << free)
        end = np.where(bits == 0, np.iinfo(np.int64).max, start + ((np.int64(1) << free) - 1))
        left, right = int(np.searchsorted(where, start.min())), int(np.searchsorted(where, end.max(), "right"))
        found = self.near(s, kth, low)
        for a, b in ((left, min(low, right)), (max(high, left), right)):
            for at in range(a, b, TILE):
                to = min(at + TILE, b)
                tile = v @ w[at:to].T
                tile[cls[:, None] == others[None, at:to]] = -2
                if to - at > self.k and np.count_nonzero(tile >= kth[:, None] - CLOSE) > 4 * self.k * len(v):
                    kth = np.maximum(kth, np.partition(tile, -self.k, axis=1)[:, -self.k])
                found = [np.concatenate(x) for x in zip(found, self.near(tile, kth, at), strict=True)]
        row, col, cos = found
        if not len(row):
            return None
        other = others[col]
        order = np.lexsort((other, -cos, row))
        row, other, cos = row[order], other[order], cos[order]
        starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        size = np.diff(np.append(starts, len(row)))
        rank = np.arange(len(row)) - np.repeat(starts, size)
        last = np.repeat(cos[starts + np.minimum(size, self.k) - 1], size)
        kept = (rank < self.k) | (cos >= last - CLOSE) & (rank < 4 * self.k)
        row, other, cos = row[kept], other[kept], cos[kept]
        a, b = np.minimum(cls[row], other), np.maximum(cls[row], other)
        _, once = np.unique(np.stack([a, b]), axis=1, return_index=True)
        return a[once], b[once], cos[once]

    @staticmethod
    def near(s: np.ndarray, kth: np.ndarray, at: int) -> list[np.ndarray]:
        """(row, place, cosine) of what is as similar as the k-th best so far, or as good as that."""
        row, col = np.divmod(np.flatnonzero(s >= kth[:, None] - CLOSE), s.shape[1])
        return [row, col + at, s[row, col]]


def classes(vectors: DataFrame, dimensions: int = DIMENSIONS, asked: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """One row (tbl, cls, many, asked, q) per distinct vector, cls its smallest key; and (tbl, cls, key) where it has more
    members. ``vectors``: (tbl INT, key BIGINT, vector ARRAY<FLOAT>)."""
    given = vectors.where(F.col("key").isNotNull() & F.col("vector").isNotNull())
    given = given.select("tbl", "key", "vector", (F.lit(True) if asked is None else F.coalesce(asked, F.lit(False))).alias("asked"))
    rows = cut(given.mapInArrow(_accepted(dimensions), "tbl int, key long, asked boolean, h1 long, h2 long, q binary"))
    same = F.max("q").alias("q")  # equal in a class
    one = rows.groupBy("tbl", "h1", "h2").agg(F.min("key").alias("cls"), (F.min("key") < F.max("key")).alias("many"), F.max("asked").alias("asked"), same)
    several = one.where("many").select("tbl", "h1", "h2", "cls")
    return one.select("tbl", "cls", "many", "asked", "q"), rows.join(several, ["tbl", "h1", "h2"]).select("tbl", "cls", "key").distinct()


def forest_pairs(one: DataFrame, k: int = K, least: float = LEAST, trees: int = TREES, budget: int = BUDGET, dimensions: int = DIMENSIONS) -> DataFrame:
    """(tbl, a, b, cos) with a < b: class pairs that the forest finds, from (tbl, cls, asked, q)."""
    forest = one.select("tbl", "cls", "asked", "q")
    # one row for each of trees * 2**PREFIX buckets a collection, however many vectors there are
    counted = forest.mapInArrow(_counted(trees, dimensions), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    sizes = counted["n"].to_numpy(dtype=np.int64)
    # as many parts as keep PART_ROWS each (some 30 MB), however many vectors there are
    spark = one.sparkSession
    least_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    parts = Parts(counted["bucket"].to_numpy(dtype=np.int64), sizes, min(PART_ROWS, -(-int(sizes.sum()) // least_parts)), MOST)
    shared = spark.sparkContext.broadcast(parts)
    grown = forest.mapInArrow(Trees(trees, dimensions, shared, budget), "part int, role tinyint, array int, hash long, cls long, level tinyint, q binary")
    arrays = grown.repartitionById(max(parts.count, 1), "part").sortWithinPartitions("part", "array", "hash", "cls")
    found = arrays.mapInArrow(Search(k, least, dimensions, trees, BLOCK), "tbl int, a long, b long, cos float")
    return found.groupBy("tbl", "a", "b").agg(F.max("cos").alias("cos"))


@F.pandas_udf(T.DoubleType())
def exact_cosine(x: pd.Series, y: pd.Series) -> pd.Series:
    if not len(x):
        return pd.Series([], dtype=np.float64)
    a, b = (np.stack(v.to_numpy()).astype(np.float64) for v in (x, y))
    a, b = (v / np.abs(v).max(axis=1, keepdims=True) for v in (a, b))
    return pd.Series(np.round(np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b)), 12))


def decided(directed: DataFrame, vectors: DataFrame, k: int, least: float, every: bool = False) -> DataFrame:
    """(tbl, cls, other, cos) of those among the k best (and equals of the k-th) of each class. Cosines are the given ones of
    16 bits, but where these are too close to tell, or with ``every``, they are computed again."""
    ranked = Window.partitionBy("tbl", "cls").orderBy(F.desc("cos"), "other")
    of = Window.partitionBy("tbl", "cls")
    rows = directed.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= 4 * k)
    rows = rows.withColumn("kth", F.min(F.when(F.col("rank") <= k, F.col("cos"))).over(of)).where(F.col("cos") >= F.col("kth") - CLOSE)
    gap = lambda c: F.coalesce(F.abs(c - F.col("cos")) < CLOSE, F.lit(False))
    rows = cut(rows.withColumn("open", F.lit(every) | gap(F.lag("cos").over(ranked)) | gap(F.lead("cos").over(ranked)) | gap(F.lit(least))).drop("rank", "kth"))
    again = rows.where("open").select("tbl", F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()
    wanted = again.select("tbl", F.explode(F.array("a", "b")).alias("key")).distinct()
    known = vectors.select("tbl", "key", "vector").join(wanted, ["tbl", "key"], "left_semi").groupBy("tbl", "key").agg(F.max("vector").alias("vector"))
    left, right = (known.select("tbl", F.col("key").alias(x), F.col("vector").alias(f"v{x}")) for x in "ab")
    exact = again.join(left, ["tbl", "a"]).join(right, ["tbl", "b"]).select("tbl", "a", "b", exact_cosine("va", "vb").alias("exact"))
    both = F.explode(F.array(F.struct(F.col("a").alias("cls"), F.col("b").alias("other")), F.struct(F.col("b").alias("cls"), F.col("a").alias("other"))))
    of_pair = exact.select("tbl", "exact", both.alias("x")).select("tbl", "x.cls", "x.other", "exact")
    sure = rows.where(~F.col("open")).select("tbl", "cls", "other", F.col("cos").cast("double").alias("cos"))
    computed = rows.where("open").join(of_pair, ["tbl", "cls", "other"]).select("tbl", "cls", "other", F.col("exact").alias("cos"))
    return sure.unionByName(computed).where(F.col("cos") >= least)


def nearest(vectors: DataFrame, k: int = K, least: float = LEAST, trees: int = TREES, budget: int = BUDGET, dimensions: int = DIMENSIONS, asked: Column | None = None) -> DataFrame:
    """(tbl, key, other, cos, rank): up to ``k`` most similar other vectors of each vector, or of those for which ``asked``
    is true, with a cosine of ``least`` or more (-1: all k, whatever their cosines)."""
    one, members = classes(vectors, dimensions, asked)
    one, members = cut(one), cut(members)
    pairs = forest_pairs(one, k, least, trees, budget, dimensions)
    both = F.explode(F.array(F.struct(F.col("a").alias("cls"), F.col("b").alias("other")), F.struct(F.col("b").alias("cls"), F.col("a").alias("other"))))
    directed = pairs.select("tbl", "cos", both.alias("x")).select("tbl", "x.cls", "x.other", "cos")
    if asked is not None:
        directed = directed.join(one.where("asked").select("tbl", "cls"), ["tbl", "cls"], "left_semi")
    directed = decided(directed, vectors, k, least, asked is not None).withColumnRenamed("other", "other_cls")
    # the smallest k + 1 members of a class are all that any vector can have among its k best
    first = members.withColumn("n", F.row_number().over(Window.partitionBy("tbl", "cls").orderBy("key"))).where(F.col("n") <= k + 1).drop("n")
    # one's own class at cosine 1, then the members of the classes beside it
    own = first.select("tbl", "cls", F.col("key").alias("other"), F.lit(1.0).alias("cos"))
    beside = directed.join(first.select("tbl", F.col("cls").alias("other_cls"), "key"), ["tbl", "other_cls"], "left").select("tbl", "cls", F.coalesce("key", "other_cls").alias("other"), "cos")
    wider = own.unionByName(beside)
    # every member of a class has the same list, but for itself
    ranked = Window.partitionBy("tbl", "cls").orderBy(F.desc("cos"), "other")
    lists = wider.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k + 1).drop("rank")
    everyone = one.where(~F.col("many")).select("tbl", "cls", F.col("cls").alias("key")).unionByName(members)
    if asked is not None:
        everyone = everyone.where(asked)
    expanded = lists.join(everyone, ["tbl", "cls"]).select("tbl", "key", "other", "cos").where("key != other")
    last = Window.partitionBy("tbl", "key").orderBy(F.desc("cos"), "other")
    return expanded.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
