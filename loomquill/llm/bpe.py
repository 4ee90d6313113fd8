"""Encoding and decoding a corpus with a public byte-level BPE vocabulary, by recursive queries in DuckDB.

In each partition the distinct words that are not known yet become rows (word, position, token). A recursive query joins
neighbouring tokens with the merge table and contracts each word's leftmost pair of least rank until no pair is left; an
ordered aggregation gives the ids. Decoding joins the ids with the vocabulary and aggregates their bytes in order. The
merge table (50,000 rows) is broadcast: its size is that of the vocabulary file, whatever the corpus.

A word of more than SEGMENT bytes (an unbroken run of letters, signs or blanks) is contracted in overlapping segments, all
of them words of the same query, so that the steps of the recursion depend on the segment and not on the word. Ids are those
of the whole word if each two neighbouring ones are those of their two strings put together: merges inside two tokens go on
without regard to what is further off, so a border that holds in the pair holds in the word. Two segments are therefore
joined at a token that both have in their overlap; two without such a token are contracted again as one.

Defined results: an empty and a null text both give an empty list; a blank text is encoded as it is; strings of special
tokens are ordinary text; one row per input row. Nothing is lower-cased, normalised or cut.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: Fixed value: the public pattern that cuts text into words before merging.
PATTERN = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Words in one recursive query have so many bytes together, and a worker remembers so many words.
QUERY_BYTES, REMEMBERED = 200_000, 400_000

#: Words of more bytes than this contract all equal pairs at once, from the left; others are done in a few steps anyway.
LONG = 48
#: Longer words are contracted in segments of so many bytes, of which so many are in the next one too.
SEGMENT, OVERLAP = 96, 32

CONTRACT = """
WITH RECURSIVE state(word, pos, tok) USING KEY (word, pos) AS (
    SELECT word, pos, tok FROM start
    UNION ALL
    SELECT word, pos, CASE WHEN taken THEN new WHEN lag(taken, 1, false) OVER w THEN NULL ELSE tok END
    FROM (
        SELECT word, pos, tok, new, best, coalesce(rank = best AND NOT lag(rank = best, 1, false) OVER w, false) AS taken
        FROM (
            SELECT word, pos, tok, new, coalesce(rank, -1) AS rank, min(rank) OVER (PARTITION BY word) AS best
            FROM (
                SELECT word, pos, tok, tok * 65536 + lead(tok) OVER (PARTITION BY word ORDER BY pos) AS pair FROM state WHERE tok IS NOT NULL
            ) AS pairs LEFT JOIN merges USING (pair)
        ) AS ranked
        WHERE best IS NOT NULL
        WINDOW w AS (PARTITION BY word ORDER BY pos)
    ) AS chosen
    WINDOW w AS (PARTITION BY word ORDER BY pos)
)
SELECT word, list(tok ORDER BY pos) AS ids FROM state WHERE tok IS NOT NULL GROUP BY word ORDER BY word
"""
#: The leftmost pair of least rank, and at once those that follow it one after the other: every second of a stretch.
FIRST = "coalesce(rank = best AND NOT lag(rank = best, 1, false) OVER w, false)"
EVERY = "coalesce(rank = best AND (row_number() OVER w - max(CASE WHEN rank = best THEN 0 ELSE nth END) OVER (PARTITION BY word ORDER BY pos)) % 2 = 1, false)"
CONTRACT_LONG = CONTRACT.replace(FIRST, EVERY).replace("coalesce(rank, -1) AS rank,", "coalesce(rank, -1) AS rank, row_number() OVER (PARTITION BY word ORDER BY pos) AS nth,")
assert CONTRACT_LONG.count("nth") == 2


def byte_names() -> list[str]:
    """The character that stands for each byte in the vocabulary file: printable ones for themselves, the rest from 256."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def read_vocabulary(path: str) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Ids of the 256 bytes; rows (pair, rank, new id) of the merge table; the bytes of every id."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    ids, names = model["vocab"], byte_names()
    first = np.array([ids[c] for c in names], dtype=np.int64)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = np.array([(ids[a] * 65536 + ids[b], k, ids[a + b]) for k, (a, b) in enumerate(pairs)], dtype=np.int64).reshape(-1, 3)
    of = {c: b for b, c in enumerate(names)}
    known = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        known[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return first, merges, known


def _connect() -> duckdb.DuckDBPyConnection:
    con = duckdb.connect(":memory:")
    con.execute("SET threads = 1")
    con.execute("SET memory_limit = '400MB'")
    con.execute("SET temp_directory = ''")  # queries are small; nothing may go to a local folder
    return con


class Encoder:
    """Encodes batches of texts; ``parts`` is the broadcast (ids of bytes, merge table, bytes of each id)."""

    def __init__(self, parts):
        self.parts = parts

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self.first, merges, self.sizes = self.parts.value
        self.con = _connect()
        self.con.register("merge_rows", pa.table({"pair": merges[:, 0], "rank": merges[:, 1], "new": merges[:, 2]}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        self.known: dict[str, list[int]] = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 1000):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 1000), self.encode(texts[at : at + 1000])], names=["key", "ids"])

    def encode(self, texts: list[str | None]) -> pa.Array:
        cut = [PATTERN.findall(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {}
        new = {w: None for words in cut for w in words if w not in self.known}
        group: list[str] = []
        size = 0
        for w in sorted(new, key=len):  # the long ones together
            if group and len(w) * 4 > LONG >= len(group[-1]) * 4:
                self.learn(group)
                group, size = [], 0
            group.append(w)
            size += len(w)
            if size > QUERY_BYTES // 2:
                self.learn(group)
                group, size = [], 0
        if group:
            self.learn(group)
        flat: list[int] = []
        ends = [0]
        known = self.known
        for words in cut:
            for w in words:
                flat += known[w]
            ends.append(len(flat))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    def learn(self, words: list[str]) -> None:
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        short = [i for i, r in enumerate(raw) if len(r) <= SEGMENT]
        for i, ids in zip(short, self.contract([raw[i] for i in short]), strict=True):
            self.known[words[i]] = ids
        for i, r in enumerate(raw):
            if len(r) > SEGMENT:
                self.known[words[i]] = self.joined(r)

    def joined(self, raw: bytes) -> list[int]:
        """Ids of a long word from those of its segments."""
        step = SEGMENT - OVERLAP
        spans = [(a, min(a + SEGMENT, len(raw))) for a in range(0, max(1, len(raw) - OVERLAP), step)]
        done: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        while True:
            new, size = [], 0
            for s in [x for x in spans if x not in done]:
                new.append(s)
                size += s[1] - s[0]
                if size > QUERY_BYTES:
                    self.segments(raw, new, done)
                    new, size = [], 0
            if new:
                self.segments(raw, new, done)
            joints = [self.joint(done[a], done[b]) for a, b in zip(spans, spans[1:], strict=False)]
            if None not in joints:
                break
            wider: list[tuple[int, int]] = []  # segments that share no token become one, two by two
            i = 0
            while i < len(spans):
                apart = i < len(joints) and joints[i] is None
                wider.append((spans[i][0], spans[i + 1][1]) if apart else spans[i])
                i += 1 + apart
            spans = wider
        out: list[np.ndarray] = []
        at = 0
        for s, (ids, ends) in zip(spans, (done[s] for s in spans), strict=True):
            # from the end of the last joint on, up to the next one
            to = joints[len(out)] if len(out) < len(joints) else ends[-1]
            out.append(ids[(ends > at) & (ends <= to)])
            at = to
        return np.concatenate(out).tolist()

    @staticmethod
    def joint(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> int | None:
        """Where a token ends that two segments have in common: in both, the ids before and at that place are the same."""
        _, i, j = np.intersect1d(left[1], right[1], assume_unique=True, return_indices=True)
        same = np.flatnonzero(left[0][i] == right[0][j])  # one id that ends at one place: it begins at one place too
        return int(left[1][i[same[len(same) // 2]]]) if len(same) else None

    def segments(self, raw: bytes, spans: list[tuple[int, int]], done: dict) -> None:
        """Adds (ids, places where they end in the word) of segments to ``done``."""
        for (a, b), ids in zip(spans, self.contract([raw[a:b] for a, b in spans]), strict=True):
            ids = np.array(ids, dtype=np.int64)
            done[a, b] = ids, a + np.cumsum(self.sizes[ids])

    def contract(self, raw: list[bytes]) -> list[list[int]]:
        """Ids of byte strings that are words of their own."""
        if not raw:
            return []
        sizes = np.array([len(r) for r in raw])
        starts = np.cumsum(sizes) - sizes
        tokens = self.first[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        rows = pa.table({"word": np.repeat(np.arange(len(raw), dtype=np.int32), sizes), "pos": (np.arange(len(tokens)) - np.repeat(starts, sizes)).astype(np.int32), "tok": tokens})
        self.con.register("start", rows)
        query = CONTRACT_LONG if sizes.max() > LONG else CONTRACT
        ids = [r[1] for r in self.con.execute(query).fetchall()]
        self.con.unregister("start")
        return ids


def encode(texts: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, ids ARRAY<INT>) without special tokens, one row per row of ``texts``."""
    first, merges, known = read_vocabulary(vocabulary)
    parts = texts.sparkSession.sparkContext.broadcast((first, merges, np.array([len(b) for b in known])))
    kind = texts.schema[key].dataType.simpleString()
    return texts.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(Encoder(parts), f"key {kind}, ids array<int>").withColumnRenamed("key", key)


class Decoder:
    def __init__(self, known):
        self.known = known

    def __call__(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        con = _connect()
        known = self.known.value
        con.register("vocabulary", pa.table({"id": np.arange(len(known)), "bytes": pa.array(known, pa.binary())}))
        for f in frames:
            for at in range(0, len(f), 200):
                part = f.iloc[at : at + 200]
                sizes = [0 if x is None else len(x) for x in part["ids"]]
                con.register("rows", pa.table({"doc": np.repeat(np.arange(len(part)), sizes), "pos": np.arange(sum(sizes)), "id": np.concatenate([np.asarray(x, dtype=np.int64) for x in part["ids"] if x is not None] or [np.zeros(0, np.int64)])}))
                parts = dict(con.execute("SELECT doc, list(bytes ORDER BY pos) FROM rows JOIN vocabulary USING (id) GROUP BY doc").fetchall())
                yield pd.DataFrame({"key": part["key"].to_numpy(), "text": [b"".join(parts.get(i, [])).decode("utf-8", "replace") for i in range(len(part))]})


def decode(encoded: DataFrame, key: str, ids: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, text) from (key, ids); an empty or null list gives an empty text."""
    known = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary)[2])
    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids")).mapInPandas(Decoder(known), f"key {kind}, text string").withColumnRenamed("key", key)
