"""Repetition inside single texts, measured and then judged by weak supervision.

Each text gets the share of its words that lie in a repeated run of three words, and further measures. Rules turn them
into votes (repetitive, fine, or abstain where the measure says little); expectation-maximisation over the counts of vote
patterns estimates without any labels how often each rule is right in either class; each text then gets the posterior
probability of being repetitive, and that alone decides. No rule has a veto: one that is wrong is outvoted by others that
proved accurate. The number of patterns is at most 3 ** len(RULES), so the driver's part stays bounded whatever the number of
texts.

Defined results: null, empty and wordless texts have share 0 and abstain in every rule; where all rules abstain the posterior
is null and the text isn't judged repetitive; rows without a key are
ignored; rows repeated under one key are one record; texts of any length are measured whole, a batch at a time, in
linear time and a sort.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomquill.session import cut

WORD = re.compile(r"[^\W_]+")
PIECE = re.compile(r"[.!?]\s+|\n")
RUN = 3
RULES = ("run_share", "distinct_share", "longest_loop", "top_run", "top_word", "piece_share")
PERIODS = (1, 2, 3, 4, 6, 8, 12)
#: For each rule the two bounds between which it abstains: it votes 1 (repetitive) on one side and 0 (fine) on the other.
#: A bound of None means that the rule never casts that vote.
BOUNDS = {"run_share": (0.25, 0.4), "distinct_share": (0.6, 0.5), "longest_loop": (None, 0.3), "top_run": (0.0, 0.3), "top_word": (0.08, 0.3), "piece_share": (None, 0.5)}
#: Texts of fewer words have no runs to repeat: every rule abstains.
LEAST_WORDS = 3
WORDS_AT_ONCE = 400_000


def _again(doc: np.ndarray, key: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of keys in texts: which were there earlier in the same text; per text the number of distinct ones, and the count of
    the most frequent."""
    wide = int(key.max(initial=0)) + 1
    pair, first, counts = np.unique(doc * wide + key, return_index=True, return_counts=True)
    seen = np.ones(len(key), dtype=bool)
    seen[first] = False
    top = np.zeros(texts, dtype=np.int64)
    np.maximum.at(top, pair // wide, counts)
    return seen, np.bincount(pair // wide, minlength=texts), top


def measures(texts: list[str | None]) -> pd.DataFrame:
    """n_words and one column for each of RULES: the share of words in repeated runs, of distinct words, of the longest
    stretch that repeats itself a few words on, of the runs equal to the most frequent one, of the most frequent word, and
    of sentences or lines that were there before."""
    words = [WORD.findall(t.lower()) if t else [] for t in texts]
    size = np.array([len(w) for w in words], dtype=np.int64)
    codes = pd.factorize(np.array([x for w in words for x in w], dtype=object))[0].astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), size)
    n, most = len(codes), np.maximum(size, 1)
    _, distinct, top_word = _again(doc, codes, len(texts))
    # runs, numbered anew after each word so that numbers stay small
    key, wide = codes, int(codes.max(initial=0)) + 1
    for i in range(1, RUN):
        key = np.unique(key[: max(0, n - i)] * wide + codes[i:], return_inverse=True)[1]
    at = np.flatnonzero(doc[: max(0, n - RUN + 1)] == doc[RUN - 1 :])
    seen, _, top_run = _again(doc[at], key[at], len(texts))
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[: len(doc)] += np.bincount(at[seen], minlength=n)[:n] if n else 0
    edge += np.bincount(at[seen] + RUN, minlength=n + 1)[: n + 1] * -1
    covered = np.bincount(doc[np.cumsum(edge[:n]) > 0], minlength=len(texts))
    loop = np.zeros(len(texts), dtype=np.int64)
    for period in PERIODS:
        if n > period:
            same = np.concatenate(([0], ((codes[period:] == codes[:-period]) & (doc[period:] == doc[:-period])).astype(np.int8), [0]))
            turns = np.flatnonzero(np.diff(same))
            np.maximum.at(loop, doc[turns[::2] + period], turns[1::2] - turns[::2])
    pieces = [[p.strip() for p in PIECE.split(t) if p.strip()] if t else [] for t in texts]
    return pd.DataFrame({
        "n_words": size,
        "run_share": covered / most,
        "distinct_share": np.where(size > 0, distinct / most, 1.0),
        "longest_loop": loop / most,
        "top_run": np.maximum(top_run - 1, 0) * RUN / most,
        "top_word": top_word / most,
        "piece_share": [1 - len(set(p)) / len(p) if p else 0.0 for p in pieces],
    })


def _measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        at = 0
        while at < len(f):  # as many texts as make some bounded number of words, one at least
            end, held = at + 1, len(f["text"].iat[at] or "")
            while end < len(f) and held < 4 * WORDS_AT_ONCE:
                held += len(f["text"].iat[end] or "")
                end += 1
            part = f.iloc[at:end]
            yield pd.concat([part[["key", "attr"]].reset_index(drop=True), measures(part["text"].tolist())], axis=1)
            at = end


def measured(texts: DataFrame) -> DataFrame:
    """(key, attr, n_words, one column for each of RULES) from (key, attr, text)."""
    return texts.where(F.col("key").isNotNull()).select("key", "attr", "text").mapInPandas(_measure, "key long, attr string, n_words long, " + ", ".join(f"{r} double" for r in RULES))


def votes(m: DataFrame) -> DataFrame:
    """Adds ``votes``: a string with one of 1, 0 and - for each of RULES."""

    def vote(r: str) -> F.Column:
        fine, repetitive = BOUNDS[r]
        c, v = F.col(r), F.lit(None)
        falls = fine is not None and fine > repetitive
        v = F.when(c <= repetitive if falls else c >= repetitive, "1")
        if fine is not None:
            v = v.when(c >= fine if falls else c <= fine, "0")
        return F.when(F.col("n_words") < LEAST_WORDS, "-").otherwise(F.coalesce(v, F.lit("-")))

    return m.withColumn("votes", F.concat(*[vote(r) for r in RULES]))


def posterior(patterns: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """Probability of being repetitive for each pattern of votes, by expectation-maximisation with abstentions.

    Given the class, rules are taken as independent. All start at the same accuracy of 0.8, with the weight of two texts, and
    are then what the texts make them; a rule is never taken to be worse than chance, so that the two classes can't change
    places. A pattern without any vote has no posterior: nothing is known of its texts.
    """
    patterns = {p: n for p, n in patterns.items() if p.strip("-")}
    if not patterns:
        return {}
    names = sorted(patterns)
    weight = np.array([patterns[p] for p in names], dtype=float)
    v = np.array([[{"1": 1, "0": 0}.get(c, -1) for c in p] for p in names])
    right = np.full((2, v.shape[1]), 0.8)  # by class: fine, repetitive
    prior = 0.2
    for _ in range(rounds):
        log = np.log([1 - prior, prior])[:, None] + np.stack([np.where(v < 0, 0.0, np.log(np.where(v == k, right[k], 1 - right[k]))).sum(1) for k in (0, 1)])
        p = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        prior = float(np.clip((weight * p).sum() / weight.sum(), 1e-4, 0.5))
        for k, q in ((0, 1 - p), (1, p)):
            spoke = (v >= 0) * (weight * q)[:, None]
            agreed = (v == k) * (weight * q)[:, None]
            right[k] = np.clip((agreed.sum(0) + 1.6) / (spoke.sum(0) + 2), 0.5, 0.999)
    return dict(zip(names, p.tolist(), strict=True))


def judged(texts: DataFrame, rounds: int = 100) -> DataFrame:
    """(key, attr, n_words, measures, votes, posterior) from (key, attr, text)."""
    scored = cut(votes(measured(texts)))  # measured once: the patterns are counted and the rows are read again
    counted = {r["votes"]: r["count"] for r in scored.groupBy("votes").count().collect()}  # at most 3 ** len(RULES) rows
    table = posterior(counted, rounds)
    if not table:
        return scored.withColumn("posterior", F.lit(None).cast("double"))
    pairs = F.create_map(*[x for k, p in sorted(table.items()) for x in (F.lit(k), F.lit(float(p)))])
    return scored.withColumn("posterior", F.try_element_at(pairs, F.col("votes")))


def repetitive(texts: DataFrame, least: float = 0.5) -> DataFrame:
    """(key, attr) of the texts whose posterior probability of being repetitive is ``least`` or more."""
    return judged(texts).where(F.col("posterior") >= least).select("key", "attr").distinct()
