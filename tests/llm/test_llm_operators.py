"""Each operator on small fixtures against brute force, round trips and the defined results of odd inputs."""

import random
import re
import time
from functools import lru_cache

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomquill.llm import bpe, language, leak, markup, neardup, neighbours, ocr, repetition, split, survivor
from loomquill.schema import META_DDL

WORD = re.compile(r"[^\W_]+")


def rows(df):
    return {tuple(r) for r in df.collect()}


# --- near-duplicates -------------------------------------------------------------------------------------------------


def runs_of(text, n):
    w = WORD.findall((text or "").lower())
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def alike(a, b, n):
    x, y = runs_of(a, n), runs_of(b, n)
    return len(x & y) / len(x | y) if x | y else 0


def near_texts(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(80)]
        out.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(80)] = rng.choice(vocabulary)
            out.append(" ".join(copy))
    return out


def test_near_duplicates_against_brute_force(spark):
    texts = near_texts()
    table = [(0, i, t) for i, t in enumerate(texts)]
    table += [(0, 5, texts[5]), (1, 1, texts[0]), (0, 900, None), (0, 901, ""), (0, 902, "two words"), (None, None, "x y z")]
    df = spark.createDataFrame([(*r, "clash") for r in table if r[0] is not None], "tbl int, key long, text string, cls string")
    got = rows(neardup.alike_pairs(df, 0.6, 3))
    want = {(0, i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if alike(texts[i], texts[j], 3) >= 0.6}
    assert got <= want
    assert len(got) >= 0.98 * len(want)


def grouped(texts, least, n):
    """Smallest place of each text's connected component, by comparing all pairs."""
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if alike(texts[i], texts[j], n) >= least:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(len(texts))}


def chain_texts(rng, n=30):
    """Texts of which each is alike to the next only."""
    words = [f"c{rng.randrange(10**6)}" for _ in range(60 + 4 * n)]
    return [" ".join(words[4 * i : 4 * i + 60]) for i in range(n)]


@pytest.mark.parametrize("short", [neardup.LIST_SHORT, 3])
def test_groups_against_brute_force(spark, monkeypatch, short):
    monkeypatch.setattr(neardup, "LIST_SHORT", short)  # 3: nearly all lists are stars first
    texts = near_texts(4) + chain_texts(random.Random(9))
    odd = [(0, 900, None), (0, 901, "too few words"), (1, 0, texts[0]), (0, 1, texts[1]), (0, 902, texts[0].upper())]
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)] + odd, "tbl int, key long, text string").withColumn("node", F.lit("clash"))
    got = rows(neardup.groups(df))
    want = grouped(texts, 0.8, 5)
    size = {g: sum(x == g for x in want.values()) + (g == want[0]) for g in want.values()}
    assert got == {(0, i, g, size[g]) for i, g in want.items()} | {(0, 902, want[0], size[want[0]]), (1, 0, 0, 1)}
    assert neardup.groups(df.limit(0)).count() == 0


def test_a_large_family_is_compared_in_rows_that_grow_with_it(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"t{i}" for i in range(120)]
    texts = []
    for i in range(2000):
        copy = list(base)
        copy[rng.randrange(120)] = f"v{i}"
        texts.append(" ".join(copy))
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "tbl int, key long, text string")
    seen, compare = [], neardup.compared
    monkeypatch.setattr(neardup, "compared", lambda t, pairs, *rest: (seen.append(pairs.count()), compare(t, pairs, *rest))[1])
    assert {r["group_id"] for r in neardup.groups(df).collect()} == {0}
    assert sum(seen) < 100 * len(texts)  # all pairs would be two million


def test_pairs_just_above_the_least_similarity_are_found(spark):
    rng = random.Random(8)
    table = []
    for i in range(2000):
        base = [f"w{rng.randrange(10**6)}" for _ in range(40)]
        copy = [f"x{w}" if k in (5, 18, 31) else w for k, w in enumerate(base)]
        table += [(0, 2 * i, " ".join(base)), (0, 2 * i + 1, " ".join(copy))]
    assert 0.61 < alike(table[0][2], table[1][2], 3) < 0.62
    df = spark.createDataFrame(table, "tbl int, key long, text string")
    assert len(rows(neardup.alike_pairs(df, 0.6, 3)) & {(0, 2 * i, 2 * i + 1) for i in range(2000)}) >= 1998


def test_large_class_of_copies_becomes_a_star(spark):
    df = spark.createDataFrame([(0, i, "one two three four five six seven") for i in range(30)], "tbl int, key long, text string")
    assert rows(neardup.alike_pairs(df, paired=10)) == {(0, 0, i) for i in range(1, 30)}
    assert neardup.alike_pairs(df, paired=100).count() == 30 * 29 // 2


def test_long_lists_are_joined_in_blocks(spark, monkeypatch):
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(near_texts(2))], "tbl int, key long, text string")
    before = rows(neardup.alike_pairs(df))
    monkeypatch.setattr(neardup, "LIST_BLOCK", 2)
    assert rows(neardup.alike_pairs(df)) == before


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "tbl int, key long, text string")
    assert neardup.alike_pairs(empty).count() == 0
    assert neighbours.nearest(spark.createDataFrame([], "tbl int, key long, vector array<float>")).count() == 0
    assert repetition.repetitive(spark.createDataFrame([], "key long, attr string, text string")).count() == 0
    none = spark.createDataFrame([], "id long, text string")
    assert leak.verbatim(none, none).count() == 0
    assert ocr.mended(spark.createDataFrame([], "key long, source string, text string")).count() == 0
    assert markup.structure(none, "id", "text").count() == 0
    assert bpe.encode(none, "id", "text").count() == 0
    assert split.split(none, "id", "text").count() == 0
    assert language.relabelled(none.withColumn("lang", F.lit("en"))).count() == 0


# --- vectors ---------------------------------------------------------------------------------------------------------


def test_nearest_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((150, 64))
    v = np.repeat(centres, 8, axis=0) + 0.25 * rng.standard_normal((1200, 64))
    v[10] = v[11] * 3  # the same direction
    table = [(0, i, [float(x) for x in r]) for i, r in enumerate(v)]
    odd = [(0, 5000, None), (0, 5001, []), (0, 5002, [1.0] * 63), (0, 5003, [0.0] * 64), (0, 5004, [float("nan")] + [1.0] * 63), (0, 5005, [None] + [1.0] * 63), (0, 7, table[7][2]), (1, 3, table[0][2])]
    df = spark.createDataFrame(table + odd, "tbl int, key long, vector array<double>")
    got = {(r["key"], r["other"]) for r in neighbours.nearest(df).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = set()
    for i in range(len(v)):
        near = [j for j in np.lexsort((np.arange(len(v)), -np.round(s[i], 7)))[:10] if s[i, j] >= 0.85]
        want |= {(i, int(j)) for j in near}
    assert len(got & want) / len(want) >= 0.99
    assert len(got - want) / len(got) <= 0.01
    asked = neighbours.nearest(df, least=-1.0, budget=10**6, asked=F.col("key") % 100 == 0)  # complete, so it is exact
    order = {i: [int(j) for j in np.lexsort((np.arange(len(v)), -np.round(s[i], 12)))[:10]] for i in range(0, len(v), 100)}
    found = {}
    for r in asked.where("tbl = 0").orderBy("key", "rank").collect():
        found.setdefault(r["key"], []).append(r["other"])
    assert found == order


def test_equal_vectors_rank_by_key(spark):
    df = spark.createDataFrame([(0, i, [1.0] * 64) for i in range(40)], "tbl int, key long, vector array<double>")
    got = rows(neighbours.nearest(df).select("key", "other"))
    assert got == {(i, j) for i in range(40) for j in [k for k in range(40) if k != i][:10]}


def near_copies(seed, n, noise):
    rng = np.random.default_rng(seed)
    v = (rng.standard_normal(64) + noise * rng.standard_normal((n, 64))).astype(np.float32)
    u = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    return v, {(i, int(j)) for i in range(n) for j in np.argsort(-s[i])[:10] if s[i, j] >= 0.85}


@pytest.mark.parametrize("most", [neighbours.MOST, 700])
def test_group_of_unequal_near_copies_larger_than_the_window(spark, monkeypatch, most):
    monkeypatch.setattr(neighbours, "MOST", most)  # 700: buckets are cut into chunks
    monkeypatch.setattr(neighbours, "BESIDE", 8)
    v, want = near_copies(11, 3000, 0.15)
    df = spark.createDataFrame([(0, i, r.tolist()) for i, r in enumerate(v)], "tbl int, key long, vector array<float>")
    got = {(r["key"], r["other"]) for r in neighbours.nearest(df).collect()}
    assert len(want) == 30_000 and len(got & want) / len(want) >= 0.99


def test_a_dense_cluster_keeps_its_recall(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(64)
    sigma = np.linalg.norm(centre) * np.sqrt((1 / 0.91 - 1) / 64)
    v = (centre + sigma * rng.standard_normal((16_000, 64))).astype(np.float32)
    df = spark.createDataFrame(pd.DataFrame({"tbl": np.zeros(len(v), dtype=np.int32), "key": np.arange(len(v)), "vector": list(v)}), "tbl int, key long, vector array<float>").repartition(4)
    got = {(r["key"], r["other"]) for r in neighbours.nearest(df).where("key % 50 = 0").collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u[::50] @ u.T
    s[np.arange(len(s)), np.arange(0, len(v), 50)] = -2
    want = {(50 * i, int(j)) for i, row in enumerate(s) for j in np.argsort(-row)[:10]}
    assert len(got & want) / len(want) >= 0.95


def test_the_ascent_is_synchronous_and_reaches_over_parts():
    rng = np.random.default_rng(1)
    hashes = rng.integers(-(2**63), 2**63, (3000, 3))
    array = np.broadcast_to(np.arange(3), hashes.shape)
    buckets = neighbours._buckets(array, hashes)
    values, counts = np.unique(buckets, return_counts=True)
    parts = neighbours.Parts(values, counts, 500, 10**6)
    level = parts.levels(buckets, 200)
    for i in range(0, 3000, 300):
        held = [sum(int(((hashes[:, t] >> (64 - b)) == (hashes[i, t] >> (64 - b))).sum()) for t in range(3)) for b in range(1, 11)]
        assert level[i] == max([b for b, n in enumerate(held, 1) if n >= 200], default=0)
    for t in range(3):
        row, part, role = parts.members(buckets[:, t], np.arange(3000))
        own = dict(zip(row.tolist(), part.tolist()))
        assert (role == neighbours.MEMBER).all() and len(own) == 3000
        sent = {}
        for i, p in zip(*(x.tolist() for x in parts.beyond(buckets[:, t], level))):
            sent.setdefault(i, {own[i]}).add(p)
        for i in range(0, 3000, 300):
            free = 64 - int(level[i])
            near = np.flatnonzero(hashes[:, t] >> free == hashes[i, t] >> free) if level[i] else np.arange(3000)
            assert {own[j] for j in near.tolist()} == sent.get(i, {own[i]})


# --- scanned pages ---------------------------------------------------------------------------------------------------


def test_automaton_finds_every_word_within_distance():
    def distance(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
        return d[-1]

    rng = random.Random(5)
    words = {"".join(rng.choice("abcde") for _ in range(rng.randint(1, 7))): rng.randint(1, 9) for _ in range(300)}
    trie = ocr.Trie(words)
    for _ in range(60):
        w = "".join(rng.choice("abcde") for _ in range(rng.randint(1, 7)))
        for k in (0, 1, 2):
            assert sorted(trie.within(w, k)) == sorted((x, n) for x, n in words.items() if distance(w, x) <= k)
            assert sorted(trie.within(w, k, 5)) == sorted((x, n) for x, n in words.items() if distance(w, x) <= k and n >= 5)


def scanned_page(i):
    if i == 3:
        return "Pump manual KX-100\n\nThe upper valve must be cl-\neaned before the low-\nvoltage motor starts and the vaive is\nopened by the operator in the control room\nof the plant.\n- 3 -"
    words = [f"{a}{b}" for a in ("ta", "ke", "mi", "so", "lu") for b in ("ron", "vel", "dak", "pim")]
    random.Random(i).shuffle(words)
    return "Pump manual KX-100\n\n" + "\n".join(" ".join(words[k : k + 5]) for k in range(0, 20, 5)) + f".\n- {i} -"


def test_confusions():
    assert ocr.explained("vaive", "valve") == ["l>i"] and ocr.explained("clone", "done") == ["d>cl"]
    assert ocr.explained("rnodcrn", "modern") is None and ocr.explained("rnodcrn", "modern", 2) == ["m>rn", "e>c"]
    assert ocr.explained("valve", "valve") == [] and ocr.explained("value", "valve", 2) is None


@pytest.mark.parametrize(("shard", "plain"), [(ocr.SHARD, ocr.PLAIN), (7, 1)])
def test_scan_repair(spark, monkeypatch, shard, plain):
    monkeypatch.setattr(ocr, "SHARD", shard)  # the same rows whatever the vocabulary's size
    monkeypatch.setattr(ocr, "PLAIN", plain)
    repaired(spark)


def repaired(spark):
    plain = "The upper valve must be cleaned before the low-voltage motor starts and the valve is opened by the operator in the control room of the plant. " * 60
    table = [(i, "/scan.pdf", scanned_page(i)) for i in range(1, 9)] + [(100, None, plain), (101, "/s", None), (102, "/s", ""), (103, "/s", "x" * 50_000), (None, "/s", "x")]
    df = spark.createDataFrame(table, "key long, source string, text string").withColumn("lines", F.lit(1))
    got = {r["key"]: r for r in ocr.mended(df).collect()}
    defects = {(d["defect"], d["piece"]) for d in got[3]["defects"]}
    assert defects == {("header", "Pump manual KX-100"), ("pageno", "- 3 -"), ("hyphen", "cleaned"), ("hyphen", "low-voltage"), ("misread", "valve")}
    assert got[3]["text"].startswith("The upper valve must be cleaned before the low-voltage motor starts and the valve is opened")
    assert "manual" not in got[3]["text"] and "\n" not in got[3]["text"].strip()
    assert got[100]["defects"] == [] and got[101]["text"] is None and got[102]["text"] == ""


def test_two_confusions_in_a_word_need_both_to_be_known(spark):
    plain = "The modern cleaner of the valve motor was checked by the operator. " * 30
    table = [(1, None, plain), (2, None, "a rnotor and a valvc"), (3, None, "the rnodcrn one"), (4, None, "the modcrri one")]
    df = spark.createDataFrame(table, "key long, source string, text string")
    got = {r["key"]: {(d["defect"], d["piece"]) for d in r["defects"]} for r in ocr.mended(df).collect()}
    assert got == {1: set(), 2: {("misread", "motor"), ("misread", "valve")}, 3: {("misread", "modern")}, 4: set()}


def test_running_lines_of_a_chapter(spark):
    words = [f"{a}{b}" for a in ("ta", "ke", "mi", "so", "lu") for b in ("ron", "vel", "dak", "pim")]

    def page(i):
        random.Random(i).shuffle(words)
        return ("Chapter Two Pumps\n" if 10 <= i < 14 else "") + "\n".join(" ".join(words[k : k + 5]) for k in range(0, 20, 5)) + "."

    df = spark.createDataFrame([(i, "/m.pdf", page(i)) for i in range(40)], "key long, source string, text string")
    got = {r["key"] for r in ocr.mended(df).collect() if ("header", "Chapter Two Pumps") in {(d["defect"], d["piece"]) for d in r["defects"]}}
    assert got == {10, 11, 12, 13}


# --- survivors -------------------------------------------------------------------------------------------------------


def records(spark, items):
    fields = ["source", "page", "vision_label", "caption", "chartqa", "ocr"]
    df = spark.createDataFrame([(i, p, d, e, t, *[m.get(f) for f in fields]) for i, p, d, e, t, m in items], "rec_id long, p string, source_dir string, extractor string, ingested_at string, source string, page int, vision_label string, caption boolean, chartqa boolean, ocr boolean")
    meta = F.from_json(F.lit("{}"), META_DDL).withField("image_path", F.col("p"))
    for f in fields:
        meta = meta.withField(f, F.col(f))
    return df.select("rec_id", meta.alias("metadata"), "source_dir", "extractor", F.col("ingested_at").cast("timestamp").alias("ingested_at"), F.lit(1).alias("level"))


def test_survivors(spark):
    trust = spark.createDataFrame([("a", 5), ("b", 9), (None, 99)], "extractor string, trust_level int")
    items = [
        (1, "/d/x/é 1.png", "/d", "a", "2025-01-02", {"source": "s1", "page": 3, "caption": False}),
        (2, "x/./e\u0301 1.png", "/d/", "b", "2025-01-01", {"source": " N/A ", "page": 0, "ocr": True}),
        (3, "file:///d/x/%C3%A9%201.png", None, "zzz", None, {"source": "s3", "vision_label": "chart"}),
        (4, "\\d\\y\\..\\x\\é 1.png", "/d", None, "2025-01-03", {"source": "s4", "vision_label": "table"}),
        (5, "/d/x/É 1.png", "/d", "b", "2025-01-01", {"source": "other"}),
        (6, None, "/d", "b", "2025-01-01", {"source": "none"}),
        (7, "  ", "/d", "b", "2025-01-01", {"source": "none"}),
        (1, "/d/x/é 1.png", "/d", "a", "2025-01-02", {"source": "s1", "page": 3, "caption": False}),
    ]
    df = records(spark, items)
    assert rows(survivor.winners(df, trust)) == {(1, "source", 1), (1, "page", 1), (1, "caption", 1), (1, "ocr", 2), (1, "vision_label", 4)}
    assert survivor.survivors(df, trust).count() == 2
    assert survivor.winners(df.limit(0), trust.limit(0)).count() == 0


# --- splitting -------------------------------------------------------------------------------------------------------


def check_pieces(text, pieces, limit, overlap):
    whole = text.strip()
    assert all(len(p["piece"]) <= limit for p in pieces)
    assert "".join(p["piece"][len(p["piece"]) - p["fresh"] :] for p in pieces) == whole
    for before, p in zip(pieces, pieces[1:]):
        kept = p["piece"][: len(p["piece"]) - p["fresh"]]
        assert len(kept) <= overlap and before["piece"].endswith(kept)
        assert whole[p["start"] : p["start"] + p["fresh"]] == p["piece"][len(kept) :]


def test_split_round_trip(spark):
    rng = random.Random(2)
    parts = ["word", "Sentence ends. ", "\n\n", "\n", "x" * 90, " ", "日本語の文。", "🔧", "- "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 120))) for _ in range(80)] + ["", "   ", None, "a" * 5000, "ab " * 40_000]
    df = spark.createDataFrame(list(enumerate(texts)), "cut long, piece string")
    out = split.split(df, "cut", "piece", limit=100, overlap=20)
    by = {}
    for r in out.orderBy("cut", "piece_no").collect():
        by.setdefault(r["cut"], []).append(r)
    for i, t in enumerate(texts):
        if t and t.strip():
            check_pieces(t, by[i], 100, 20)
        else:
            assert i not in by


def test_split_prefers_strong_boundaries(spark):
    text = "A first paragraph here.\n\n" + "Second one. " * 4
    got = [r["piece"] for r in split.split(spark.createDataFrame([(1, text)], "k long, t string"), "k", "t", limit=40, overlap=0).collect()]
    assert got[0] == "A first paragraph here.\n\n" and got[1].endswith("one. ")


def test_size_cases(spark):
    table = [(1, "a b " * 450 + "x"), (2, "a" * 1800), (3, "a" * 1801), (4, ("a" * 1700 + "-") * 3), (5, "a b " * 449), (6, None), (7, " " * 3000), (8, "🔧" * 1801)]
    got = rows(split.size_cases(spark.createDataFrame(table, "_x long, t string"), "_x", "t"))
    assert got == {(1, "oversized"), (3, "oversized"), (3, "unbreakable"), (4, "oversized"), (8, "oversized")}


# --- markup ----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("# A **b** [c](u) #\n\n* one\n  * `two`\n\n1. three\n\n```py\nx = 1\n\ny = 2\n```\n\n$$a_1$$ and $b$ for $5 or $6.", [("heading", "A b c"), ("list_item", "one"), ("list_item", "two"), ("list_item", "three"), ("code", "x = 1 y = 2"), ("formula", "a_1"), ("formula", "b")]),
        ("Title\n=====\n\ntext\n\nSub\n---\n\nmore", [("heading", "Title"), ("heading", "Sub")]),
        ("<H2>\n A &amp; <b>B</b>\n</H2><ul><li>x <a href='u'>y</a><li>z</ul><pre><code>a &lt; b\nc</code></pre><p>\\(q &gt; 1\\)</p><script>n</script>", [("heading", "A & B"), ("list_item", "x y"), ("list_item", "z"), ("code", "a < b c"), ("formula", "q > 1")]),
        ("== A '''b''' ==\n\n# one [[U|two]]\n# three\n\n<syntaxhighlight lang='x'>\nq\n</syntaxhighlight>\n\n<math>m</math>", [("heading", "A b"), ("list_item", "one two"), ("list_item", "three"), ("code", "q"), ("formula", "m")]),
        ("\\section{A \\& \\emph{b}}\\label{s}\n\n\\begin{itemize}\n \\item \\textbf{one} two\n\\end{itemize}\n\n\\begin{verbatim}\n\\x\n\\end{verbatim}\n\\[ e^{x} \\]", [("heading", "A & b"), ("list_item", "one two"), ("code", "\\x"), ("formula", "e^{x}")]),
        ("Plain, C:\\logs\\x if a < 3 and b > 4. It cost $15 and $20.\n   | 7\n- 3 -\n[4]", []),
        ("- [Home](/)\n- [News](/n)\n- [Shop](/s)\n- [Help](/h)", []),
        ("", []), (None, []), ("  \n ", []),
    ],
)
def test_markup_parts(text, want):
    assert markup.parts(text) == want


def test_markup_clean_and_frames(spark):
    df = spark.createDataFrame([(1, "# A\n\ntext **b**\n\n- c"), (1, "# A\n\ntext **b**\n\n- c"), (2, None), (None, "# x"), (3, "*a " * 30_000)], "text long, key string")
    assert rows(markup.structure(df, "text", "key")) == {(1, "heading", "A"), (1, "list_item", "c")}
    assert {(r[0], r[1]) for r in markup.cleaned(df, "text", "key").collect() if r[0] != 3} == {(1, "# A\n\ntext b\n\n- c"), (2, None)}


def test_every_labelled_block_is_learnt():
    assert all(markup.decide(markup.TREE, markup._vector(r[0], *r[1:7])) == r[7] for r in markup.LABELLED)


# --- repetition ------------------------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_share(words):
    seen, covered = set(), set()
    for i in range(len(words) - 2):
        g = tuple(words[i : i + 3])
        if g in seen:
            covered |= {i, i + 1, i + 2}
        seen.add(g)
    m = repetition.measures(["x y", " ".join(words), None, "p q r p q r"])
    assert m["run_share"][1] == (len(covered) / len(words) if words else 0)
    assert m["n_words"].tolist() == [2, len(words), 0, 6] and m["run_share"].tolist()[2:] == [0, 0.5]


def test_repetitive(spark):
    table = [(1, "caption", "the cat sat " * 9), (2, "caption", "a plain sentence about one pump in the north hall of the plant"), (3, "chartqa", None), (4, "chartqa", ""), (5, "chartqa", "!!"), (1, "caption", "the cat sat " * 9), (None, "caption", "x y z " * 9), (6, "caption", "word " * 50_000)]
    df = spark.createDataFrame(table, "key long, attr string, text string").withColumn("votes", F.lit(0))
    assert rows(repetition.repetitive(df)) == {(1, "caption"), (6, "caption")}


def test_expectation_maximisation_separates():
    p = repetition.posterior({"111111": 50, "00-0--": 900, "1--1--": 30, "0-00--": 500})
    assert p["111111"] > 0.9 and p["00-0--"] < 0.1 and repetition.posterior({}) == {}


def test_a_rule_that_is_often_wrong_is_outvoted():
    # the first rule, that of the definition, contradicts all others on some texts
    p = repetition.posterior({"111111": 60, "000000": 500, "100000": 40, "011111": 20})
    assert p["100000"] < 0.5 < p["011111"]
    # a rule that is right as often as not decides nothing
    p = repetition.posterior({"11111-": 50, "00000-": 450, "111111": 50, "000001": 450, "-----1": 10})
    assert p["-----1"] < 0.5


# --- tokens ----------------------------------------------------------------------------------------------------------


def test_tokens_equal_the_library_and_come_back(spark):
    tokenizers = pytest.importorskip("tokenizers")
    own = tokenizers.Tokenizer.from_file(bpe.VOCABULARY)
    own.encode_special_tokens = True
    texts = ["Hello  world\n\n\tx", "<|endoftext|> again", "日本語の文章です。", "a" * 3000, "é e\u0301 🔧👩\u200d🔬", "\x00\x01", "   ", "", None, "I'll we've 'S", "12345678901234567890" * 40, "\u200b\u00a0 \u3000x"]
    df = spark.createDataFrame(list(enumerate(texts)), "ids long, text string")
    df = df.withColumnRenamed("ids", "id")
    enc = bpe.encode(df, "id", "text")
    got = {r["id"]: list(r["ids"]) for r in enc.collect()}
    assert got == {i: own.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(texts)}
    assert {r["id"]: r["text"] for r in bpe.decode(enc, "id").collect()} == {i: t or "" for i, t in enumerate(texts)}


@settings(max_examples=25, deadline=None)
@given(st.one_of(st.text(min_size=60, max_size=700), st.builds(lambda p, n: (p * n)[:900], st.text("abxyz-=é0 ", min_size=1, max_size=9), st.integers(100, 300)), st.text("ab", min_size=100, max_size=900)))
def test_long_words_are_joined_from_segments(text):
    own, encoder = long_encoder()
    assert encoder.encode([text]).to_pylist()[0] == own.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=1)
def long_encoder():
    tokenizers = pytest.importorskip("tokenizers")
    own = tokenizers.Tokenizer.from_file(bpe.VOCABULARY)
    own.encode_special_tokens = True
    first, merges, known = bpe.read_vocabulary(bpe.VOCABULARY)
    shared = type("Shared", (), {"value": (first, merges, np.array([len(b) for b in known]))})()
    encoder = bpe.Encoder(shared)
    list(encoder(iter([])))  # sets it up
    return own, encoder


def test_a_very_long_run_of_letters():
    own, encoder = long_encoder()
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(100_000)) + "=" * 100_000
    began = time.time()
    assert encoder.encode([text]).to_pylist()[0] == own.encode(text, add_special_tokens=False).ids
    assert time.time() - began < 60


# --- leaks -----------------------------------------------------------------------------------------------------------

ITEM = "How many litres of flow remain if Kellix first uses 752 then 111 and finally hands 863 back to the workshop?"


def test_leaks(spark, monkeypatch):
    docs = [
        (1, "Noise. HOW MANY litres\nof **flow** remain, if Kellix first uses 752 then stop."),
        (2, "How many litres of flow remain if Kellix first uses"),
        (3, "How many bar of flow remain if Tamlix first uses 9 then 8 and finally hands 7 back to the workshop"),
        (4, "how many litres of flow remain if Kellix"),
        (5, None), (6, ""), (None, ITEM), (1, "Noise. HOW MANY litres\nof **flow** remain, if Kellix first uses 752 then stop."), (7, ITEM + " word" * 50_000),
    ]
    d = spark.createDataFrame(docs, "id long, text string").withColumn("words", F.lit(1))
    i = spark.createDataFrame([(70, ITEM), (71, "short one"), (72, None), (70, ITEM)], "id long, text string")
    want = {(1, 70), (2, 70), (7, 70)}
    assert rows(leak.verbatim(d, i)) == want
    kinds = {(r["doc_id"], r["kind"]) for r in leak.leaks(d, i).collect()}
    assert kinds == {(1, "verbatim"), (2, "verbatim"), (7, "verbatim"), (3, "re-parameterised")}
    monkeypatch.setattr(leak, "MOST_HASHES", 3)  # too many to send: all windows are joined
    monkeypatch.setattr(leak, "MOST_WINDOWS", 1)  # and each template is split
    assert rows(leak.verbatim(d, i)) == want
    assert {(r["doc_id"], r["kind"]) for r in leak.leaks(d, i).collect()} == kinds
    monkeypatch.setattr(leak, "MOST_WORDS", 5)
    with pytest.raises(ValueError):
        leak.verbatim(d, i)


def test_windows_of_slots_only_leak_nothing_but_themselves(spark):
    numbers = [" ".join(str(100 * i + k) for k in range(12)) for i in range(3)]
    d = spark.createDataFrame([(1, numbers[0]), (2, numbers[1])], "id long, text string")
    i = spark.createDataFrame([(9, numbers[1]), (8, numbers[2])], "id long, text string")
    assert rows(leak.leaks(d, i).select("doc_id", "item_id", "kind")) == {(2, 9, "verbatim")}


# --- languages -------------------------------------------------------------------------------------------------------

SENTENCES = {
    "en": "The {0} of the {1} must be checked before the unit is started. Nobody may open the {1} without a written permit. After {2} hours the temperature of the {0} rose again.",
    "de": "Der {0} in der {1} muss vor dem Start der Anlage geprüft werden. Ohne Freigabe darf niemand die {1} öffnen oder verstellen. Nach {2} Stunden stieg die Temperatur wieder an.",
    "fr": "Le {0} de la {1} doit être contrôlé avant la mise en marche. Personne ne peut ouvrir la {1} sans autorisation. Après {2} heures la température est montée de nouveau.",
    "ru": "Перед запуском установки необходимо проверить {0}. Без письменного разрешения никто не может открыть {1}. Через {2} часов температура снова выросла.",
}


def labelled(seed, n=40):
    rng = random.Random(seed)
    things = ["motor", "pump", "filter", "sensor", "ventil", "kompressor"]
    out = []
    for code, text in SENTENCES.items():
        out += [(code, " ".join(text.format(rng.choice(things), rng.choice(things), rng.randint(1, 900)).split(". ")[: rng.randint(1, 3)]).rstrip(".") + ".") for _ in range(n)]
    return out


def test_language_held_out_accuracy_and_cases(spark):
    sample = [(i, t, c if i % 11 else "en") for i, (c, t) in enumerate(labelled(1))]  # some labels are wrong
    train = spark.createDataFrame(sample, "id long, text string, lang string")
    net = language.train(train)
    held = [(c, t) for c, t in labelled(2, 25) if language.sentences(t)]
    found = language.Classify.decide(net, [t for _, t in held])
    right = sum(net.languages[int(p.argmax())] == c for p, (c, _) in zip(found, held))
    assert right / len(held) >= 0.97
    en, de = SENTENCES["en"].format("pump", "motor", 4), SENTENCES["de"].format("Filter", "Pumpe", 9)
    cases = [(1, en, "English"), (2, en, "de"), (3, en + " " + de, "en"), (4, en, None), (5, en, "xx"), (6, "47 | 11", "en"), (7, None, None), (8, "", "fr"), (9, de, "DE-at"), (10, en + ' The plate says "Bitte nicht" in red letters.', "eng"), (None, en, None)]
    df = spark.createDataFrame(cases, "id long, text string, lang string").withColumn("label", F.lit("x"))
    assert rows(language.relabelled(df, net)) == {(2, "en"), (3, "en"), (3, "de"), (4, "en"), (5, "en")}
    parts = {r["key"]: r["segments"] for r in language.classified(df, net).collect()}
    assert [s["lang"] for s in parts[3]] == ["en", "de"] and parts[7] == [] and all(0 <= s["confidence"] <= 1 for s in parts[3])
    s = parts[3][1]
    assert (en + " " + de)[s["start"] : s["start"] + s["length"]] == de


def test_sentences_of_few_words_and_other_marks():
    def parts(text):
        return [text[a:b] for a, b in language.sentences(text)]

    assert parts("Ventil klemmt nicht. Pump failed! はい。") == ["Ventil klemmt nicht.", "Pump failed!", "はい。"]
    assert parts("Das Ventil Nr. 5 ist zu. Nur z. B. heute.") == ["Das Ventil Nr. 5 ist zu.", "Nur z. B. heute."]
    assert parts("„Das Ventil ist jetzt zu.“ Dann geht es weiter.") == ["„Das Ventil ist jetzt zu.“", "Dann geht es weiter."]
    assert parts("The pump has failed again.Der Motor steht ganz still.") == ["The pump has failed again.", "Der Motor steht ganz still."]
    assert parts("هل المضخة تعمل الآن؟ المضخة لا تعمل الآن.") == ["هل المضخة تعمل الآن؟", "المضخة لا تعمل الآن."]
    assert parts("पंप अभी बंद है। वाल्व भी बंद है।") == ["पंप अभी बंद है।", "वाल्व भी बंद है।"]
    assert parts("阀门３．５已经关闭了．泵现在也关闭了｡") == ["阀门３．５已经关闭了．", "泵现在也关闭了｡"]
    assert parts("異音が止まらない場合です。760時間後に点検します。") == ["異音が止まらない場合です。", "760時間後に点検します。"]
    assert parts("The pump must be checked now. 0000123 Suppose that") == ["The pump must be checked now."]
    assert parts("47 | 11") == parts("# KF-25311") == parts("fine print…") == parts(" ") == parts(None) == []


def test_few_words_and_unfinished_lines_have_a_language(spark):
    train = spark.createDataFrame([(i, t, c) for i, (c, t) in enumerate(labelled(1))], "id long, text string, lang string")
    net = language.train(train)
    en, ru = SENTENCES["en"].format("pump", "motor", 4), SENTENCES["ru"].format("motor", "filter", 7)
    cases = [(1, "Перед запуском установки.", "en"), (2, en + " Без письменного разрешения.", "en"), (3, "Qzx vwk.", "de"), (4, "# Перед запуском установки необходимо проверить", "en"), (5, "# Pump limits\n\n" + en + "\n\n" + ru + " Через", "ru")]
    df = spark.createDataFrame(cases, "id long, text string, lang string")
    assert rows(language.relabelled(df, net)) == {(1, "ru"), (2, "en"), (2, "ru"), (5, "en"), (5, "ru")}
    parts = {r["key"]: [(s["start"], s["start"] + s["length"], s["lang"]) for s in r["segments"]] for r in language.classified(df, net).collect()}
    assert parts[4] == [(0, len(cases[3][1]), "ru")]
    at = cases[4][1].index(ru)
    assert parts[5] == [(0, at - 2, "en"), (at, len(cases[4][1]), "ru")]


def test_queries_run_on_whole_tables(spark, data):
    from loomquill.llm.queries import QUERIES

    for name in ("p1_found", "p2_found", "p3_found", "p4_found", "p5_found", "p6_found", "p7_found", "p8_ids", "p10_found"):
        assert QUERIES[name](spark, data).count() > 0, name
    assert QUERIES["p9_found"](spark, data).count() == 0  # none at this size


def test_same_rows_as_sql(spark, data):
    from loomquill.llm.queries import QUERIES
    from loomquill.llm.sql import SQL

    con = pytest.importorskip("duckdb").connect()
    for t in ("documents", "store_rows", "embed_payloads", "text_docs", "image_readings", "img_docs", "eval_items", "extractors"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    for name, sql in SQL.items():
        df = QUERIES[name](spark, data)
        columns = sorted(df.columns)
        result = con.execute(sql)
        names = [c[0] for c in result.description]
        want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
        assert sorted((tuple(r) for r in df.select(*columns).collect()), key=repr) == want, name
