"""Operators on hand-made rows; the expected values follow from the rules of each operator."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomquill.config import EngineConfig
from loomquill.operators import assembly, chunking, dedupe, embedding, images, retrieval, store, tables
from loomquill.schema import META_DDL


def rows(df):
    return {tuple(r) for r in df.collect()}


def meta(**values):
    m = F.from_json(F.lit("{}"), META_DDL)
    for k, v in values.items():
        m = m.withField(k, v if not isinstance(v, (str, int, bool)) else F.lit(v))
    return m


# --- configuration ---------------------------------------------------------------------------------------------------


def test_config():
    assert EngineConfig(chunk_strategy="other").chunk_strategy == "simple" and EngineConfig().candidates() == 80
    assert EngineConfig(top_k_mmr=70, top_k_bm25=30).candidates() == 120
    for bad in ({"chunk_size": 100}, {"top_k": 0}, {"base": "a;b"}):
        with pytest.raises(ValueError):
            EngineConfig(**bad)


# --- tables and images -----------------------------------------------------------------------------------------------


def test_tables(spark):
    df = spark.createDataFrame([(["a", None], [["1", None], ["a", ""], ["x", "y,z", "w"]])], "h array<string>, r array<array<string>>")
    h, r = F.col("h"), F.col("r")
    one = df.select(tables.to_markdown(h, r), tables.to_json(h, r), tables.row_sentences(h, r), tables.to_csv(h, r)).first()
    assert one[0] == "| a |  |\n|---|---|\n| 1 |  |\n| a |  |\n| x | y,z | w |\n"
    assert one[1] == '{"headers":["a",""],"rows":[["1",null],["a",""],["x","y,z","w"]]}'
    assert one[2] == ["Row -> a: 1, : ", "Row -> a: x, : y,z"]
    shifted = df.select(tables.csv_sentences(tables.to_csv(h, r), h)).first()[0]
    assert shifted == ["Row -> a: 1, : ", "Row -> a: x, : y"]


def test_images(spark):
    df = spark.createDataFrame([("ab 123", 1, 1, None, True), ("ab12", 48, 400, "chart", True), ("", 48, 400, "screenshot", False), (None, 47, 4000, "table", False), ("······", 9, 9, "chart", False)], "ocr string, w int, h int, label string, want boolean")
    assert all(r[0] == r[1] for r in df.select(images.keep(F.col("ocr"), F.col("w"), F.col("h"), F.col("label")), "want").collect())
    fused = spark.createDataFrame([("a", "", None), (None, None, ""), ("a", "b", "c")], "x string, y string, z string")
    assert [r[0] for r in fused.select(images.fuse(F.col("x"), F.col("y"), F.col("z"))).collect()] == ["a", None, "a • b • c"]
    stubs = spark.createDataFrame([("/d/m.pdf", 3, "/i/p.png", "chart"), (None, None, "/i/p.png", None), ("", 0, None, "")], "s string, p int, i string, l string")
    assert [r[0] for r in stubs.select(images.stub(F.col("s"), F.col("p"), F.col("i"), F.col("l"))).collect()] == ["image (chart) from m.pdf page 3", "image from p.png", "image from image"]
    spans = spark.createDataFrame([([("a", None), ("b", 0.29), ("c", 0.3)],), ([],)], "s array<struct<text:string,conf:double>>")
    assert [r[0] for r in spans.select(images.confident(F.col("s"))).collect()] == ["a c", ""]


# --- distinct rows ---------------------------------------------------------------------------------------------------


def test_dedupe_documents(spark):
    table = [(1, "Some  long text here", "/a", 1), (2, "some long TEXT here", "/a", 1), (3, "some long text here", "/a", 2), (4, "elevenchars", "/a", 1), (5, None, "/a", 1), (6, "some long text here", None, None), (7, "some long text here", "", None)]
    df = spark.createDataFrame(table, "o long, page_content string, s string, p int").withColumn("metadata", meta(source=F.col("s"), page=F.col("p")))
    kept = dedupe.documents(df, F.col("o"), keep=["o"])
    assert rows(kept) == {(1,), (3,), (6,)}
    assert rows(dedupe.documents(df.repartition(5), F.col("o"), keep=["o"])) == rows(kept)
    assert dedupe.documents(df.limit(0), F.col("o")).count() == 0


def test_section_cap_and_first_seen(spark):
    df = spark.createDataFrame([(1, "/a", 1, r) for r in range(4)] + [(1, None, None, 9), (2, "/a", 1, 0)], "query int, s string, p int, rank int")
    assert rows(dedupe.cap_sections(df, ["query", "s", "p"]).select("query", "rank")) == {(1, 0), (1, 1), (1, 9), (2, 0)}
    assert spark.range(1).select(dedupe.first_seen(F.array(F.lit(2), F.lit(1), F.lit(2)))).first()[0] == [2, 1]


# --- chunking --------------------------------------------------------------------------------------------------------


def test_word_windows(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 500, 501, 900, 901, 1300)] + [" a  b ", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = [r[0] for r in df.orderBy("k").select(chunking.word_windows(F.col("t"))).collect()]
    assert [[len(x.split()) for x in g] for g in got[:7]] == [[0], [1], [500], [500, 101], [500, 500], [500, 500, 101], [500, 500, 500]]
    assert got[7] == [" a  b "]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 9), st.integers(10, 40))
def test_packer_never_exceeds_its_cap(n, cost, cap):
    body = " ".join(" ".join(["w"] * (cost - 1) + [f"s{i}."]) for i in range(n))
    split = lambda t: t.split()
    out = chunking.pack_sentences("§", body, cap, split)
    assert all(len(split(x)) <= cap for x in out)
    assert not {f"s{i}." for i in range(n)} - {w for x in out for w in x.split()} or cost > cap - 1


@pytest.mark.parametrize(("n", "cost", "want"), [(2, 3, ["01"]), (3, 3, ["012", "12"]), (5, 3, ["01234", "34"]), (4, 60, ["0", "1", "2", "3"]), (7, 30, ["012", "123", "234", "345", "456", "56"])])
def test_packer_traces(n, cost, want):
    body = " ".join(" ".join(["w"] * (cost - 1) + [f"s{i}."]) for i in range(n))
    out = chunking.pack_sentences("", body, 100, lambda t: t.split())
    assert ["".join(w[1] for w in x.split() if w != "w") for x in out] == want
    trimmed = chunking.pack_sentences("", body, 100, lambda t: t.split(), drop_redundant_tail=True)
    assert len(trimmed) <= len(out)


def test_markdown_and_recursive():
    text = "pre\n# A\nx\n## B\ny\n```\n# no\n```\n# C\nz"
    assert chunking.markdown_sections(text) == [(None, None, None, "pre"), ("A", None, None, "x"), ("A", "B", None, "y\n```\n# no\n```"), ("C", None, None, "z")]
    assert chunking.protect_tables("x\n|a|\n|b|\ny") == "x\n|a| |b|\ny"
    assert chunking.recursive_split("aaa bbb ccc ddd eee", 8, 3) == ["aaa bbb", "bbb ccc", "ccc ddd", "ddd eee"]
    assert chunking.recursive_split("a" * 25, 10, 0) == ["a" * 10, "a" * 10, "a" * 5]
    assert chunking.trim_tokens("w " * 100, 30) == "w " * 25
    assert chunking.tag_of(" A ", None, "C") == "§A/C" and chunking.tag_of(None, "") == "§"


@pytest.mark.parametrize("strategy", ["simple", "recursive", "semantic"])
def test_strategies(spark, strategy):
    text = "# Head\n\n" + "One sentence is here. " * 200 + "\n\n## Next\n\n| a |\n| b |"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, " ")], "k int, t string")
    out = chunking.chunks(df, "k", "t", EngineConfig(chunk_strategy=strategy, chunk_size=500, chunk_overlap=50)).collect()
    assert out and {r["k"] for r in out} == {1} and all(r["chunk"].strip() for r in out)
    assert all(r["chunk"].startswith("§Head") for r in out) == (strategy != "simple")
    assert {r["split_method"] for r in out} == ({"semantic"} if strategy == "semantic" else {None})


def test_token_windows(spark):
    df = spark.createDataFrame([("a b, c d e",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(chunking.token_windows(F.col("t"), 2)).collect()] == [["a b", ", c", "d e"], None, None]
    assert [r[0] for r in df.select(chunking.token_windows_with_prefix("p q", F.col("t"), 4, 1)).collect()][0] == ["p q\n\na b", "p q\n\nb ,", "p q\n\n, c", "p q\n\nc d", "p q\n\nd e"]
    assert df.select(chunking.token_count(F.col("t"))).first()[0] == 6


# --- embedding and requests ------------------------------------------------------------------------------------------


def test_embedder_and_requests(spark):
    e = embedding.HashEmbedder().encode(["a b", "b a", "", "c"])
    assert np.allclose(e[0], e[1]) and not e[2].any() and np.isclose(np.linalg.norm(e[3]), 1)
    assert embedding.HashEmbedder().encode([]).shape == (0, 64)
    api = "array<struct<role:string,content:string>>"
    df = spark.createDataFrame([([("user", "a"), ("assistant", "b"), ("user", "c")], "m", "7"), ([], "m", "8"), (None, None, "x"), ([("user", " ")], "n", None)], f"api {api}, message string, rid string")
    none = F.lit(None).cast("string")
    assert [r[0] for r in df.select(embedding.question(F.col("api"), F.col("message"), none)).collect()] == ["c", "m", None, "n"]
    assert [r[0] for r in df.select(embedding.request_id(F.col("rid"), F.lit(0))).collect()] == [7, 8, 0, 0]
    assert spark.range(1).select(embedding.request_id(F.lit(0), F.lit(5))).first()[0] == 5


# --- store -----------------------------------------------------------------------------------------------------------


def stored(spark, items):
    return spark.createDataFrame(items, "id string, document string, base string, kind string").select("id", "document", meta().alias("metadata"), F.array().cast("array<float>").alias("embedding"), "base", "kind")


def test_insert_if_absent_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "store")
    a = stored(spark, [("t0", "a", "b", "text"), ("t1", "b", "b", "text"), ("t0", "c", "b", "images")])
    assert store.insert_if_absent(a, path) == 3
    store.insert_if_absent(a, path)
    store.insert_if_absent(stored(spark, [("t0", "new", "b", "text"), ("t2", "x", "b", "text"), ("t2", "y", "b", "text")]), path, [F.col("document")])
    assert rows(spark.read.parquet(path).select("id", "document", "kind")) == {("t0", "a", "text"), ("t1", "b", "text"), ("t0", "c", "images"), ("t2", "x", "text")}
    from loomquill.sources.files import store as read

    assert read(spark, path, "b", "images").count() == 1


def test_relational_store(spark):
    from loomquill.sources.files import jdbc_store

    url, driver = "jdbc:derby:memory:store;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    columns = "id string, document string, s string"
    rows_of = lambda items: spark.createDataFrame(items, columns).select("id", "document", meta(source=F.col("s"), page=3).alias("metadata"), F.array(F.lit(0.5), F.lit(-2.0)).cast("array<float>").alias("embedding"))
    empty = "id varchar(99), document varchar(999), metadata varchar(9999), embedding varchar(999)"
    spark.createDataFrame([], "id string, document string, metadata string, embedding string").write.format("jdbc").options(url=url, dbtable="docs", createTableColumnTypes=empty, **driver).save()
    assert store.jdbc_insert_if_absent(rows_of([("a", "x", "/m.pdf"), ("b", "y", None)]), url, "docs", **driver) == 2
    assert store.jdbc_insert_if_absent(rows_of([("b", "new", None), ("c", "z", None), ("c", "zz", None)]), url, "docs", **driver) == 3
    got = {r["id"]: r for r in jdbc_store(spark, url, "docs", **driver).collect()}
    assert set(got) == {"a", "b", "c"} and got["b"]["document"] == "y" and got["a"]["embedding"] == [0.5, -2.0]
    assert got["a"]["metadata"]["source"] == "/m.pdf" and got["a"]["metadata"]["page"] == 3


def test_positional_ids(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("o"), (F.col("id") % 3 == 0).alias("g"))
    out = store.positional_ids(df.repartition(7), ["g"], "o", F.lit("t")).orderBy("g", "o").collect()
    for g in (True, False):
        assert [r["position"] for r in out if r["g"] == g] == list(range(sum(r["g"] == g for r in out)))
    nulls = spark.createDataFrame([(None, 2), (None, 1), ("x", 1)], "g string, o long")
    assert rows(store.positional_ids(nulls, ["g"], "o", F.lit("t")).select("g", "o", "id")) == {(None, 1, "t0"), (None, 2, "t1"), ("x", 1, "t0")}


# --- retrieval -------------------------------------------------------------------------------------------------------


def test_nearest_blocks_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((300, 8))
    odd = [(900, None), (901, [1.0]), (902, [float("nan")] * 8)]
    corpus = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)] + odd, "key long, vector array<double>")
    queries = corpus.where("key % 50 = 0 or key = 902")
    got = rows(retrieval.nearest(corpus, queries, 5).select("query", "key", "rank"))
    assert got == rows(retrieval.nearest(corpus.repartition(6), queries, 5, block=2).select("query", "key", "rank"))
    for q in range(0, 300, 50):
        order = np.argsort(((v - v[q]) ** 2).sum(1), kind="stable")[:5]
        assert {(q, int(k), i + 1) for i, k in enumerate(order)} <= got
    assert retrieval.nearest(corpus, queries.limit(0), 5).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 12), st.integers(1, 15), st.integers(0, 10_000))
def test_mmr(n, k, seed):
    rng = np.random.default_rng(seed)
    v = rng.standard_normal((n, 4))
    v /= np.linalg.norm(v, axis=1, keepdims=True) + 1e-12
    picks = retrieval.mmr(v[0] if n else np.ones(4), v, k, 0.4)
    assert len(picks) == len(set(picks)) == min(k, n) and (not n or picks[0] == 0)


def test_mmr_ties_and_bm25_fill(spark):
    same = np.array([[1.0, 0.0], [1.0, 0.0], [0.0, 1.0]])
    assert retrieval.mmr(np.array([1.0, 0.0]), same, 3, 0.4) == [0, 2, 1]
    docs = spark.createDataFrame([(1, "alpha beta"), (2, "gamma"), (3, ""), (4, "beta beta gamma delta")], "key long, text string")
    asked = spark.createDataFrame([(10, "Beta"), (11, "nothing"), (12, "")], "query long, text string")
    got = {(r["query"], r["rank"]): (r["key"], r["score"]) for r in retrieval.bm25(docs, asked, 3).collect()}
    assert got[(11, 1)] == (1, 0.0) and got[(11, 3)] == (3, 0.0) and got[(12, 1)] == (1, 0.0)
    assert {got[(10, r)][0] for r in (1, 2)} <= {1, 2, 4} and len([k for k in got if k[0] == 10]) == 3


def test_kept_postings(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b")], "key long, text string")
    asked = spark.createDataFrame([(9, "a")], "query long, text string")
    first = retrieval.kept_postings(docs, str(tmp_path), "v1")
    assert rows(first.select("key", "length", F.explode(F.arrays_zip("terms", "tfs")).alias("x")).select("x.terms", "key", "x.tfs")) == {("a", 1, 2), ("b", 1, 1), ("b", 2, 1)}
    assert retrieval.kept_postings(docs.limit(0), str(tmp_path), "v1").count() == 2
    assert retrieval.kept_postings(docs.limit(0), str(tmp_path), "v2").count() == 0
    assert rows(retrieval.bm25(docs, asked, 1, first)) == rows(retrieval.bm25(docs, asked, 1))


def test_gate_and_budget(spark):
    cols = "query int, question string, source string, order int, score double"
    low = [(1, "q", "mmr", 1, 0.29), (1, "q", "mmr", 2, 0.1), (1, "q", "bm25", 3, 0.0), (1, "q", "bm25", 4, 0.2)]
    none = [(2, "q", "mmr", 1, 0.1), (2, "q", "mmr", 2, 0.2)]
    silent = [(3, "", "mmr", i, 0.0) for i in range(1, 6)]
    high = [(4, "q", "mmr", 1, 0.3), (4, "q", "bm25", 2, 0.9)]
    got = retrieval.gate(spark.createDataFrame(low + none + silent + high, cols), 2)
    by = {}
    for r in got.orderBy("query", "rank").collect():
        by.setdefault(r["query"], []).append(r["order"])
    assert by == {1: [3, 4], 2: [2, 1], 3: [1, 2, 3, 4, 5], 4: [2, 1]}
    assert tuple(spark.range(1).select(*retrieval.budget(F.lit(True))).first()) == (6, 24)


# --- context ---------------------------------------------------------------------------------------------------------


def test_labels_and_citations(spark):
    df = spark.range(1)
    first, second = meta(source="/d/m.pdf", page=2, table_md=True), meta(image_path="/i/p.png", ocr=True)
    assert df.select(assembly.label(first, F.lit(1)), assembly.label(second, F.lit(2)), assembly.label(meta(), F.lit(3))).first()[:] == ("Source 1: m.pdf (table_md) (page 2)", "Source 2: p.png (from image) (ocr)", "Source 3: unknown")
    both = meta(source="/d/m.pdf", image_path="/i/p.png", ocr=True, page=4)  # text read from an image is named by the image
    assert df.select(assembly.label(both, F.lit(1)), assembly.label(meta(source="/d/m.pdf", image_path="/i/p.png"), F.lit(2))).first()[:] == ("Source 1: p.png (from image) (ocr) (page 4)", "Source 2: m.pdf")
    assert df.select(assembly.citation(first)).first()[0] == "m.pdf, page 2"
    assert df.select(assembly.citation_struct(second)).first()[0][0] == "/i/p.png"


def test_merge_by_page(spark):
    df = spark.createDataFrame([(1, 1, "a" * 10 + " b", "/s", 1), (1, 2, "x", None, None), (1, 3, "w " * 900, "/s", 1), (1, 4, None, None, None)], "query int, rank int, document string, s string, p int").withColumn("metadata", meta(source=F.col("s"), page=F.col("p"))).drop("s", "p")
    got = {r["source"]: r for r in assembly.merge_by_page(df).collect()}
    assert got[None]["text"] == "x" and got[None]["rank"] == 2
    assert len(got["/s"]["text"]) <= 1600 and got["/s"]["text"].startswith("aaaaaaaaaa b w") and got["/s"]["text"].endswith("w")


def test_page_images_stop_between_pages(spark):
    pages = spark.createDataFrame([(1, "/s", p, p) for p in (1, 2, 3, 4)] + [(2, None, 1, 1), (2, "/s", None, 2)], "query int, source string, page int, rank int")
    pictures = [("/s", p, f"/i/{p}{k}.png", 10 * p + k) for p, n in ((1, 4), (2, 3), (3, 1), (4, 3)) for k in range(n)] + [("/s", 1, None, 1), ("/s", 1, "", 2)]
    out = assembly.page_images(pages, spark.createDataFrame(pictures, "source string, page int, image_path string, o int"), "o")
    assert out.count() == 10 and out.where("query = 2").count() == 0
    some = spark.createDataFrame([("/s", 1, None, 1), ("/s", 1, "", 2), ("/s", 1, "/a", 3), ("/s", 1, "/b", 4)], "source string, page int, image_path string, o int")
    assert {r["image_path"] for r in assembly.page_images(pages, some, "o").collect()} == {"/a", "/b"}
    assert {r["image_path"] for r in assembly.page_images(pages, some, "o", pathless_count=True).collect()} == {"/a"}
    link = assembly.links(spark.createDataFrame([("/a b/é.png",)], "image_path string")).first()
    assert link["md_link"] == "[é.png](file:///a%20b/%C3%A9.png)"


def test_api_messages(spark):
    api = F.array(F.struct(F.lit("system").alias("role"), F.lit("s").alias("content")), F.struct(F.lit("user").alias("role"), F.lit("u").alias("content")))
    got = spark.range(1).select(assembly.api_messages(api, F.lit("ctx"), F.lit(True))).first()[0]
    assert [(m["role"], m["content"]) for m in got] == [("system", "s"), ("system", assembly.GUARD), ("system", assembly.FIGURE_GUARD), ("user", "ctx")]
