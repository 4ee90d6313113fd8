"""Sources, extraction, whole plans and streams."""

import json

from pyspark.sql import functions as F

from loomquill.config import EngineConfig
from loomquill.operators import embedding
from loomquill.plans.pipeline import answer, ingest, retrieve
from loomquill.schema import META_DDL
from loomquill.sources import extract, files
from loomquill.streaming import jobs


def provider():
    """Made in a function, so that it is sent to the workers by value."""

    class Pages(extract.Extractor):
        def pages(self, content):
            if content.startswith(b"bad"):
                raise ValueError("unreadable")
            return content.decode().split("\f")

        def tables(self, content):
            return [(1, ["a", None], [["1", None]])]

        def images(self, content):
            return [{"page": 1, "xref": 4, "rect": "0,0,9,9", "width": 99, "height": 400, "ocr": "", "vision_label": "chart", "content": b"x"}]

        def spans(self, content):
            return [("seen", 0.9), ("blurred", 0.1), ("plain", None)]

    return Pages()


def test_folder(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, data in {"a.txt": b"plain text", "sub/b.MD": b"# Head", "c.pdf": b"one\x0c \x0ctwo", "d.PDF": b"bad file", "e.png": b"img", "f.html": b"no", "noext": b"no"}.items():
        (tmp_path / name).write_bytes(data)
    found = files.scan(spark, str(tmp_path))
    assert {(r["path"].rpartition("/")[2], r["route"]) for r in found.collect()} == {("a.txt", "text"), ("b.MD", "text"), ("c.pdf", "pdf"), ("d.PDF", "pdf"), ("e.png", "image")}
    docs = files.text_documents(found).collect()
    assert {d["page_content"] for d in docs} == {"plain text", "# Head"} and all(d["metadata"]["source"].startswith("/") and d["metadata"]["page"] is None for d in docs)
    pages = {(r["page"], r["page_content"], r["error"]) for r in extract.page_texts(found, provider()).collect()}
    assert pages == {(1, "one", None), (3, "two", None), (None, "bad file", "unreadable")}
    assert extract.tables(found, provider()).count() == 2 and extract.embedded_images(found, provider()).count() == 2
    read = extract.image_readings(found, provider()).collect()
    assert [r["ocr"] for r in read] == ["seen plain"]


def plain_pdf(pages, compress=True, tree=True):
    """A hand-made PDF file: one content stream for each page, and a JPEG on the first one."""
    import zlib

    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 3: b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>"}
    objects[4] = b"<< /Type /XObject /Subtype /Image /Width 200 /Height 100 /Filter /DCTDecode /Length 4 >>\nstream\n\xff\xd8\xff\xd9\nendstream"
    kids = []
    for i, text in enumerate(reversed(pages)):  # later pages first in the file
        n = 10 + 2 * i
        data = zlib.compress(text) if compress else text
        objects[n] = b"<< /Length %d%s >>\nstream\n%s\nendstream" % (len(data), b" /Filter /FlateDecode" if compress else b"", data)
        objects[n + 1] = b"<< /Type /Page /Parent 2 0 R /Resources << /Font << /F1 3 0 R >> /XObject << /I 4 0 R >> >> /Contents %d 0 R >>" % n
        kids.insert(0, b"%d 0 R" % (n + 1))
    objects[2] = b"<< /Type /Pages /Count %d /Kids [%s] >>" % (len(kids), b" ".join(kids))
    return b"%PDF-1.4\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % x for x in objects.items()) + b"trailer << /Root 1 0 R >>\n%%EOF"


PAGES = [rb"BT /F1 12 Tf 72 700 Td (Pump \(new\) m\374de) Tj 0 -14 Td [(The v) 20 (alve) -300 (opens)] TJ T* <4142> Tj ET", b"BT (Second page with enough words) Tj ET"]


def test_plain_pdf():
    from loomquill.sources.pdf import PlainPdf

    for compress in (True, False):
        content = plain_pdf(PAGES, compress)
        assert PlainPdf().pages(content) == ["Pump (new) m\u00fcde\nThe valve opens\nAB", "Second page with enough words"]
        assert [(i["page"], i["width"], i["height"], i["content"]) for i in PlainPdf().images(content)] == [(1, 200, 100, b"\xff\xd8\xff\xd9"), (2, 200, 100, b"\xff\xd8\xff\xd9")]
    for bad in (b"", b"no pdf", b"%PDF-1.4 /Encrypt 5 0 R", plain_pdf(PAGES).replace(b"/Type1", b"/Type0")):
        try:
            pages = PlainPdf().pages(bad)
        except ValueError:
            continue
        raise AssertionError(pages)
    assert PlainPdf().whole(plain_pdf(PAGES)).startswith("Second page")


def test_folder_to_documents(spark, tmp_path):
    from loomquill.plans.extraction import documents as read_folder
    from loomquill.sources.pdf import PlainPdf

    def reader():
        class Seen(PlainPdf):
            def tables(self, content):
                return [(2, ["a", None], [["1", " x "], ["a", ""]])]

            def spans(self, content):
                return [("seen text", 0.9)] if content.startswith(b"img") else []

            def caption(self, content):
                return "a valve" if content.startswith(b"img") else ""

        return Seen()

    for name, data in {"a.txt": b"plain text", "m.pdf": plain_pdf(PAGES), "bad.pdf": b"no pdf", "e.png": b"img", "f.html": b"no"}.items():
        (tmp_path / name).write_bytes(data)
    found = read_folder(spark, str(tmp_path), reader(), EngineConfig(image_store_folder="/img"))
    got = [(r["page_content"], r["metadata"]) for r in found.orderBy("ord").collect()]
    texts = {t for t, _ in got}
    assert {"plain text", "Second page with enough words", "Row -> a: 1, : x", "a valve • seen text"} <= texts and any(t.startswith("| a |  |") for t in texts)
    page = next(m for t, m in got if t.startswith("Pump"))
    assert page["source"] == str(tmp_path / "m.pdf") and page["page"] == 1 and page["source_type"] == "text"
    image = next(m for t, m in got if t.startswith("a valve"))
    assert image["image_path"] == str(tmp_path / "e.png") and image["caption"] and image["ocr"] and not image["chartqa"]
    assert len(got) == found.select("ord").distinct().count()
    stored = ingest(found, "ord")
    assert stored.where("kind = 'images'").count() == 1 and stored.where("document = 'Second page with enough words'").count() == 1
    again = ingest(found.withColumn("ord", F.struct(F.lit("x").alias("path"), "ord.page", "ord.kind", "ord.at", "ord.part")), "ord")
    assert {r["id"] for r in again.select("id").collect()} == {r["id"] for r in stored.select("id").collect()}  # ids don't depend on the scan


def test_providers_by_name():
    import pytest

    assert embedding.PROVIDERS["hash-256"]().encode(["a"]).shape == (1, 256)
    with pytest.raises(ValueError):
        embedding.encoder("none such")


def test_bundle_and_parsing(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps({"text_docs": [{"page_content": "x", "metadata": {"source": "/s", "page": 2}}], "source_dir": "/d"}))
    got = files.bundle(spark, str(tmp_path / "b.json")).collect()
    assert len(got) == 1 and got[0]["metadata"]["page"] == 2
    df = spark.createDataFrame([('{"source": "/a", "page": 1}',), ("{'source': '/b', 'caption': True, 'page': None}",), ("nonsense",), (None,)], "t string")
    parsed = [r[0] for r in df.select(files.parse_metadata(F.col("t"))).collect()]
    assert parsed[0]["source"] == "/a" and parsed[1]["source"] == "/b" and parsed[1]["caption"] is True and parsed[2]["source"] is None and parsed[3]["source"] is None
    assert spark.range(1).select(files.parse_embedding(F.lit("[1, 2.5]"))).first()[0] == [1.0, 2.5]


def documents(spark):
    table = [(i, f"# Pump {i}\n\nThe pump number {i} must be cleaned every week by the operator.", "/m.pdf", i, None) for i in range(6)]
    table += [(10, "a chart of pump flow over time", "/m.pdf", 2, "/i/c.png"), (11, "a chart of pump flow over time", "/m.pdf", 2, "/i/c.png")]
    df = spark.createDataFrame(table, "ord long, page_content string, s string, p int, i string")
    m = F.from_json(F.lit("{}"), META_DDL).withField("source", F.col("s")).withField("page", F.col("p")).withField("image_path", F.col("i"))
    return df.select("ord", "page_content", m.alias("metadata"))


def test_ingest_and_retrieve(spark):
    stored = ingest(documents(spark), "ord")
    assert stored.where("kind = 'text'").count() == 6 and stored.where("kind = 'images'").count() == 1
    assert stored.select("id").distinct().count() == 7
    keyed = stored.withColumn("key", F.xxhash64("id"))
    encode = embedding.encoder()
    asked = spark.createDataFrame([(1, "How is pump number 3 cleaned?"), (2, "")], "request_id long, message string")
    empty = F.array().cast("array<struct<role:string,content:string>>")
    requests = asked.withColumn("embeddings", F.when(F.col("message") != "", encode(F.col("message")))).withColumn("api", empty)
    pictures = spark.createDataFrame([(1, "/m.pdf", 3, "/i/c.png")], "key long, source string, page int, image_path string")
    got = {r["request_id"]: r for r in retrieve(requests, keyed, pictures).collect()}
    assert got[1]["status"] == "ok" and got[2]["status"] == "no embeddings"
    assert "number 3" in got[1]["value"][0]["document"][0] and "Citation(s):" in got[1]["api"][-1]["content"]


def test_retrieve_gives_as_many_hits_as_configured(spark):
    table = [(i, f"The pump number {i} must be cleaned every week by the operator.", "/m.pdf", i) for i in range(1, 15)]
    df = spark.createDataFrame(table, "ord long, page_content string, s string, p int")
    m = F.from_json(F.lit("{}"), META_DDL).withField("source", F.col("s")).withField("page", F.col("p"))
    keyed = ingest(df.select("ord", "page_content", m.alias("metadata")), "ord").withColumn("key", F.xxhash64("id"))
    asked = spark.createDataFrame([(1, "pump cleaned every week by the operator")], "request_id long, message string")
    requests = asked.withColumn("embeddings", embedding.encoder()(F.col("message"))).withColumn("api", F.array().cast("array<struct<role:string,content:string>>"))
    pictures = spark.createDataFrame([], "key long, source string, page int, image_path string")
    got = retrieve(requests, keyed, pictures, EngineConfig(top_k=10)).first()
    assert sum(len(v["document"]) for v in got["value"]) == 10


def test_stateful_streams(spark, tmp_path):
    rows = [(f"/p{i % 3}", f"2024-01-01 0{i % 3}:30:00") for i in range(9)]
    spark.createDataFrame(rows, "path string, t string").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("path string, t timestamp").json(str(tmp_path / "in"))
    for name, df, mode in (("once", jobs.once_per_path(stream), "append"), ("counts", jobs.windowed_counts(stream, "t", "path"), "complete")):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(120)
    assert spark.table("once").count() == 3
    assert sorted(r["count"] for r in spark.table("counts").collect()) == [3, 3, 3]


def test_streams(spark, tmp_path):
    for d in ("in", "store", "log", "ask", "out"):
        (tmp_path / d).mkdir()
    p = lambda *x: str(tmp_path.joinpath(*x))
    documents(spark).write.mode("append").json(p("in"))
    jobs.ingest_stream(jobs.documents(spark, p("in")), p("store", "t"), p("log", "1")).awaitTermination(120)
    n = spark.read.parquet(p("store", "t")).count()
    assert n == 7
    documents(spark).write.mode("append").json(p("in"))  # the same again under other names
    jobs.ingest_stream(jobs.documents(spark, p("in")), p("store", "t"), p("log", "1")).awaitTermination(120)
    jobs.ingest_stream(jobs.documents(spark, p("in")), p("store", "t"), p("log", "other")).awaitTermination(120)
    assert spark.read.parquet(p("store", "t")).count() == n
    lines = [{"metadata": {"requestId": "7", "user": "u"}, "api": [{"role": "system", "content": "be brief"}, {"role": "user", "content": "How is pump number 3 cleaned?"}]}, {"request_id": "8", "text": " "}, {"request_id": "9", "text": "pump number 5"}]
    (tmp_path / "ask" / "1.json").write_text("\n".join(json.dumps(x) for x in lines))
    stored = spark.read.parquet(p("store", "t")).withColumn("key", F.xxhash64("id"))
    pictures = spark.createDataFrame([(1, "/m.pdf", 3, "/i/c.png")], "key long, source string, page int, image_path string")
    jobs.serve_stream(jobs.requests(spark, p("ask")), lambda r: answer(r, stored, pictures), p("out"), p("log", "2")).awaitTermination(240)
    got = {r["request_id"]: r for r in spark.read.parquet(p("out")).collect()}
    assert set(got) == {7, 9} and all(r["status"] == "ok" and r["requestId"] == k for k, r in got.items())  # a request without a question is dropped
    assert got[7]["metadata"] == {"requestId": "7", "user": "u"} and got[9]["metadata"] == {}
    assert "number 3" in got[7]["value"][0]["document"][0] and got[7]["api"][0]["content"] == "be brief" and [m["role"] for m in got[7]["api"]][-1] == "user"
