"""The vector store: ids, table per base and kind, insertion of what isn't there yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from loomquill.operators.dedupe import image_rows
from loomquill.session import cut

PREFIX = {"text": "t", "images": "i", "image_pixels": "p"}


def positional_ids(rows: DataFrame, group: list[str], order: str, prefix: Column) -> DataFrame:
    """Adds ``position`` (from 0 within each group, by ``order``, which is unique in it) and ``id`` (prefix and position).

    Rows are sorted by range over the cluster; each partition numbers its own rows and adds the counts of the partitions
    before it, of which there is one small row per partition and group. No group is sorted in one task.
    """
    placed = cut(rows.repartitionByRange(*group, order).withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy("_part", *group).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    own = F.row_number().over(Window.partitionBy("_part", *group).orderBy(order)) - 1
    by = {c: f"_of_{c}" for c in ("_part", *group)}
    offsets = offsets.select("_before", *[F.col(c).alias(n) for c, n in by.items()])
    match = [F.col(c).eqNullSafe(F.col(n)) for c, n in by.items()]  # a null group is a group
    numbered = placed.withColumn("_own", own).join(offsets, match).drop(*by.values()).withColumn("position", F.col("_own") + F.col("_before"))
    return numbered.withColumn("id", F.concat(prefix, F.col("position").cast("string"))).drop("_part", "_own", "_before")


def content_id(base: Column, kind: Column, source: Column, page: Column, order: Column, document: Column) -> Column:
    """An id that doesn't depend on the rows beside it, so that ingesting again adds nothing. ``order`` is the place of a
    piece within its own document, not the document's number in a scan."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(x.cast("string"), F.lit("\x00")) for x in (base, kind, source, page, order, document)]), 256)


def store_rows(embedded: DataFrame, base: str = "default") -> DataFrame:
    """(ord, document, metadata, embedding, base, kind) from the embedded streams; images are one row per path, source and page."""
    text = embedded.where("stream = 'txt'").withColumn("kind", F.lit("text"))
    rank = F.when(F.col("stream") == "img_txt", 0).otherwise(1)
    images = image_rows(embedded.where("stream in ('img_txt', 'img_stub')").withColumn("_rank", rank), F.col("_rank"), F.col("ord"), embedded.columns).withColumn("kind", F.lit("images"))
    pixels = embedded.where("stream = 'img'").withColumn("kind", F.lit("image_pixels"))
    out = text.unionByName(images).unionByName(pixels)
    return out.select("ord", "document", "metadata", "embedding", F.lit(base).alias("base"), "kind")


def create(spark: SparkSession, name: str, path: str) -> None:
    """The table, unless it is there."""
    if not name.replace("_", "").isalnum():
        raise ValueError("a table's name must be letters, digits and underscores")
    from loomquill.schema import STORE_DDL

    quoted = path.replace("'", "''")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({STORE_DDL}) USING parquet OPTIONS (path '{quoted}') PARTITIONED BY (base, kind)")


def absent(new: DataFrame, there: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The rows of ``new`` whose key isn't in ``there``; of several with one key the first by ``order``."""
    first = F.min_by(F.struct(*new.columns), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("_first")
    once = new.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(first).select("_first.*")
    return once.join(there.select(*key).distinct(), key, "left_anti")


def insert_if_absent(new: DataFrame, path: str, order: list[Column] | None = None) -> int:
    """Appends what isn't in the table at ``path`` yet; gives the number of rows attempted. Ids are unique per base and kind.

    ``new`` is computed once: its rows are counted on their way. Only a table that isn't there counts as empty; any other
    error in reading it is raised.
    """
    spark = new.sparkSession
    key = ["base", "kind", "id"]
    try:
        there = spark.read.parquet(path).select(*key)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        there = spark.createDataFrame([], new.select(*key).schema)
    seen = Observation()
    absent(new.observe(seen, F.count(F.lit(1)).alias("rows")), there, key, order or [F.col("id")]).write.mode("append").partitionBy("base", "kind").parquet(path)
    return int(seen.get["rows"])


def jdbc_insert_if_absent(new: DataFrame, url: str, name: str, **options: str) -> int:
    """The same into a table (id, document, metadata, embedding) of a relational database, metadata as JSON and the vector as
    text. A database that refuses a key twice (a writer beside this one) fails the batch, which can be run again."""
    from loomquill.sources.files import jdbc_store

    there = jdbc_store(new.sparkSession, url, name, **options).select("id")
    seen = Observation()
    rows = absent(new.observe(seen, F.count(F.lit(1)).alias("rows")), there, ["id"], [F.col("id")])
    vector = F.concat(F.lit("["), F.array_join(F.transform("embedding", lambda x: x.cast("string")), ","), F.lit("]"))
    out = rows.select("id", "document", F.to_json("metadata").alias("metadata"), vector.alias("embedding"))
    out.write.format("jdbc").option("url", url).option("dbtable", name).options(**options).mode("append").save()
    return int(seen.get["rows"])
