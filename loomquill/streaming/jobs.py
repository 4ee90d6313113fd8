"""The same plans over streams: files into the store, requests to replies.

Both drain what is there and stop (``availableNow``), or run on with a trigger. The file source's log in the checkpoint
folder remembers the paths seen, also over restarts; ``per_batch`` bounds what is taken at once, which holds back producers.
Ids depend on the content and absent ones only are added, so a batch that is run again adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomquill.config import EngineConfig
from loomquill.plans.pipeline import ingest
from loomquill.schema import DOCUMENT_DDL, REQUEST_DDL
from loomquill.operators.store import insert_if_absent


def documents(spark: SparkSession, folder: str, per_batch: int = 16) -> DataFrame:
    """A stream of JSON lines (page_content, metadata, ord) below a folder."""
    return spark.readStream.schema(f"ord bigint, {DOCUMENT_DDL}").option("maxFilesPerTrigger", per_batch).json(folder)


def requests(spark: SparkSession, folder: str, per_batch: int = 16) -> DataFrame:
    """A stream of JSON lines of requests below a folder, for ``serve_stream`` with ``pipeline.answer``."""
    return spark.readStream.schema(REQUEST_DDL).option("maxFilesPerTrigger", per_batch).json(folder)


def once_per_path(files: DataFrame, path: str = "path", event_time: str | None = None, late: str = "1 day") -> DataFrame:
    """Each path of a stream once; with an event time the state is dropped behind the watermark."""
    if event_time:
        return files.withWatermark(event_time, late).dropDuplicatesWithinWatermark([path])
    return files.dropDuplicates([path])


def ingest_stream(stream: DataFrame, store: str, checkpoint: str, config: EngineConfig | None = None, interval: str | None = None):
    """Runs every micro-batch through the ingest plan and adds what the store doesn't have."""

    def batch(rows: DataFrame, _: int) -> None:
        insert_if_absent(ingest(rows, "ord", config), store)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def serve_stream(stream: DataFrame, answer: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, interval: str | None = None):
    """Answers each micro-batch of requests with one plan and writes the replies, one folder per batch (written again alike)."""

    def batch(rows: DataFrame, n: int) -> None:
        answer(rows).write.mode("overwrite").parquet(f"{out}/batch={n}")

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts per tumbling window and key, with late rows up to the watermark."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), key).count()
