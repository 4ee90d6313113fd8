"""Session helpers: test sessions, table loading and lineage cuts that survive lost executors."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and return it without its lineage.

    The folder is the one named by ``spark.checkpoint.dir``. Where that is unset, a temporary folder is made for a master on
    this machine (tests), and anything else is refused: the executors of a cluster share no local folder.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and context.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="loomquill-"))
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Let the Python workers import this package wherever they run: sends it once per application as a zip file."""
    context = spark.sparkContext
    if getattr(context, "_loomquill_shipped", False):
        return
    root = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    name = os.path.join(tempfile.mkdtemp(prefix="loomquill-"), "loomquill.zip")
    Path(name).write_bytes(packed.getvalue())
    context.addPyFile(name)  # Spark's file server hands it to the executors
    context._loomquill_shipped = True
