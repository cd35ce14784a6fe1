"""Ships this package to the executors, as spark-submit --py-files would, and finds the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = Path(__file__).resolve().parent


def ship(spark: SparkSession) -> SparkSession:
    """Make `catalogspark` importable in Python workers; once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_catalogspark_shipped", False):
        return spark
    target = Path(tempfile.mkdtemp(prefix="spark-")) / "catalogspark.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(_ROOT.rglob("*.py")):
            z.write(f, f"catalogspark/{f.relative_to(_ROOT)}")
    context.addPyFile(str(target))
    context._catalogspark_shipped = True
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a local session gets one of its own; a cluster must name one that all its machines see."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or getattr(context, "_catalogspark_folder", None)
    if folder is None:
        if not (context.master.startswith("local[") or context.master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = context._catalogspark_folder = Path(tempfile.mkdtemp(prefix="spark-")).as_uri()
    return folder


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over all cores, before work that is heavy a row: a file's row group is one task, however many rows it has."""
    return df.repartition(max(4 * df.sparkSession.sparkContext.defaultParallelism, 32))


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a table written to the shared folder; `release` deletes it."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete tables that `stored` wrote, once all that is made of them is stored itself."""
    for df in frames:
        if path := getattr(df, "_stored_at", None):
            session = df.sparkSession
            where = session._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
