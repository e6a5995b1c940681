"""Session set-up and the shared work area used to cut long lineages."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


KEPT = {"compression": "zstd"}  # Parquet that stays in a lake; a third smaller than with the session's own codec


def get_session(app: str = "bazaarline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``conf`` entries win."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only in local mode, where all tasks share one disk, a temporary folder is made if none is
    named, and remembered in the session, so later calls agree on it. A cluster must name one:
    elsewhere every executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.conf.get("spark.bazaarline.shared.dir", None)
    if not named:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        named = "file:" + tempfile.mkdtemp(prefix="bazaarline-")
        spark.conf.set("spark.bazaarline.shared.dir", named)
    return named


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and gives the
    optimiser the true size of the result for its later join choices.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "bazaarline", f"{label}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.written_to = path
    return kept


def discard(df: DataFrame) -> None:
    """Remove what ``materialise`` wrote for ``df``, once nothing will read it again; any other frame is left alone."""
    path = getattr(df, "written_to", None)
    if path is not None:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def counted(df: DataFrame, **metrics) -> tuple[DataFrame, Observation]:
    """``df`` with its row count (and further aggregates) observed by the next action on it."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in metrics.items()]), seen


def row_count(seen: Observation, df: DataFrame) -> int:
    """Rows of the observed action. Spark drops the counter where it finds the input empty."""
    try:
        return seen.get["rows"]
    except Py4JJavaError:
        return 0 if df.isEmpty() else df.count()
