"""File streams into bronze and the warehouse; the checkpoint is the watermark."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from .. import schemas
from ..operators import clean
from ..plans.warehouse import load_dimensions, load_facts
from ..sources.files import CORRUPT, read_source
from ..sources.incremental import quarantine
from ..sources.lake import Lake


def stream_bronze(spark: SparkSession, src: str, lake: Lake, source: str, checkpoint: str,
                  run_id: str = "stream", schema: StructType | None = None,
                  file_format: str = "csv") -> StreamingQuery:
    """New files of ``src`` into ``bronze/<source>``, each file once, then stop.

    CSV files of the known feeds are matched by the header of each file and read as text with
    missing-value tokens turned to NULL; malformed lines go to ``quarantine/<source>``. Other formats
    and feeds need their ``schema``. Every micro-batch has its own partition, so a batch that is
    retried replaces itself.
    """
    if file_format == "csv":
        wanted = schema or schemas.layout(source)
        # the stream says which files are new; each batch then reads its files by name of column
        rows = spark.readStream.format("text").load(src).select(F.col("_metadata.file_path").alias("_file"))

        def land(batch: DataFrame, batch_id: int) -> None:
            files = [unquote(r["_file"]) for r in batch.distinct().collect()]  # one short row per file
            if not files:
                return
            run = f"{run_id}-{batch_id:09d}"
            read = read_source(batch.sparkSession, files, wanted, position=True)
            lake.replace_partition(read.where(F.col(CORRUPT).isNull()).drop(CORRUPT), "bronze", source, "run_id", run)
            quarantine(read.where(F.col(CORRUPT).isNotNull()), lake, source, run)
    else:
        rows = spark.readStream.format(file_format).schema(schema or schemas.layout(source)).load(src).select(
            "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))

        def land(batch: DataFrame, batch_id: int) -> None:
            batch = batch.withColumn("_pos", F.monotonically_increasing_id())
            lake.replace_partition(batch, "bronze", source, "run_id", f"{run_id}-{batch_id:09d}")

    return rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()


def stream_warehouse(spark: SparkSession, lake: Lake, source: str, checkpoint: str,
                     load_ts: Callable[[int], str | datetime] | str | datetime | None = None,
                     run_id: str = "stream") -> StreamingQuery:
    """New bronze files of a feed cleaned and merged into the warehouse, batch by batch.

    Merges find no change and fact loads find no new key when a batch is repeated, so a
    retried batch leaves the warehouse as it is.
    """
    stored = lake.read("bronze", source)
    layout = StructType([f for f in stored.schema if f.name != "run_id"])
    rows = spark.readStream.schema(layout).parquet(lake.path("bronze", source))

    def merge(batch: DataFrame, batch_id: int) -> None:
        run = f"{run_id}-{source}-{batch_id:09d}"
        silver = clean.clean_delivery(batch.drop("run_id"), source)
        clean.write_silver(lake, silver, source, run)
        at = load_ts(batch_id) if callable(load_ts) else load_ts or datetime.now().replace(microsecond=0)
        if source in ("crm_customers", "products"):
            load_dimensions(lake, run, at)
        else:
            load_facts(lake, run)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
