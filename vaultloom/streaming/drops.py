"""Load each announced drop once, in order.

Whoever delivers a drop puts its CSV files into a folder and then announces it
with a small JSON file ``{"load_ts": ..., "folder": ...}``. The announcements are
a file stream: its checkpoint remembers which drops are loaded, and a batch that
fails is offered again. A drop announced after a later one was loaded, or two folders
for one time, stop the stream: no drop is passed over. Only the announcements are streamed, not the feeds.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from vaultloom.plans.pipeline import LoadError, Settings, read_feeds, run_load
from vaultloom.sources.warehouse import Warehouse, load_id

ANNOUNCEMENT = "load_ts string, folder string"


def load_drops(
    spark: SparkSession, warehouse: Warehouse, announcements: str, checkpoint: str,
    settings: Settings,
) -> StreamingQuery:
    """Load every drop announced so far and not yet loaded, then stop."""
    def load_batch(batch: DataFrame, _batch_id: int) -> None:
        loaded, newest = warehouse.loaded(), warehouse.snapshot().load_id
        drops: dict[str, tuple[str, str]] = {}
        for drop in batch.distinct().collect():  # the lines of one small file
            this = load_id(drop.load_ts)
            if drops.setdefault(this, (drop.load_ts, drop.folder))[1] != drop.folder:
                raise LoadError(f"two folders are announced for {drop.load_ts}")
        for this in sorted(drops):
            load_ts, folder = drops[this]
            if this in loaded:
                continue  # announced again, or part of a batch that failed after this drop
            if this < newest:
                raise LoadError(f"drop {load_ts} is announced after a later one was loaded")
            feeds, rejected = read_feeds(spark, folder)
            run_load(spark, warehouse, feeds, replace(settings, load_ts=load_ts), rejected)

    return (
        spark.readStream.schema(ANNOUNCEMENT).option("maxFilesPerTrigger", 1)
        .json(announcements)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
