"""Where intermediate tables go."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CODEC = "zstd"
"""Of a warehouse's tables and of what it keeps meanwhile: business keys and texts take
about half of what snappy needs."""
_made: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared one that the cluster names.

    Only a single-machine session without that setting gets a local folder, which goes
    when the program ends.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if shared:
        folder = f"{shared.rstrip('/')}/vaultloom-{uuid.uuid4().hex}"
        _made.append(folder)
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{CHECKPOINT_SETTING} must name a shared folder")
    folder = tempfile.mkdtemp(prefix="vaultloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def remove_scratch(spark: SparkSession) -> list[str]:
    """Delete the shared folders that this program took; results that read them are lost."""
    path_of, gone = spark._jvm.org.apache.hadoop.fs.Path, []
    while _made:
        folder = path_of(_made.pop())
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True):
            gone.append(folder.toString())
    return gone


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of plans that nothing refers to any more. It does so only
    when the driver's garbage is collected, which can be long after many times a load's size is on disk."""
    gc.collect()
    spark._jvm.System.gc()


def written(df: DataFrame, folder: str, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` and read it back: cuts the lineage and gives the planner sizes.
    ``codec``: how files are compressed, by default as the session has it."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)
