"""Where work files go: the shared folder the session names, never a folder of one machine."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder of spark.checkpoint.dir. On a local master without one, as in tests, a folder under /tmp."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="caselog-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder nobody else uses; it is created by the first write."""
    return f"{shared_root(spark)}/caselog/{name}-{uuid.uuid4().hex}"


# Codec of tables as large as the case log, a quarter to a third smaller than in Spark's default one.
DENSE = "zstd"


def save(df: DataFrame, name: str, by: tuple[str, ...] = (), compression: str | None = None) -> DataFrame:
    """Write the frame as a table in the shared folder and return it as read back.

    For a result that several others are built from: it is computed once, its lineage ends here,
    it survives the loss of executors, and readers get column pruning, filter pushdown and, with
    `by`, partition pruning.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.partitionBy(*by).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
