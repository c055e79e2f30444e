"""Files of a folder into an append-only table, each file exactly once."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caselog.sources.readers import stamp
from caselog.sources.schemas import CORRUPT_COLUMN, with_corrupt_column

RECORD, DIGEST = "_record", "_digest"
METADATA = {"_loaded_at": "timestamp", "_source_file": "string", "_batch_id": "string"}


def _parsed(text: Column, schema: StructType) -> Column:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    return F.from_json(text, with_corrupt_column(schema), options)


def land(
    spark: SparkSession,
    src_dir: str,
    schema: StructType,
    out_dir: str,
    checkpoint: str,
    fmt: str = "json",
    glob: str = "*",
    run_id: str | None = None,
    max_file_age: str = "36500d",
    files_per_batch: int = 10_000,
) -> None:
    """Append the rows of files not ingested before, stamped with the load metadata.

    The checkpoint remembers the files and must live and die with the output. A file is known by
    its path: one rewritten in place is not read again. Old files are taken too, whatever their
    age; by default Spark skips files much older than the newest it has seen.

    JSON records are kept whole: beside the declared fields, `_record` has the line as it came, with
    whatever fields nobody declared. `regrown` reads them from there. `_digest` is a hash of the line, which
    breaks ties between records of one pull time and file.

    The load goes in batches of files_per_batch files, so one that is interrupted resumes at the
    last batch that was committed. All its batches carry the same run id and load time.
    """
    now = datetime.now(timezone.utc)
    reader = (
        spark.readStream.format("text" if fmt == "json" else fmt)
        .option("pathGlobFilter", glob)
        .option("maxFileAge", max_file_age)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    reader = reader if fmt == "json" else reader.schema(schema)
    rows = stamp(reader.load(src_dir), run_id or now.strftime("%Y%m%d%H%M%S"), now.isoformat())
    if fmt == "json":
        lines = rows.where(F.trim("value") != "").withColumn("_parsed", _parsed(F.col("value"), schema))
        rows = lines.select("_parsed.*", F.col("value").alias(RECORD), F.xxhash64("value").alias(DIGEST), *METADATA)
    query = (
        rows.writeStream.format("parquet")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed(spark: SparkSession, out_dir: str, schema: StructType, fmt: str = "json") -> DataFrame:
    """The landed table. It is read through the sink's commit log, so files of a batch that failed
    are not seen."""
    columns = with_corrupt_column(schema) if fmt == "json" else StructType(list(schema.fields))
    full = StructType(list(columns.fields))
    if fmt == "json":
        full = full.add(RECORD, "string").add(DIGEST, "long")
    for name, kind in METADATA.items():
        full = full.add(name, kind)
    return spark.read.schema(full).parquet(out_dir)


def regrown(rows: DataFrame, schema: StructType) -> DataFrame:
    """The landed JSON rows under a schema that has grown, nested fields too: typed anew from the kept
    records, so no file is read again and rows of all loads have the new fields."""
    parsed = rows.withColumn("_parsed", _parsed(F.col(RECORD), schema))
    return parsed.select("_parsed.*", RECORD, DIGEST, *METADATA)
