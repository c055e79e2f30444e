"""Files of a folder into a table whose schema grows by itself, each file exactly once.

Beside the checkpoint lies the schema, a version of it for each time it has grown. A load that meets fields
nobody declared stores a version with them, typed, before it writes their first rows; rows of earlier loads
have NULL there. Nothing is parsed again when the table is read.
"""

from __future__ import annotations

import json
import re
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, DoubleType, NullType, StringType, StructField, StructType, VariantType

from caselog.sources.readers import stamp
from caselog.sources.schemas import CORRUPT_COLUMN, with_corrupt_column
from caselog.streaming.landing import DIGEST, METADATA

REST = "_rest"


# The schema and its versions


def grown(known: DataType, found: DataType) -> DataType:
    """The known type, and what fields the found one has beside it. What is known keeps its type."""
    if isinstance(known, StructType) and isinstance(found, StructType):
        more = {f.name: f.dataType for f in found.fields}
        fields = [StructField(f.name, grown(f.dataType, more.pop(f.name, f.dataType)), True, f.metadata) for f in known.fields]
        taken = {f.name.lower() for f in fields}
        return StructType(fields + [StructField(n, t) for n, t in more.items() if n.lower() not in taken])
    if isinstance(known, ArrayType) and isinstance(found, ArrayType):
        return ArrayType(grown(known.elementType, found.elementType), True)
    return known


def settled(kind: DataType) -> DataType | None:
    """The type a column of this JSON type gets, None if it is not known yet: no value has been seen.
    Numbers with a fraction are doubles, and whole ones beyond 64 bits and contradictory values are text."""
    if isinstance(kind, StructType):
        fields = [(f.name, settled(f.dataType)) for f in kind.fields]
        fields = [StructField(n, t) for n, t in fields if t is not None]
        return StructType(fields) if fields else None
    if isinstance(kind, ArrayType):
        inner = settled(kind.elementType)
        return None if inner is None else ArrayType(inner)
    if isinstance(kind, NullType):
        return None
    if isinstance(kind, DecimalType):
        return DoubleType() if kind.scale else StringType()
    return StringType() if isinstance(kind, VariantType) else kind


def fields_of(lines: DataFrame, column: str = "value") -> StructType:
    """The fields of all JSON lines, found by one aggregation over them; broken lines have none."""
    ddl = lines.select(F.schema_of_variant_agg(F.try_parse_json(column)).alias("ddl")).first()["ddl"] or "VOID"
    ddl = "`".join(part if i % 2 else re.sub(r"\bOBJECT\b", "STRUCT", part) for i, part in enumerate(ddl.split("`")))
    kind = settled(StructType.fromDDL(f"line {ddl}")["line"].dataType)
    return kind if isinstance(kind, StructType) else StructType()


def schema_versions(spark: SparkSession, checkpoint: str) -> list[StructType]:
    """All versions of the schema, the first one declared; none before the first load."""
    try:
        rows = spark.read.schema("value string, version int").text(f"{checkpoint}-schema", wholetext=True).orderBy("version").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [StructType.fromJson(json.loads(r.value)) for r in rows]


def _store(spark: SparkSession, checkpoint: str, schema: StructType, version: int) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{checkpoint}-schema/version={version}"
    )


def _grow(spark: SparkSession, checkpoint: str, found: StructType) -> StructType:
    """The schema with the found fields; stored, if it has grown."""
    versions = schema_versions(spark, checkpoint)
    schema = grown(versions[-1], found)
    if schema != versions[-1]:
        _store(spark, checkpoint, schema, len(versions))
    return schema


# Landing


def _json_rows(spark: SparkSession, batch: DataFrame, checkpoint: str) -> DataFrame:
    lines = batch.where(F.trim("value") != "")
    schema = with_corrupt_column(_grow(spark, checkpoint, fields_of(lines)))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    parsed = lines.withColumn("_parsed", F.from_json("value", schema, options))
    return parsed.select("_parsed.*", F.xxhash64("value").alias(DIGEST), *METADATA)


def _parquet_rows(spark: SparkSession, batch: DataFrame, checkpoint: str) -> DataFrame:
    """The batch's files read again with all their columns. Values whose declared type can't hold them stay
    as they are in `_rest`, a variant; it is NULL in all other rows."""
    paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(r[0])) for r in batch.select("_source_file").distinct().collect()]
    rows = spark.read.option("mergeSchema", True).parquet(*paths)
    schema = _grow(spark, checkpoint, rows.schema)
    columns, lost = [], []
    for f in schema.fields:
        if f.name not in rows.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f"`{f.name}`")
        if rows.schema[f.name].dataType == f.dataType:
            columns.append(c)
            continue
        typed = c.try_cast(f.dataType)
        columns.append(typed.alias(f.name))
        lost.append((f.name, c, c.isNotNull() & ~F.equal_null(typed.try_cast(rows.schema[f.name].dataType), c)))
    rest = F.lit(None).cast("variant")
    if lost:
        kept = F.struct(*[F.when(gone, c).alias(name) for name, c, gone in lost])
        rest = F.when(F.greatest(*[gone for _, _, gone in lost], F.lit(False)), F.to_variant_object(kept))
    loaded = batch.select("_loaded_at", "_batch_id").first()
    digest = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))).alias(DIGEST)
    return rows.select(
        *columns, rest.alias(REST), digest,
        F.lit(loaded["_loaded_at"]).alias("_loaded_at"), F.col("_metadata.file_path").alias("_source_file"), F.lit(loaded["_batch_id"]).alias("_batch_id"),
    )


def land_evolving(
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
    """Append the rows of files not ingested before, as `land` does, under a schema that grows.

    The declared schema starts the table. JSON lines that a column's type doesn't fit, and lines that don't
    parse, are kept whole in `_corrupt_record`; Parquet values that don't fit, in `_rest`. `_digest` is a
    hash of each record as it came, which tells rows apart that agree in pull time and file. Files of
    one batch must not contradict each other in the types of Parquet columns; that raises.

    Each batch of files is written to a folder of its own, which a retry replaces, and how many records came
    from each file is recorded beside it.
    """
    now = datetime.now(timezone.utc)
    if not schema_versions(spark, checkpoint):
        _store(spark, checkpoint, schema, 0)
    reader = (
        spark.readStream.format("text" if fmt == "json" else fmt)
        .option("pathGlobFilter", glob)
        .option("maxFileAge", max_file_age)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    reader = reader if fmt == "json" else reader.schema(schema)
    rows = stamp(reader.load(src_dir), run_id or now.strftime("%Y%m%d%H%M%S"), now.isoformat())
    rows = rows.select("value", *METADATA) if fmt == "json" else rows.select(*METADATA)

    def write(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        session = batch.sparkSession
        landed = _json_rows(session, batch, checkpoint) if fmt == "json" else _parquet_rows(session, batch, checkpoint)
        path = f"{out_dir}/rows/_load={number}"
        landed.write.mode("overwrite").parquet(path)
        counts = session.read.parquet(path).groupBy("_source_file").agg(F.count("*").alias("records"))
        counts.write.mode("overwrite").parquet(f"{out_dir}/counts/_load={number}")

    query = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def landed_evolving(spark: SparkSession, out_dir: str, checkpoint: str, fmt: str = "json") -> DataFrame:
    """The landed table under the newest version of its schema."""
    schema = schema_versions(spark, checkpoint)[-1]
    full = with_corrupt_column(schema) if fmt == "json" else StructType([*schema.fields]).add(REST, "variant")
    full = StructType([*full.fields]).add(DIGEST, "long")
    for name, kind in METADATA.items():
        full = full.add(name, kind)
    return spark.read.schema(full.add("_load", "integer")).parquet(f"{out_dir}/rows").drop("_load")


def recorded_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """(_source_file, records) as recorded when the files landed; no row of the table is read."""
    return spark.read.parquet(f"{out_dir}/counts").select("_source_file", "records")
