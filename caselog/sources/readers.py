"""Batch readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from caselog.sources.schemas import CORRUPT_COLUMN, with_corrupt_column


def stamp(df: DataFrame, run_id: str, loaded_at: str | None = None) -> DataFrame:
    """Add the load metadata to rows read from files.

    The batch id is a literal of the load, so it is one value however many rows, files or
    micro-batches the load has.
    """
    loaded = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return df.select(
        "*",
        loaded.alias("_loaded_at"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(run_id).alias("_batch_id"),
    )


def scan_ndjson(
    spark: SparkSession, path: str, schema: StructType, glob: str = "*.ndjson.gz"
) -> DataFrame:
    """Lines of JSON files whose names match. A line that does not parse becomes a row with NULLs
    and its text in _corrupt_record."""
    return (
        spark.read.schema(with_corrupt_column(schema))
        .option("pathGlobFilter", glob)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
    )


def scan_parquet(spark: SparkSession, path: str, schema: StructType, glob: str = "*.parquet") -> DataFrame:
    return spark.read.schema(schema).option("pathGlobFilter", glob).parquet(path)


def read_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A small CSV table with a header; the declared types win over what the text looks like."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def corrupt_rows(raw: DataFrame, file_col: str = "_source_file") -> DataFrame:
    """Rows and unparseable rows per file."""
    return raw.groupBy(file_col).agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col(CORRUPT_COLUMN).isNotNull()).alias("n_corrupt"),
    )


def explode_envelope(
    spark: SparkSession,
    path: str,
    schema: StructType,
    pulled_at: str,
    field: str = "results",
    glob: str = "*.json*",
) -> DataFrame:
    """One row per item of the array `field` of JSON documents {"meta": ..., field: [...]}.

    One document is one task's work, so it is the publisher's part size that bounds memory; the
    number of documents is not bounded.
    """
    document = StructType().add(field, ArrayType(schema))
    return (
        spark.read.schema(document)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", glob)
        .json(path)
        .select(F.inline(field))
        .withColumn("_pulled_at", F.lit(pulled_at))
    )


def read_xml_records(spark: SparkSession, path: str, row_tag: str, schema: StructType) -> DataFrame:
    """One row per XML element named row_tag."""
    return spark.read.format("xml").option("rowTag", row_tag).option("mode", "FAILFAST").schema(schema).load(path)


def descriptors_from_xml(spark: SparkSession, path: str, schema: StructType, pulled_at: str) -> DataFrame:
    """Vocabulary records; a record without tree numbers gets an empty array, not NULL."""
    records = read_xml_records(spark, path, "DescriptorRecord", schema)
    return records.select(
        F.col("DescriptorUI").alias("descriptor_ui"),
        F.col("DescriptorName.String").alias("descriptor_name"),
        F.coalesce(F.col("TreeNumberList.TreeNumber"), F.array().cast("array<string>")).alias("tree_numbers"),
        F.lit(pulled_at).alias("_pulled_at"),
    )


def leaf_types(schema: DataType, prefix: str = "") -> dict[str, str]:
    """Path -> type of the leaves of a schema; '[]' marks the items of an array."""
    if isinstance(schema, StructType):
        found: dict[str, str] = {}
        for f in schema.fields:
            found |= leaf_types(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)
        return found
    if isinstance(schema, ArrayType):
        return leaf_types(schema.elementType, f"{prefix}[]")
    return {prefix: schema.simpleString()}


def read_merged(spark: SparkSession, path: str, fmt: str = "json", glob: str = "*") -> DataFrame:
    """All files of a folder under the union of their fields."""
    reader = spark.read.option("pathGlobFilter", glob)
    return reader.option("mergeSchema", True).parquet(path) if fmt == "parquet" else reader.json(path)


def schema_drift(
    spark: SparkSession, path: str, declared: StructType, fmt: str = "json", glob: str = "*"
) -> DataFrame:
    """Fields whose type differs between the declaration and the files: undeclared ones have a NULL
    declared type, absent ones a NULL found type. Type inference is one distributed pass."""
    found = leaf_types(read_merged(spark, path, fmt, glob).schema)
    expected = leaf_types(declared)
    rows = [
        (field, expected.get(field), found.get(field))
        for field in sorted(expected.keys() | found.keys())
        if expected.get(field) != found.get(field)
    ]
    return spark.createDataFrame(rows, "path string, declared_type string, found_type string")


def field_usage(df: DataFrame, fields: list[str]) -> DataFrame:
    """How many rows have a value, per field and file: which files a drifted field came from."""
    counted = df.groupBy("_source_file").agg(*[F.count(F.col(f)).alias(f"n{i}") for i, f in enumerate(fields)])
    cells: list[Column] = []
    for i, f in enumerate(fields):
        cells += [F.lit(f), F.col(f"n{i}")]
    return counted.select("_source_file", F.stack(F.lit(len(fields)), *cells).alias("path", "n_rows")).where("n_rows > 0")
