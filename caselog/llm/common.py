"""Column helpers the operators share. All of them are Spark expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.session import configure

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def ascii_lower(word: Column) -> Column:
    """A-Z in lower case, all else as it is. For short strings: `translate` takes each character by itself."""
    return (
        F.when(F.octet_length(word) == F.length(word), F.lower(word))
        .when(word.rlike("[A-Z]"), F.translate(word, UPPER, LOWER))
        .otherwise(word)
    )


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; the fold of a document. A null id counts as empty text."""
    return F.crc32(or_empty(doc_id)) % n


def row_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Two hashes that together tell rows of (doc_id, text) apart; nulls count as empty text."""
    doc_id, text = or_empty(doc_id), or_empty(text)
    return F.xxhash64(doc_id, text), F.xxhash64(text, F.lit("/"), doc_id)


def staged(df: DataFrame, *steps: dict[str, Column | Callable]) -> DataFrame:
    """Add columns step by step; a step may use the columns of those before it."""
    for step in steps:
        df = df.withColumns(step)
    return df


def sealed(df: DataFrame) -> DataFrame:
    """The same rows, whose columns later filters use as they are.

    Spark moves a filter below a projection by copying the projection's expressions into it, and with
    array functions nested in each other that can repeat them for every element. A filter isn't moved
    below a generator.
    """
    return df.select(F.inline(F.array(F.struct("*"))))


def running_sum(values: Column, block: int = 128) -> Column:
    """Sums of all elements before each one, and the total at the end: an array of size + 1.

    Sums run within blocks and over the blocks, so that a long array costs no quadratic copying.
    """
    zero = F.lit(0).cast("bigint")

    def sums(array: Column, start: Column) -> Column:
        return F.aggregate(
            array,
            F.array(start),
            lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)),
        )

    n_blocks = F.ceil(F.size(values) / block).cast("int")
    starts = F.when(n_blocks > 0, F.sequence(F.lit(0), n_blocks - 1)).otherwise(F.array().cast("array<int>"))
    blocks = F.transform(starts, lambda b: F.slice(values, b * block + 1, block))
    totals = F.transform(blocks, lambda v: F.aggregate(v, zero, lambda acc, x: acc + x))
    offsets = sums(totals, zero)
    inner = F.zip_with(
        blocks,
        F.slice(offsets, F.lit(1), n_blocks),
        lambda v, start: F.slice(sums(v, start), F.lit(1), F.size(v)),
    )
    return F.concat(F.flatten(inner), F.array(F.element_at(offsets, -1)))


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators; batches for Python stay small where texts are long."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def run_query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return function(spark, sf_dir)

    return run
