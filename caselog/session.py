"""Session settings the operators are written for."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

SPLIT_BYTES = 16 << 20


def in_bytes(size: str) -> int:
    """A size as Spark's settings state it: a number, and maybe a unit."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]?)(?:i?b)?", size.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}[unit]


def configure(spark: SparkSession) -> None:
    """Pin semantics and two tuning settings; all of them can change in a running session.

    ANSI casts and times in UTC. Wide staging projections generate
    methods larger than the 8000 bytes of bytecode the JVM compiles; with this limit Spark splits
    them instead of having them interpreted. A row of nested records takes tens of times the bytes it has in
    a columnar file, so files are read in splits whose rows a task can sort in memory; a smaller setting stays.
    """
    spark.conf.set("spark.sql.ansi.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    if in_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")) > SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
