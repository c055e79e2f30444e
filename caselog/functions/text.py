"""Casts, defaults and normalisation of coded and free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NO_CODE = "-1"
NO_SUSPECT = "NO SUSPECT DRUG REPORTED"
NO_TERM = "NOT STATED"
SOURCE_HARMONISED = "openfda_generic"
SOURCE_VERBATIM = "medicinalproduct"
SOURCE_NONE = "none"
DRUG_NAME_SOURCES = ["openfda_generic", "medicinalproduct", "none"]


def version_int(c: Column, strict: bool = True) -> Column:
    """Version text as an integer, so that 103 sorts after 9. strict raises on text that is no number."""
    return c.cast("int") if strict else c.try_cast("int")


def key_prefix(c: Column) -> Column:
    """Leading capital letters of a key; '' where there are none."""
    return F.regexp_extract(c, "^([A-Z]+)", 1)


def clean_text(c: Column, default: str | None = None) -> Column:
    """Trimmed upper-case text; blank counts as missing and takes the default."""
    cleaned = F.nullif(F.upper(F.trim(c)), F.lit(""))
    return cleaned if default is None else F.coalesce(cleaned, F.lit(default))


def default_code(c: Column, default: str = NO_CODE) -> Column:
    return F.coalesce(c, F.lit(default))


def flag(c: Column, on: str = "1") -> Column:
    """Coded flag as a boolean; a missing code is false."""
    return F.coalesce(c == on, F.lit(False))


def name_source(suspect: Column) -> Column:
    """Which field of a suspect drug its name is taken from."""
    return (
        F.when(suspect.isNull(), SOURCE_NONE)
        .when(suspect["openfda"]["generic_name"].isNotNull(), SOURCE_HARMONISED)
        .otherwise(SOURCE_VERBATIM)
    )
