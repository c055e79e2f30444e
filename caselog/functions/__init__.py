"""Column functions. All are built-in expressions, so they stay inside code generation."""

from caselog.functions.arrays import (
    first_item,
    has_no_items,
    matching,
    n_items,
    shortest_variant,
)
from caselog.functions.dates import (
    calendar_columns,
    compact_date,
    date_key,
    date_precision,
    partial_date,
    pulled_at,
)
from caselog.functions.keys import surrogate_key
from caselog.functions.text import (
    clean_text,
    default_code,
    flag,
    key_prefix,
    name_source,
    version_int,
)

__all__ = [
    "calendar_columns",
    "clean_text",
    "compact_date",
    "date_key",
    "date_precision",
    "default_code",
    "first_item",
    "flag",
    "has_no_items",
    "key_prefix",
    "matching",
    "n_items",
    "name_source",
    "partial_date",
    "pulled_at",
    "shortest_variant",
    "surrogate_key",
    "version_int",
]
