"""Array columns, handled without exploding them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def matching(arr: Column, predicate: Callable[[Column], Column]) -> Column:
    """Items for which the predicate is true; NULL array stays NULL."""
    return F.filter(arr, predicate)


def n_items(arr: Column) -> Column:
    """Item count; NULL for a NULL array, whatever the session's settings."""
    return F.array_size(arr)


def first_item(arr: Column) -> Column:
    """First item, NULL for an empty or NULL array."""
    return F.try_element_at(arr, F.lit(1))


def shortest_variant(arr: Column) -> Column:
    """Shortest text of the array, ties by text. Lengths are taken before any trimming.

    A minimum over (length, text) pairs: one pass, no sort, NULL items ignored.
    """
    sized = F.transform(
        F.filter(arr, lambda x: x.isNotNull()),
        lambda x: F.struct(F.length(x).alias("n"), x.alias("text")),
    )
    return F.array_min(sized)["text"]


def has_no_items(arr: Column) -> Column:
    """True for a NULL or an empty array."""
    return arr.isNull() | (F.array_size(arr) == 0)
