"""Small helpers for building column expressions out of lambda functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``.

    Catalyst inlines an expression at every place it is referenced. A lambda variable is bound
    once per row, so a split or a sort used five times still runs once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def indexed(items: Column, value: Callable[[Column], Column]) -> Column:
    """``array<struct<v, i>>`` with ``value(item)`` and the zero-based position of each item."""
    return F.transform(items, lambda x, i: F.struct(value(x).alias("v"), i.alias("i")))


def run_starts(sorted_items: Column, key: Callable[[Column], Column]) -> Column:
    """Zero-based positions at which ``key`` changes in a sorted array, ascending."""
    changed = F.transform(
        sorted_items,
        lambda x, i: F.when((i == 0) | (key(x) != key(F.get(sorted_items, i - 1))), i),
    )
    return F.array_compact(changed)
