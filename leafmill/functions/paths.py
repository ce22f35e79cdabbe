"""Expressions over file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.binding import let

# The fields of a path, in order.
PATH_FIELDS = ("item", "category", "author", "title", "filetype")


def has_suffix(path: Column, suffix: str) -> Column:
    """Case-sensitive test of the end of the path."""
    return F.endswith(path, F.lit(suffix))


def has_substring(path: Column, part: str) -> Column:
    """Case-sensitive test for ``part`` anywhere in the path."""
    return F.contains(path, F.lit(part))


def path_fields(path: Column) -> Column:
    """``.../<item>/<category>/<author>/<title>.<filetype>`` as a struct.

    The last segment is cut at dots: piece 0 is the title, piece 1 the file type. A segment or
    piece that does not exist gives NULL.
    """

    def fields(segments: Column) -> Column:
        pieces = F.split(F.try_element_at(segments, F.lit(-1)), "[.]")
        return F.struct(
            F.try_element_at(segments, F.lit(-4)).alias("item"),
            F.try_element_at(segments, F.lit(-3)).alias("category"),
            F.try_element_at(segments, F.lit(-2)).alias("author"),
            F.try_element_at(pieces, F.lit(1)).alias("title"),
            F.try_element_at(pieces, F.lit(2)).alias("filetype"),
        )

    return let(F.split(path, "/"), fields)


def path_tail(path: Column) -> Column:
    """Remove every ``..``, split on ``/`` and drop the first piece."""
    return let(
        F.split(F.replace(path, F.lit(".."), F.lit("")), "/"),
        lambda pieces: F.slice(pieces, 2, F.size(pieces)),
    )
