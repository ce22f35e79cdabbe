"""Model-free text embedding: hashed word counts in a fixed number of buckets, as expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.binding import let, run_starts
from leafmill.functions.summary import words

# Fixed value: two hexadecimal digits of the word's MD5 give the bucket.
BUCKETS = 256


def word_bucket(word: Column) -> Column:
    """Bucket 0..255 of a word."""
    return F.conv(F.substring(F.md5(word), 1, 2), 16, 10).cast("int")


def _sparse_counts(text: Column) -> Column:
    """``array<struct<b, n>>``: the buckets that occur, ascending, with their word counts."""
    hits = F.sort_array(F.transform(words(text), word_bucket))

    def runs(ordered: Column) -> Column:
        return let(
            run_starts(ordered, lambda b: b),
            lambda starts: F.transform(
                starts,
                lambda at, k: F.struct(
                    F.get(ordered, at).alias("b"),
                    (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - at).alias("n"),
                ),
            ),
        )

    return let(F.coalesce(hits, F.array().cast("array<int>")), runs)


def _dense(sparse: Column, value: Callable[[Column], Column], zero: Column) -> Column:
    """All buckets in order: gaps between the occurring ones are filled with ``zero``."""

    def bucket(k: Column) -> Column:
        return F.coalesce(F.get(sparse, k)["b"], F.lit(-1))

    def with_gap(e: Column, k: Column) -> Column:
        return F.array_append(F.array_repeat(zero, e["b"] - bucket(k - 1) - 1), value(e))

    tail = F.array_repeat(zero, F.lit(BUCKETS - 1) - bucket(F.size(sparse) - 1))
    return F.concat(F.flatten(F.transform(sparse, with_gap)), tail)


def bucket_counts(text: Column) -> Column:
    """``array<int>`` of 256 word counts; all zero for NULL."""
    return let(_sparse_counts(text), lambda s: _dense(s, lambda e: e["n"], F.lit(0)))


def hashed_embedding(text: Column) -> Column:
    """``array<float>``: word counts divided by their Euclidean length; zeros without words."""

    def unit(sparse: Column) -> Column:
        squares = F.aggregate(
            sparse, F.lit(0).cast("long"), lambda a, e: a + e["n"].cast("long") * e["n"]
        )
        return let(
            F.sqrt(squares),
            lambda norm: _dense(
                sparse, lambda e: (e["n"] / norm).cast("float"), F.lit(0.0).cast("float")
            ),
        )

    return let(_sparse_counts(text), unit)
