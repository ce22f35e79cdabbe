"""Bloom filters as bit strings inside a plan.

A filter is an array of 64-bit words that a scalar subquery computes once; the test is an expression,
so it can stand right above a scan, below the exchange of whatever is wide. It lets a few rows through
that are not members, so an exact join has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits and probes of one member: about one row in a hundred passes without being one.
BITS, PROBES = 10, 5
#: The longest filter, 16 MB; beyond its 13 million members more rows pass, none is lost.
MOST_WORDS = 1 << 21


def words_for(members: int) -> int:
    """Words of a filter for so many members, a power of two."""
    words = 16
    while words * 64 < members * BITS and words < MOST_WORDS:
        words *= 2
    return words


def _places(key: Column, words: int) -> list[Column]:
    """Bit numbers of a key. A struct or a NULL is a key like any other."""
    size = F.lit(words * 64).cast("long")
    first, step = F.pmod(F.xxhash64(key), size), F.pmod(F.xxhash64(key, F.lit(1)), size)
    return [F.pmod(first + step * i, size) for i in range(PROBES)]


def _mask(place: Column) -> Column:
    one, inside = F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int")
    return F.call_function("shiftleft", one, inside)


def bloom_filter(members: DataFrame, key: Column, words: int) -> Column:
    """The filter over the keys of ``members``, a subquery of ``words`` long numbers.

    Bits are combined map-side; at most ``words`` rows meet in the last step.
    """
    places = members.select(F.explode(F.array(*_places(key, words))).alias("place"))
    word = F.shiftright("place", 6)
    bits = places.select(word.alias("word"), _mask(F.col("place")).alias("bits"))
    none = members.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long"))
    whole = bits.unionAll(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    inside = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return whole.agg(F.transform(inside, lambda w: w["bits"]).alias("filter")).scalar()


def may_hold(filter_bits: Column, key: Column, words: int) -> Column:
    """False only for keys that are not in the filter."""
    found = F.lit(True)
    for place in _places(key, words):
        held = F.get(filter_bits, F.shiftright(place, 6).cast("int"))
        found = found & (held.bitwiseAND(_mask(place)) != 0)
    return found
