"""Chunk rows: one row per chunk of a document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chunk_rows(df: DataFrame, keep: Sequence[str], chunks: Column) -> DataFrame:
    """``keep`` columns, the chunk's position ``pos`` and the ``chunk``. No shuffle.

    ``chunks`` is an ``array<string>`` expression such as those of
    :mod:`leafmill.functions.chunking`. Documents without chunks give no rows.
    """
    return df.select(*keep, F.posexplode(chunks).alias("pos", "chunk"))


def spread_chunks(rows: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Distribute chunk rows by document and position, so that no long document fills one task.

    With a number of ``partitions`` adaptive execution leaves it as it is; without one it may merge
    small partitions, which a slow model does not want.
    """
    spread = [key, "pos"]
    return rows.repartition(partitions, *spread) if partitions else rows.repartition(*spread)


def join_chunks(
    rows: DataFrame, key: Sequence[str], value: str, joiner: str, *also: Column
) -> DataFrame:
    """The inverse: values of one document in ``pos`` order, joined, as ``summary``.

    ``also`` are further aggregates of the same grouping. A document's values end up in one string,
    so a group is bounded by what one value may hold.
    """
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.col(value).alias("v"))))
    joined = F.array_join(F.transform(ordered, lambda x: x["v"]), joiner)
    return rows.groupBy(*key).agg(joined.alias("summary"), *also)
