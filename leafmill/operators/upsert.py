"""Upsert by key as a DataFrame job: set the given columns, keep the others, insert if absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _merge_maps(old: Column, new: Column) -> Column:
    kept = F.map_filter(old, lambda k, _v: ~F.array_contains(F.map_keys(new), k))
    return F.when(old.isNull(), new).when(new.isNull(), old).otherwise(F.map_concat(kept, new))


def _collapse(
    batch: DataFrame, key: Column, plain: Sequence[str], seq: str, maps: Sequence[str]
) -> DataFrame:
    """``_key`` and one value per column, all partitioned by ``_key``."""
    keyed = batch.select(key.alias("_key"), seq, *plain, *maps)
    result = keyed.groupBy("_key").agg(
        F.max(seq).alias("_newest"),
        *(F.max_by(c, seq).alias(c) for c in plain),
        *(F.max(F.col(m).isNotNull()).alias(f"_has_{m}") for m in maps),
    )
    result = result.drop("_newest")
    for name in maps:
        entries = keyed.select("_key", seq, F.explode(name).alias("_k", "_v"))
        newest = entries.groupBy("_key", "_k").agg(
            F.max_by(F.struct(F.col("_v").alias("v")), F.col(seq)).alias("_s")
        )
        folded = newest.groupBy("_key").agg(
            F.map_from_entries(
                F.array_sort(F.collect_list(F.struct("_k", F.col("_s.v").alias("v"))))
            ).alias(name)
        )
        none = F.create_map().cast(batch.schema[name].dataType)
        result = result.join(folded, "_key", "left").select(
            *(c for c in result.columns if c != f"_has_{name}"),
            F.when(F.col(f"_has_{name}"), F.coalesce(name, none)).alias(name),
        )
    return result


def collapse(
    batch: DataFrame, key: Sequence[str], seq: str, maps: Sequence[str] = ()
) -> DataFrame:
    """One row per key, as if the batch's items were applied one by one in ``seq`` order.

    The last item gives the plain columns. Of the ``maps`` columns each entry is taken from the
    last item that has it. Both are reduced map-side before the shuffle, so a key with very many
    items sends one row (per map entry) and task. ``seq`` is unique within a key. Each column is
    an aggregate of its own, so that a reader who selects few columns moves only those.
    """
    plain = [c for c in batch.columns if c not in (*key, seq, *maps)]
    return _collapse(batch, F.struct(*key), plain, seq, maps).select("_key.*", *plain, *maps)


def collapse_keyed(
    batch: DataFrame, key: Column, names: Sequence[str], seq: str, maps: Sequence[str] = ()
) -> DataFrame:
    """As :func:`collapse`, with the key as one struct ``_key`` in place of its columns ``names``."""
    given = [m for m in maps if m in batch.columns]
    plain = [c for c in batch.columns if c not in (*names, seq, *given)]
    return _collapse(batch, key, plain, seq, given)


def merge_keyed(
    old: DataFrame,
    new: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    names: Sequence[str],
    maps: Sequence[str] = (),
) -> DataFrame:
    """``columns`` and ``on`` of ``old`` after the collapsed batch ``new``: one full outer join.

    Both sides have one row per ``on``, which holds the key as the struct ``_key`` with the fields
    ``names``. Columns that ``new`` lacks keep their values.
    """
    given = [c for c in columns if c in new.columns and c not in names]
    marked = [F.col(c).alias(f"_n_{c}") for c in given]
    both = old.join(new.select(*on, *marked, F.lit(True).alias("_hit")), list(on), "full")

    def value(c: str) -> Column:
        if c in names:
            return F.col("_key")[c].alias(c)
        if c not in given:
            return F.col(c)
        if c in maps:
            return _merge_maps(F.col(c), F.col(f"_n_{c}")).alias(c)
        return F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c)

    return both.select(*on, *(value(c) for c in columns))


def upsert(
    store: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    seq: str,
    maps: Sequence[str] = (),
) -> DataFrame:
    """New state of ``store`` after ``batch``. A NULL key is a key like any other.

    Columns that ``batch`` lacks keep their value; a column given as NULL becomes NULL; columns new
    in ``batch`` are added. ``store`` has one row per key, ``seq`` orders the items of one key.

    Updates are a left join of the store with the collapsed batch and inserts an anti-join of the
    batch with the store's matching keys. For a batch small enough to broadcast the store is
    therefore only scanned, never shuffled, which a full outer join could not do; for a large batch
    both joins go by key, and keys are unique on both sides, so none is hot. Keys are compared as
    one struct: that makes NULL equal NULL, and the batch stays where its aggregation put it.
    """
    plain = [c for c in batch.columns if c not in (*key, seq, *maps)]
    given = [*plain, *maps]
    same_types = F.struct(*(F.col(c).cast(store.schema[c].dataType).alias(c) for c in key))
    latest = _collapse(batch, same_types, plain, seq, maps)
    hits = latest.select(
        "_key", *(F.col(c).alias(f"_n_{c}") for c in given), F.lit(True).alias("_hit")
    )

    def value(c: str) -> Column:
        if c not in given:
            return F.col(c)
        new = F.col(f"_n_{c}")
        if c not in store.columns:
            return new.alias(c)
        if c in maps:
            return _merge_maps(F.col(c), new).alias(c)
        return F.when(F.col("_hit"), new).otherwise(F.col(c)).alias(c)

    columns = [*store.columns, *(c for c in given if c not in store.columns)]
    keyed = store.withColumn("_key", F.struct(*key))
    updated = keyed.join(hits, "_key", "left").select(*(value(c) for c in columns))

    known = store.select(F.struct(*key).alias("_key")).join(
        latest.select("_key"), "_key", "left_semi"
    )
    inserted = latest.join(known, "_key", "left_anti").select("_key.*", *given)
    return updated.unionByName(inserted, allowMissingColumns=True)


def merge_sql(target: str, view: str, key: Sequence[str], columns: Sequence[str]) -> str:
    """``MERGE INTO`` statement for table formats with row-level operations.

    ``view`` holds one row per key, see :func:`collapse`. Plain Parquet tables reject it.
    """
    on = " AND ".join(f"t.`{c}` <=> s.`{c}`" for c in key)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns if c not in key)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    return (
        f"MERGE INTO {target} t USING {view} s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )
