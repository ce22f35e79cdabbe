"""Row selection: by path, by what is already processed, by equal content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.paths import has_substring, has_suffix
from leafmill.plans.parallel import broadcast_fits

#: A name is hot if more than one row in so many holds it; names that the sketch tracks.
HOT_SHARE, TRACKED = 64, 4096


def filter_path(df: DataFrame, path: str, on: str = "path") -> DataFrame:
    """Rows of one path. On a stored column the comparison reaches the Parquet scan."""
    return df.filter(F.col(on) == path)


def keep_suffix(df: DataFrame, suffix: str = ".pdf", on: str = "path") -> DataFrame:
    """Rows whose path ends in ``suffix``, case-sensitive."""
    return df.filter(has_suffix(F.col(on), suffix))


def keep_substring(df: DataFrame, part: str = ".pdf", on: str = "path") -> DataFrame:
    """Rows whose path contains ``part`` anywhere, case-sensitive."""
    return df.filter(has_substring(F.col(on), part))


def frequent(df: DataFrame, on: str, share: int = HOT_SHARE) -> DataFrame:
    """``hash`` of each value of ``on`` that more than one in ``share`` rows holds: ``share`` at most.

    A sketch of frequent items of fixed size goes over the column ``on`` alone.
    """
    top = F.expr(f"approx_top_k(xxhash64(`{on}`), {share}, {TRACKED})")
    counted = df.agg(top.alias("_top"), F.count("*").alias("_rows"))
    items = counted.select("_rows", F.inline("_top").alias("hash", "_n"))
    return items.where(F.col("_n") * share > F.col("_rows")).select("hash")


def unprocessed(
    listing: DataFrame, done: DataFrame, on: str, done_on: str | None = None
) -> DataFrame:
    """Rows of ``listing`` whose name is not among ``done``. A NULL name equals a NULL name.

    ``done`` is made distinct before it moves. Where Spark will broadcast it the listing is not
    moved. Else both sides are shuffled by name, and names that a large part of the listing holds
    are found first by a sketch over the names (:func:`frequent`), at most ``HOT_SHARE`` of them. Which
    of those are done is broadcast and settles their rows where they lie; those that are left go
    through the join under a number of their own for each input task, so no task gets a hot name
    and ``done`` is never multiplied.
    """
    names = done.select(F.col(done_on or on).alias("_name")).distinct()
    if broadcast_fits(names):
        return listing.join(names, listing[on].eqNullSafe(names["_name"]), "left_anti")
    hot = F.broadcast(frequent(listing, on).withColumnRenamed("hash", "_hot"))
    # As many names as there are hot ones, but for names with one hash.
    settled = F.broadcast(names.join(hot, F.xxhash64("_name") == F.col("_hot"), "left_semi"))
    open_rows = listing.join(settled, listing[on].eqNullSafe(settled["_name"]), "left_anti")
    marked = open_rows.join(hot, F.xxhash64(on) == F.col("_hot"), "left")
    spread = F.when(F.col("_hot").isNotNull(), F.spark_partition_id() + 1).otherwise(0)
    salted = marked.withColumn("_salt", spread.cast("long")).drop("_hot")
    # Zero, in a form that the optimiser does not take for a constant: then it would not be a key.
    plain = names.withColumn("_zero", F.xxhash64("_name").bitwiseAND(F.lit(0).cast("long")))
    match = salted[on].eqNullSafe(plain["_name"]) & (salted["_salt"] == plain["_zero"])
    return salted.join(plain, match, "left_anti").drop("_salt")


def dedup_exact(
    df: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    content: str | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """One row per distinct ``keys`` and ``content``: the smallest by ``order_by``, then ``row_id``.

    ``row_id`` names columns that identify a row and are never NULL (for a Parquet table without a key, see
    :func:`with_row_locator`). Survivors are chosen on the content's digest and the narrow columns
    alone, with map-side partial minima, so a group holding a third of all rows sends one short row
    per task. The content then moves at most once, keyed by the unique ``row_id``, which cannot be
    skewed; it does not move at all where the survivor list is small enough to broadcast.
    """
    group: list[Column] = [F.col(k) for k in keys]
    if content is not None:
        group.append(F.sha2(F.col(content).cast("binary"), 256).alias("_digest"))
    if not order_by and len(row_id) == 1:
        # A plain minimum needs no sorting.
        survivors = df.groupBy(*group).agg(F.min(row_id[0]).alias("_r0")).select("_r0")
    else:
        ranked = F.struct(
            *(F.col(c).alias(f"o{n}") for n, c in enumerate(order_by)),
            *(F.col(c).alias(f"r{n}") for n, c in enumerate(row_id)),
        )
        first = df.groupBy(*group).agg(F.min(ranked).alias("_first"))
        survivors = first.select(
            *(F.col(f"_first.r{n}").alias(f"_r{n}") for n in range(len(row_id)))
        )
    same = [df[c] == survivors[f"_r{n}"] for n, c in enumerate(row_id)]
    return df.join(survivors, same, "left_semi")


def with_row_locator(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Add the file and the position in it, which identify a row of a Parquet table."""
    columns = ["_file", "_position"]
    located = df.select(
        "*",
        F.col("_metadata.file_path").alias(columns[0]),
        F.col("_metadata.row_index").alias(columns[1]),
    )
    return located, columns
