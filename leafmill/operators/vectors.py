"""Vector records for a vector table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.chunking import chunk_separator
from leafmill.functions.embedding import hashed_embedding
from leafmill.functions.text import chunk_id
from leafmill.models import Model, embed
from leafmill.operators.chunks import chunk_rows, spread_chunks
from leafmill.operators.upsert import merge_keyed, upsert

VECTOR_KEY = ("namespace", "id")


def _metadata(columns: Sequence[str]) -> Column:
    return F.create_map(*(x for c in columns for x in (F.lit(c), F.col(c).cast("string"))))


def vector_records(
    df: DataFrame,
    key: str,
    text: str,
    metadata: Sequence[str],
    chunks: Column | None = None,
    model: Model | None = None,
    partitions: int | None = None,
    **retry: object,
) -> DataFrame:
    """``(key, pos, id, values, metadata)`` per chunk; the document's metadata is repeated.

    ``id`` is the digest of the chunk alone, so equal chunks of two documents share it; store them
    by (``key``, ``id``) to keep both. Without a model no row leaves the JVM and there is no
    shuffle; with one, chunks are spread by (``key``, ``pos``), over ``partitions`` tasks if given,
    and ``error`` is added.
    """
    listed = chunk_separator(F.col(text)) if chunks is None else chunks
    rows = chunk_rows(df.withColumn("metadata", _metadata(metadata)), [key, "metadata"], listed)
    rows = rows.withColumn("id", chunk_id(F.col("chunk")))
    if model is None:
        return rows.select(
            key, "pos", "id", hashed_embedding(F.col("chunk")).alias("values"), "metadata"
        )
    done = embed(spread_chunks(rows, key, partitions), "chunk", model, **retry)
    return done.select(key, "pos", "id", F.col("value").alias("values"), "metadata", "error")


def vector_upsert(store: DataFrame, batch: DataFrame, seq: str) -> DataFrame:
    """New state of a vector table keyed by ``(namespace, id)`` after ``batch``."""
    return upsert(store, batch, VECTOR_KEY, seq)


def vector_flow(
    store: DataFrame,
    stored: DataFrame,
    namespace: str,
    key: str,
    text: str,
    metadata: Sequence[str],
    chunks: Column | None = None,
) -> DataFrame:
    """Stored texts to vectors in one flow: the new state of ``store`` after all chunks of ``stored``.

    ``store`` holds ``namespace``, ``key``, ``id``, ``values`` and ``metadata``, one row per namespace,
    document and chunk; a chunk that a document repeats is one vector. Texts are cut once, and chunks,
    not vectors, move before they are reduced; one full outer join then meets the store.
    """
    listed = chunk_separator(F.col(text)) if chunks is None else chunks
    rows = chunk_rows(
        stored.withColumn("metadata", _metadata(metadata)), [key, "metadata"], listed
    )
    names = ("namespace", key, "id")
    kinds = ", ".join(f"`{c}`: {store.schema[c].dataType.simpleString()}" for c in names)

    def as_key(*parts: Column) -> Column:
        """The key as one struct, of the same type on both sides, so that no side moves twice."""
        named = [part.alias(c) for part, c in zip(parts, names)]
        return F.struct(*named).cast(f"struct<{kinds}>").alias("_key")

    # Equal ids are equal chunks: one stays before it is made a vector.
    latest = (
        rows.select(
            as_key(F.lit(namespace), F.col(key), chunk_id(F.col("chunk"))),
            "pos",
            F.struct("chunk", "metadata").alias("held"),
        )
        .groupBy("_key")
        .agg(F.max_by("held", "pos").alias("held"))
        .select("_key", hashed_embedding(F.col("held.chunk")).alias("values"), "held.metadata")
    )
    columns = [*store.columns, *(c for c in ("values", "metadata") if c not in store.columns)]
    missing = [F.lit(None).cast(latest.schema[c].dataType).alias(c) for c in columns if c not in store.columns]
    old = store.select(as_key(*map(F.col, names)), *(c for c in store.columns if c not in names), *missing)
    return merge_keyed(old, latest, ["_key"], columns, names).drop("_key")
