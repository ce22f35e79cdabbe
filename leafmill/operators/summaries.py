"""Document summaries over chunks.

The default summariser is a column expression, so chunk, summarise and combine happen inside the
document's row and nothing is shuffled. With a model, chunks become rows that are spread over the
cluster, pass through one Arrow stage, and are grouped back by document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions.chunking import (
    chunk_recursive,
    chunk_separator,
    chunk_wrap,
)
from leafmill.functions.summary import SENTENCE_JOINER, extractive_summary
from leafmill.models import Model, apply_model
from leafmill.operators.chunks import join_chunks, spread_chunks
from leafmill.plans.workdir import written

# Fixed values.
MAP_JOINER = " \n"
WRAP_JOINER = "\n "
NULL_TEXT = "None"


def chunk_summaries(chunks: str, joiner: str = MAP_JOINER) -> Column:
    """Best sentence of each chunk in a column of chunk arrays, joined in order; ``''`` for NULL."""
    mapped = F.transform(chunks, lambda c: extractive_summary(c, 1))
    return F.coalesce(F.array_join(mapped, joiner), F.lit(""))


def _map_step(
    df: DataFrame, keep: Sequence[str], chunks: Column, joiner: str, name: str
) -> DataFrame:
    """Best sentence of each chunk, joined in order. No shuffle.

    Chunks and summaries are separate projections: the optimiser merges them again, but analysing
    one deeply nested expression takes more passes than the analyser allows.
    """
    chunked = df.select(*keep, chunks.alias("_chunks"))
    return chunked.select(*keep, chunk_summaries("_chunks", joiner).alias(name))


def summary_map_reduce(
    df: DataFrame, keep: Sequence[str], text: str, k: int = 3, **chunking: object
) -> DataFrame:
    """``summary``: best sentence of each recursive chunk, then the ``k`` best of those.

    NULL gives ``''``.
    """
    chunks = chunk_recursive(F.col(text), **chunking)
    mapped = _map_step(df, keep, chunks, SENTENCE_JOINER, "_mapped")
    return mapped.select(*keep, extractive_summary(F.col("_mapped"), k).alias("summary"))


def summary_map_join(
    df: DataFrame, keep: Sequence[str], text: str, **chunking: object
) -> DataFrame:
    """``summary``: best sentence of each separator chunk, joined in order; ``''`` for NULL."""
    return _map_step(df, keep, chunk_separator(F.col(text), **chunking), MAP_JOINER, "summary")


def summary_wrap_join(
    df: DataFrame, keep: Sequence[str], text: str, **chunking: object
) -> DataFrame:
    """``summary``: best sentence of each wrapped line, joined in order.

    NULL reads as the text ``None``.
    """
    shown = F.coalesce(F.col(text), F.lit(NULL_TEXT))
    return _map_step(df, keep, chunk_wrap(shown, **chunking), WRAP_JOINER, "summary")


def _mapped_by_model(
    rows: DataFrame, model: Model, joiner: str, partitions: int | None, retry: dict
) -> DataFrame:
    """``_key, summary, error``: a model's outputs for the chunks of a document, joined in order.

    ``rows`` holds ``_key`` (a struct, so NULL equals NULL), ``pos`` and ``chunk``; a document without
    chunks has one row with NULL for both.
    """
    done = apply_model(spread_chunks(rows, "_key", partitions), "chunk", "string", model, **retry)
    # One aggregation for texts and messages: a second use of ``done`` would run the model again.
    shown = F.when(F.col("pos").isNotNull(), F.coalesce("value", F.lit("")))
    return join_chunks(
        done.select("_key", "pos", shown.alias("v"), "error"),
        ["_key"],
        "v",
        joiner,
        F.min("error").alias("error"),
    )


def summarize_with_model(
    df: DataFrame,
    key: str,
    chunks: Column,
    model: Model,
    joiner: str = MAP_JOINER,
    partitions: int | None = None,
    **retry: object,
) -> DataFrame:
    """``(key, summary, error)`` with chunk summaries made by ``model``.

    ``key`` identifies a document; a NULL key is a document too. Chunks are spread by (document,
    position), so a long document does not sit in one task. A chunk that fails every try contributes
    ``''`` and its message is kept in ``error``. Documents without chunks give ``''``. The input is
    read once.
    """
    rows = df.select(F.struct(key).alias("_key"), F.posexplode_outer(chunks).alias("pos", "chunk"))
    mapped = _mapped_by_model(rows, model, joiner, partitions, retry)
    return mapped.select(f"_key.{key}", "summary", "error")


def map_reduce_with_model(
    df: DataFrame,
    key: str,
    chunks: Column,
    model: Model,
    reduce_model: Model | None = None,
    longest: int = 4000,
    joiner: str = MAP_JOINER,
    partitions: int | None = None,
    **retry: object,
) -> DataFrame:
    """``(key, summary, error)``: chunks are summarised, and their joined summaries reduced to one.

    ``reduce_model`` (``model`` if none is given) makes one text of a document's joined summaries.
    Where these are longer than ``longest`` characters they are cut into chunks of that size and
    mapped again first, as long as that makes them shorter. Each round is written to the shared folder
    and works on the documents that are still too long, the others wait for the last step: if none is
    too long there is no round. Texts are never part of a key. A failed chunk contributes ``''``;
    ``error`` keeps a message, also for a text that a round did not shorten and that is reduced as it
    is. Documents without chunks give ``''`` and reach no model.
    """
    spark, last = df.sparkSession, reduce_model or model
    rows = df.select(F.struct(key).alias("_key"), F.posexplode_outer(chunks).alias("pos", "chunk"))
    held = written(spark, _mapped_by_model(rows, model, joiner, partitions, retry), "mapped")
    size = F.length("summary")
    finished = held.where(size <= longest)
    while not (long := held.where(size > longest)).isEmpty():
        pieces = chunk_recursive(F.col("summary"), size=longest, overlap=0)
        again = long.select("_key", F.posexplode(pieces).alias("pos", "chunk"))
        before = long.select("_key", size.alias("_before"), F.col("error").alias("_earlier"))
        mapped = _mapped_by_model(again, last, joiner, partitions, retry)
        step = written(spark, mapped.join(before, "_key"), "mapped")
        shorter, message = size < F.col("_before"), F.coalesce("_earlier", "error")
        stuck = (size > longest) & ~shorter
        held = step.select(
            "_key",
            "summary",
            F.when(stuck, F.coalesce(message, F.lit("too long, and not shortened")))
            .otherwise(message)
            .alias("error"),
            stuck.alias("_stuck"),
        )
        finished = finished.unionByName(held.where((size <= longest) | F.col("_stuck")).drop("_stuck"))
        held = held.where(~F.col("_stuck")).drop("_stuck")
    text = F.when(F.col("summary") != "", F.col("summary"))
    reduced = apply_model(
        finished.select("_key", text.alias("text"), F.col("error").alias("earlier")),
        "text",
        "string",
        last,
        **retry,
    )
    return reduced.select(
        f"_key.{key}",
        F.coalesce("value", F.lit("")).alias("summary"),
        F.coalesce("earlier", "error").alias("error"),
    )
