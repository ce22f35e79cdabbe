"""The whole way of a document: clean, identify, chunk, summarise, store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.chunking import chunk_separator
from leafmill.functions.paths import PATH_FIELDS, path_fields
from leafmill.functions.text import clean_text, document_id, token_count
from leafmill.models import Model, extract
from leafmill.operators.extraction import first_text, pages_text
from leafmill.operators.summaries import chunk_summaries, summary_map_reduce
from leafmill.sources.keyed import KeyedTable


def summarized_documents(
    df: DataFrame, text: str, id_parts: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """``keep``, ``id``, ``n_chunks``, ``n_tokens`` and ``summary`` of each document. No shuffle."""
    cleaned = df.select(
        *keep,
        document_id(*(F.col(c) for c in id_parts)).alias("id"),
        clean_text(F.col(text)).alias("cleaned"),
    )
    chunked = cleaned.select(
        *keep,
        "id",
        token_count(F.col("cleaned")).alias("n_tokens"),
        chunk_separator(F.col("cleaned")).alias("_chunks"),
    )
    return chunked.select(
        *keep,
        "id",
        F.size("_chunks").alias("n_chunks"),
        "n_tokens",
        chunk_summaries("_chunks").alias("summary"),
    )


def items_from_files(
    files: DataFrame,
    extractor: Model,
    id_parts: Sequence[str] = ("item", "category", "author", "title", "filetype"),
    k: int = 3,
    keep: Sequence[str] = (),
    **retry: object,
) -> DataFrame:
    """Store items of file rows: ``(id, Filepath, Metadata, text, summary, error)``.

    ``extractor`` turns the contents into ``{"text": ..., "pages": [...]}``, see
    :func:`leafmill.models.extract`; its text is taken, else its pages joined. ``id`` is made of
    the path's fields, which are also the metadata. A file that cannot be read keeps its message
    and gets an empty summary; so does a row without content, whose ``error`` says why. The extractor
    runs once per file, everything after it is native. ``keep`` names further columns to pass through.
    """
    earlier = F.col("error") if "error" in files.columns else F.lit(None).cast("string")
    given = files.select("path", "content", earlier.alias("_unread"), *keep)
    read = extract(given, "content", extractor, **retry)
    texts = read.select(
        "path",
        *keep,
        path_fields(F.col("path")).alias("fields"),
        first_text(
            F.col("value.text"), pages_text(F.col("value.pages")), F.lit(False)
        ).alias("text"),
        F.coalesce("_unread", "error").alias("error"),
    )
    metadata = F.create_map(
        *(x for c in PATH_FIELDS for x in (F.lit(c), F.col(f"fields.{c}")))
    )
    items = texts.select(
        document_id(*(F.col(f"fields.{c}") for c in id_parts)).alias("id"),
        F.col("path").alias("Filepath"),
        metadata.alias("Metadata"),
        clean_text(F.col("text")).alias("text"),
        "error",
        *keep,
    )
    return summary_map_reduce(items, items.columns, "text", k)


ITEM_SCHEMA = (
    "id string, Filepath string, Metadata map<string,string>, text string, summary string, "
    "error string"
)


def store_summaries(
    df: DataFrame, store: KeyedTable, text: str, id_parts: Sequence[str], seq: str
) -> None:
    """Summarise each document by map-reduce and upsert ``(id, summary)`` into ``store``.

    ``seq`` orders documents that share an id; the last one wins.
    """
    cleaned = df.select(
        document_id(*(F.col(c) for c in id_parts)).alias("id"),
        clean_text(F.col(text)).alias("cleaned"),
        seq,
    )
    items = summary_map_reduce(cleaned, ["id", seq], "cleaned")
    store.upsert(items, seq)
