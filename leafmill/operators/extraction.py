"""Document text out of page rows and extractor outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.operators.filters import keep_suffix, unprocessed

# Fixed values.
SHORT_TEXT = 50
FALLBACK_JOINER = "\n"


def join_pages(
    pages: DataFrame, doc: str, page: str, text: str, joiner: str = "", strict: bool = False
) -> DataFrame:
    """Page texts in page order, joined by ``joiner``, as ``(doc, text)``.

    A NULL page reads ``''``; with ``strict`` it makes the whole document NULL. Pages without a
    document id are one document. Pages of one document that lie in one input task are put together
    there and move as one row, so ``pages`` are read and moved once, whatever the documents' sizes.
    """
    parts = F.array_sort(
        F.collect_list(
            F.struct(F.col(page).alias("p"), F.coalesce(F.col(text), F.lit("")).alias("t"))
        )
    )
    joined = F.array_join(F.transform(parts, lambda x: x["t"]), joiner)
    if strict:
        joined = F.when(~F.max(F.col(text).isNull()), joined)
    return pages.groupBy(doc).agg(joined.alias("text"))


def assemble_pages(
    pages: DataFrame,
    doc: str,
    page: str,
    text: str,
    second: DataFrame,
    second_text: str,
    shortest: int = SHORT_TEXT,
) -> DataFrame:
    """``(doc, text)``: joined pages, or the second extractor's text where they are too short.

    ``second`` holds at most one row per ``doc``; a short document without one gets NULL. One plan
    for documents of any size: the joined pages say which documents are short, ``second`` is reduced
    to those (a costly second extractor runs for them only), and both go by the key that the
    pages have been moved by. ``pages`` are read and moved once, ``second`` once, nothing is counted.
    """
    keyed = pages.select(F.struct(doc).alias("_key"), page, text)
    joined = join_pages(keyed, "_key", page, text)
    short = joined.where(F.length("text") < shortest).select("_key")
    needed = second.select(F.struct(doc).alias("_key"), F.col(second_text).alias("_second"))
    needed = needed.join(short, "_key", "left_semi")
    return joined.join(needed, "_key", "left").select(
        F.col(f"_key.{doc}").alias(doc),
        F.when(F.length("text") < shortest, F.col("_second"))
        .otherwise(F.col("text"))
        .alias("text"),
    )


def pages_text(pages: Column) -> Column:
    """Text of an array of pages as one extractor call returns it; NULL if a page has no text."""
    return F.when(~F.exists(pages, lambda p: p.isNull()), F.array_join(pages, FALLBACK_JOINER))


def first_text(first: Column, second: Column, unreadable: Column) -> Column:
    """``''`` for unreadable input, else the first text, else the second, else NULL."""
    return F.when(unreadable, F.lit("")).otherwise(F.coalesce(first, second))


def extract_unprocessed(
    files: DataFrame,
    done: DataFrame,
    name: str,
    done_name: str,
    text: Column,
    suffix: str = ".pdf",
) -> DataFrame:
    """``(name, text)`` of every file with ``suffix`` that is not among ``done``.

    The suffix test and the anti-join come first, so ``text`` is evaluated only for new files.
    """
    new = unprocessed(keep_suffix(files, suffix, name), done, name, done_name)
    return new.select(F.col(name).alias("name"), text.alias("text"))
