"""Text and identifier expressions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: one run of characters outside ASCII.
NON_ASCII_RUN = r"[^\x00-\x7F]+"

# What counts as one word, and what separates tokens. Every other character is a
# token of its own.
WORD = "[A-Za-z0-9]+"
TOKEN_SPACE = r"[\t\n\x0B\f\r ]+"


def strip(text: Column) -> Column:
    """Remove leading and trailing white space, by Python's definition of white space."""
    return F.trim(text, F.lit(PYTHON_WHITESPACE))


def clean_text(text: Column) -> Column:
    """NULL becomes ``''``; each run of non-ASCII characters becomes one space; then strip."""
    return F.coalesce(strip(F.regexp_replace(text, NON_ASCII_RUN, " ")), F.lit(""))


def document_id(*parts: Column, sep: str = "") -> Column:
    """SHA-256 (lower-case hex) of the parts joined by ``sep``; a NULL part reads ``None``.

    With the default empty separator ``('ab', 'c')`` and ``('a', 'bc')`` share an id. Pass a
    separator where that matters.
    """
    shown = [F.coalesce(part.cast("string"), F.lit("None")) for part in parts]
    return F.sha2(F.concat_ws(sep, *shown), 256)


def chunk_id(chunk: Column) -> Column:
    """SHA-256 (lower-case hex) of the chunk text."""
    return F.sha2(chunk, 256)


def token_count(text: Column) -> Column:
    """Number of words and symbols, 0 for NULL.

    This is a model-free count. It is not the byte-pair count of a particular tokenizer; pass one
    to :func:`leafmill.models.count_tokens` to get that.
    """
    one_per_word = F.regexp_replace(F.regexp_replace(text, WORD, "w"), TOKEN_SPACE, "")
    return F.coalesce(F.length(one_per_word), F.lit(0)).cast("int")
