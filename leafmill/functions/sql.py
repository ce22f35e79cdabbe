"""The library's expressions as SQL functions of a session: scalar ones, and tables of chunks.

A function's body is the expression itself, so it is expanded into the plan of whatever calls it: no
Python runs, filters and columns are pushed as ever, and ``LATERAL`` becomes one generator.

    SELECT d.id, c.pos, c.chunk FROM docs d, LATERAL chunk_recursive(d.text) c
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from leafmill.functions.chunking import chunk_recursive, chunk_separator, chunk_wrap
from leafmill.functions.summary import extractive_summary
from leafmill.functions.text import clean_text, token_count

Expression = Callable[[Column], Column]

#: A quoted text, which stays, or an operator in front of its arguments, whose name is quoted.
_OPERATOR = re.compile(
    r"'(?:[^'\\]|\\.|'')*'|(<=>|<=|>=|==|=|<|>|\+|-|\*|/|%|&|\||\^|\band|\bor|\bnot|\bin)\(", re.DOTALL
)


def sql_text(column: Column) -> str:
    """An expression as SQL; columns it names are names in the statement that holds it."""
    return _OPERATOR.sub(lambda m: f"`{m[1]}`(" if m[1] else m[0], column._jc.node().sql())


def scalar_function(
    spark: SparkSession, name: str, expression: Expression, returns: str = "STRING"
) -> None:
    """Make ``name(text)`` a function of the session."""
    body = sql_text(expression(F.col("text")))
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS {returns} RETURN {body}"
    )


def table_function(spark: SparkSession, name: str, chunks: Expression) -> None:
    """Make ``name(text)`` a table function of the session: a row ``pos, chunk`` for each chunk."""
    body = sql_text(chunks(F.col("text")))
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) "
        f"RETURNS TABLE(pos INT, chunk STRING) "
        f"RETURN SELECT pos, chunk FROM (SELECT posexplode({body}) AS (pos, chunk))"
    )


def register(spark: SparkSession) -> None:
    """All of them, with their default sizes."""
    scalar_function(spark, "clean_text", clean_text)
    scalar_function(spark, "token_count", token_count, "INT")
    scalar_function(spark, "extractive_summary", extractive_summary)
    table_function(spark, "chunk_separator", chunk_separator)
    table_function(spark, "chunk_recursive", chunk_recursive)
    table_function(spark, "chunk_wrap", chunk_wrap)
