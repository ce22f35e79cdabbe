"""One bad row does not stop the others: mark failures, then split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_fields(df: DataFrame, fields: Sequence[str], error: str = "error") -> DataFrame:
    """Add ``error``: the name of the first field that is NULL, or NULL if none is."""
    message = F.coalesce(
        *(F.when(F.col(f).isNull(), F.lit(f"missing {f}")) for f in fields)
    )
    return df.withColumn(error, message)


def require_map_keys(
    df: DataFrame, fields: str, keys: Sequence[str], error: str = "error"
) -> DataFrame:
    """The same for the entries of a map column. An entry that is present may hold NULL."""
    message = F.coalesce(
        *(
            F.when(
                ~F.coalesce(F.map_contains_key(F.col(fields), k), F.lit(False)),
                F.lit(f"missing {k}"),
            )
            for k in keys
        )
    )
    return df.withColumn(error, message)


def split_ok_failed(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with an error; together they are the input.

    Each part evaluates ``df`` when it is used. Write the rows first (``plans.workdir.written``)
    where a costly model made them.
    """
    ok = df.filter(F.col(error).isNull()).drop(error)
    return ok, df.filter(F.col(error).isNotNull())
