"""Files into the raw table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.plans.settings import settings
from leafmill.plans.workdir import written
from leafmill.sources.files import MAX_CONTENT, list_tree, new_files, with_contents, with_pieces
from leafmill.sources.tables import LARGE_ROWS, TABLE_FORMAT, append, write_overwrite

MONTH = "yyyy-MM"


def stamp(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Add ``timestamp`` (now, unless ``at`` is given) and its month as ``year_month``."""
    when = F.current_timestamp() if at is None else at
    return df.withColumn("timestamp", when).withColumn(
        "year_month", F.date_format(F.col("timestamp"), MONTH)
    )


def ingest_files(
    spark: SparkSession,
    folder: str,
    table: str,
    path: str | None = None,
    suffix: str = ".pdf",
    replace: bool = False,
    table_format: str = TABLE_FORMAT,
    limit: int | None = None,
    piece: int | None = None,
) -> DataFrame:
    """List ``folder``, read every new file, stamp its row and append it to ``table``. Returns the table.

    A file is new if the table has no row of its path, time and length, so a second run adds nothing,
    and the table can be streamed. Names are compared before anything is read: contents of known
    files are not opened, those of new ones go from the task that reads them into the table. With
    ``replace`` the table and its schema are replaced instead, by all files. A file that cannot be
    read as one value is a row with an ``error``, see :func:`leafmill.sources.files.with_contents`.

    With ``piece`` a file is kept in rows of at most so many bytes, as in
    :func:`leafmill.sources.files.with_pieces`: no task holds a whole file, and one may be of any length.
    """

    def read(names: DataFrame) -> DataFrame:
        if piece:
            return stamp(with_pieces(spark, names, folder, limit, piece))
        return stamp(with_contents(spark, names, folder, MAX_CONTENT if limit is None else limit))

    listed = list_tree(spark, folder, suffix)
    if replace:
        with settings(spark, LARGE_ROWS):
            return write_overwrite(read(listed), table, path, table_format)
    if spark.catalog.tableExists(table):
        listed = written(spark, new_files(listed, spark.table(table)), "new")
        if listed.isEmpty():
            return spark.table(table)
    with settings(spark, LARGE_ROWS):
        return append(read(listed), table, path, table_format)
