"""Catalogue tables: raw writes, reads, projections and point lookups."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.operators import bloom
from leafmill.plans.parallel import broadcast_fits
from leafmill.plans.workdir import written

TABLE_FORMAT = "parquet"
#: Property that names the load a replaced table holds.
LOAD = "leafmill.load"
#: How Parquet files with contents of files are written: a writer looks at what it holds after few
#: rows (by default after 100), and a reader gets a group of rows that is small as a whole.
LARGE_ROWS = {
    "parquet.block.size": str(16 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "4",
}
# Error conditions of a missing table and a missing column.
MISSING = ("TABLE_OR_VIEW_NOT_FOUND", "UNRESOLVED_COLUMN")


def write_overwrite(
    df: DataFrame, table: str, path: str | None = None, table_format: str = TABLE_FORMAT
) -> DataFrame:
    """Replace ``table`` and its schema by ``df``; external if ``path`` is given. Returns it.

    The table is marked with the load it holds, so that a stream over it can tell a new load from
    appended rows, see :func:`leafmill.streaming.flows.process_table`.
    """
    writer = df.write.format(table_format).mode("overwrite").option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    spark = df.sparkSession
    set_property(spark, table, LOAD, uuid.uuid4().hex)
    return spark.table(table)


def append(
    df: DataFrame,
    table: str,
    path: str | None = None,
    table_format: str = TABLE_FORMAT,
    partition_by: str | None = None,
) -> DataFrame:
    """Add the rows of ``df`` to ``table``, which is made if it is missing. Returns it.

    Columns that the table lacks are added to it, columns that ``df`` lacks are NULL in its rows.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        add_columns(spark, table, df.schema)
        fields = spark.table(table).schema.fields
        df = df.select(
            *(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
              for f in fields)
        )
    writer = df.write.format(table_format).mode("append")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)
    return spark.table(table)


def add_columns(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Add the columns of ``schema`` that ``table`` lacks; its rows so far have NULL there."""
    known = set(spark.table(table).columns)
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def set_property(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")


def get_property(spark: SparkSession, table: str, key: str) -> str | None:
    return dict(spark.sql(f"SHOW TBLPROPERTIES {table}").collect()).get(key)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def query(spark: SparkSession, statement: str, **names: str) -> DataFrame:
    """Run SQL; ``{name}`` in the statement stands for a table given by name."""
    return spark.sql(statement.format(**names))


def project(store: DataFrame, *fields: str) -> DataFrame:
    """The given fields of every row; only these columns are read."""
    return store.select(*fields)


def project_or_empty(spark: SparkSession, table: str, *fields: str) -> DataFrame:
    """The given fields as strings, or no rows at all if the table or a field is missing.

    Any other problem is raised.
    """
    try:
        return spark.table(table).select(*(F.col(f).cast("string").alias(f) for f in fields))
    except AnalysisException as problem:
        if not (problem.getCondition() or "").startswith(MISSING):
            raise
        return spark.createDataFrame([], T.StructType([T.StructField(f, T.StringType()) for f in fields]))


def lookup(
    requests: DataFrame, store: DataFrame, name: str, store_name: str, content: str
) -> DataFrame:
    """Point reads by name: ``(name, content, found, error)`` per distinct name in ``requests``.

    ``store`` has one row per name. Requests are made distinct map-side and written to the shared
    folder, so a name asked for very often costs one row and their number is known. The store is
    reduced to the requested names on its scan, before anything moves: a list that Spark broadcasts is
    looked up there; for a longer one a Bloom filter of its size is, which lets about one in a hundred
    of the other contents through.
    """
    spark, seen = requests.sparkSession, Observation()
    names = requests.select(F.col(name).alias("name")).distinct()
    wanted = written(spark, names.observe(seen, F.count("*").alias("n")), "wanted")
    named = store.select(
        F.col(store_name).alias("name"), F.col(content).alias("content"), F.lit(True).alias("_hit")
    )
    if broadcast_fits(wanted):
        hits = named.join(wanted, "name", "left_semi")
    else:
        words = bloom.words_for(seen.get["n"])
        asked = bloom.bloom_filter(wanted, F.col("name"), words)
        hits = named.where(bloom.may_hold(asked, F.col("name"), words))
    return wanted.join(hits, "name", "left").select(
        "name",
        "content",
        F.coalesce("_hit", F.lit(False)).alias("found"),
        F.when(F.col("name").isNull(), "missing name").alias("error"),
    )
