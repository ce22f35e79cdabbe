"""Incremental flows. Each run processes what is new, then stops."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from leafmill.models import Model
from leafmill.plans.flow import items_from_files
from leafmill.plans.settings import settings
from leafmill.plans.workdir import written
from leafmill.sources.files import MAX_CONTENT, list_tree, located, new_files, with_contents
from leafmill.sources.footers import footer_schemas, merge_schemas
from leafmill.sources.keyed import KeyedTable
from leafmill.sources.tables import (
    LARGE_ROWS,
    LOAD,
    TABLE_FORMAT,
    add_columns,
    get_property,
    set_property,
)

#: Property of a copy that names the load of its source, and its value for a table without loads.
COPIED, NO_LOAD = "leafmill.copied", "appended"
#: Names in one file of the table of arrivals.
NAMES_IN_PART = 10_000
#: Characters that have a meaning in a pattern of paths.
GLOB = re.compile(r"([\\{}\[\]*?])")


def run_to_table(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    partition_by: str | None = None,
    path: str | None = None,
    table_format: str = "parquet",
) -> DataFrame:
    """Append everything available to ``table``, wait until done, return the table.

    ``checkpoint`` must lie outside the table's own folder. Table formats that can take new columns
    on write get ``mergeSchema``; Parquet ignores it, read such a table with ``mergeSchema``.
    """
    writer = (
        stream.writeStream.format(table_format)
        .option("checkpointLocation", checkpoint)
        .option("mergeSchema", "true")
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    query: StreamingQuery = writer.toTable(table)
    query.awaitTermination()
    return stream.sparkSession.table(table)


def stream_table(spark: SparkSession, table: str, **limits: str) -> DataFrame:
    """Unbounded rows of a table.

    ``limits`` such as ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` cut a long backlog into
    several micro-batches, so that a lost driver repeats only the last one.
    """
    return spark.readStream.options(**limits).table(table)


def process_table(
    spark: SparkSession,
    raw: str,
    bronze: str,
    checkpoint: str,
    partition_by: str = "year_month",
    path: str | None = None,
    table_format: str = TABLE_FORMAT,
    identity: Sequence[str] | None = None,
    **limits: str,
) -> DataFrame:
    """Copy the new rows of ``raw`` to ``bronze``, partitioned by month.

    A stream takes every file of an overwritten table as new, so a second load of ``raw`` would double
    what ``bronze`` has of the first. The load a table was copied from is noted in ``bronze``: rows
    appended to it go on streaming, another load is refused unless ``identity`` names the columns
    that identify a row. Then the rows of the new load that ``bronze`` has already are left out.
    Columns that ``raw`` has gained since are added to ``bronze``.
    """
    load = get_property(spark, raw, LOAD)
    stream = stream_table(spark, raw, **limits)
    if spark.catalog.tableExists(bronze):
        add_columns(spark, bronze, stream.schema)
        noted = get_property(spark, bronze, COPIED)
        if noted != (load or NO_LOAD) and (noted or load):
            if identity is None:
                raise ValueError(
                    f"{raw} was replaced since it was copied to {bronze}; its rows would double. "
                    "Name the columns that identify a row"
                )
            known = spark.table(bronze).select(*identity)
            stream = stream.join(known, [stream[c].eqNullSafe(known[c]) for c in identity], "left_anti")
    contents = any(isinstance(f.dataType, T.BinaryType) for f in stream.schema.fields)
    with settings(spark, LARGE_ROWS if contents else {}):
        run_to_table(stream, bronze, checkpoint, partition_by, path, table_format)
    set_property(spark, bronze, COPIED, load or NO_LOAD)
    return spark.table(bronze)


def _run(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything available, wait until done."""
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def process_folder(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    partition_by: str = "year_month",
    limits: dict[str, str] | None = None,
) -> DataFrame:
    """Copy the Parquet files that arrive in ``folder`` to ``target``; files may bring new columns.

    What is streamed are the names of new files, see :func:`new_arrivals`. Tasks read the footers of a
    batch's files first; a column that has not been seen is added to the schema, which is noted next
    to the checkpoint, and the batch is read with that schema, so nothing is written without its
    columns. A column that changes its type fails before anything of its batch is written. Each
    batch has a folder of its own below ``target``, which a repeated batch replaces. Returns
    ``target`` with all columns; rows from before a column came have NULL there.
    """
    log = f"{checkpoint}/leafmill_schemas"
    listed = list_tree(spark, folder, ".parquet")
    # Names that begin with _ or . are not data to writers of Parquet.
    inner = F.substring_index("path", located(spark, folder)[0], -1)
    names = new_arrivals(spark, listed.where(~inner.rlike("/[_.]")), f"{checkpoint}/leafmill_arrivals")

    def write(batch: DataFrame, number: int) -> None:
        paths = [r[0] for r in batch.select("path").collect()]  # NAMES_IN_PART at most
        if not paths:
            return
        known = _logged(spark, log)
        schema = merge_schemas([*known, *footer_schemas(spark, batch, folder)])
        if not known or schema != merge_schemas(known):
            _log(spark, log, schema)
        # The stream has written its id there before its first batch.
        name = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        rows = spark.read.schema(schema).parquet(*(GLOB.sub(r"\\\1", path) for path in paths))
        writer = rows.write.mode("overwrite").partitionBy(partition_by)
        writer.parquet(f"{target}/_batch={name}-{number:09d}")

    stream = stream_parquet(
        spark, names, listed.schema, **{"maxFilesPerTrigger": "1", **(limits or {})}
    )
    _run(stream.writeStream.foreachBatch(write), checkpoint)
    schema = merge_schemas(_logged(spark, log))
    if not schema.fields:
        return spark.createDataFrame([], schema)
    full = T.StructType([*schema.fields, T.StructField("_batch", T.StringType())])
    return spark.read.schema(full).parquet(target).drop("_batch")


def _log(spark: SparkSession, log: str, schema: T.StructType) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").write.mode("append").text(log)


def _logged(spark: SparkSession, log: str) -> list[T.StructType]:
    """Schemas noted so far; their union is the stream's."""
    try:
        rows = spark.read.text(log).collect()  # one per change of the schema
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [T.StructType.fromJson(json.loads(r[0])) for r in rows]


def stream_view(spark: SparkSession, table: str, view: str) -> DataFrame:
    """Register the stream over ``table`` as a temporary view and return it."""
    stream_table(spark, table).createOrReplaceTempView(view)
    return spark.table(view)


def stream_parquet(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str,
    glob: str = "*.parquet",
    **limits: str,
) -> DataFrame:
    """Rows of the Parquet files that arrive in ``folder``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob).options(**limits)
    return reader.format("parquet").load(folder)


def new_arrivals(spark: SparkSession, listed: DataFrame, arrivals: str) -> str:
    """Add the rows of a listing that the table at ``arrivals`` lacks to it. Returns its path.

    The table holds names, times and lengths, is only added to, and is there to be streamed: a part
    of it has ``NAMES_IN_PART`` rows at most. A run that was lost half-way is made up by the next.
    """
    try:
        listed = new_files(listed, spark.read.schema(listed.schema).parquet(arrivals))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
    fresh = written(spark, listed, "arrivals")
    # Without new names only a missing table is made.
    mode = "ignore" if fresh.isEmpty() else "append"
    fresh.write.mode(mode).option("maxRecordsPerFile", NAMES_IN_PART).parquet(arrivals)
    return arrivals


def stream_new_files(
    spark: SparkSession,
    folder: str,
    arrivals: str,
    suffix: str = ".pdf",
    limit: int = MAX_CONTENT,
    **limits: str,
) -> DataFrame:
    """File rows of the files with ``suffix`` that arrive in ``folder`` or below it, as a stream.

    The names that have arrived are kept in the table at ``arrivals``, one folder for each
    stream: each call lists the tree, adds what is new there, and returns a stream over that
    table whose tasks read the contents. So files with hidden names arrive like any other, and a file
    of more than ``limit`` bytes, or one that cannot be read, is a row with an ``error``. A file that
    was changed arrives again.
    """
    names = new_arrivals(spark, list_tree(spark, folder, suffix), arrivals)
    schema = spark.read.parquet(names).schema
    return with_contents(spark, stream_parquet(spark, names, schema, **limits), folder, limit)


def upsert_stream(
    stream: DataFrame,
    store: KeyedTable,
    seq: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Upsert everything available into ``store``, wait until done.

    A micro-batch that runs again after a crash rewrites the same items with the same values. Only
    the last one can run again, so no later item is undone.
    """

    def write(batch: DataFrame, _number: int) -> None:
        store.upsert(prepare(batch), seq)

    _run(stream.writeStream.foreachBatch(write), checkpoint)


def summarize_new_files(
    spark: SparkSession,
    folder: str,
    extractor: Model,
    store: KeyedTable,
    checkpoint: str,
    suffix: str = ".pdf",
    limits: dict[str, str] | None = None,
    limit: int = MAX_CONTENT,
    **options: object,
) -> None:
    """Every new file of ``folder`` becomes an item of ``store``; run it whenever files arrive.

    ``store`` has the columns of :data:`leafmill.plans.flow.ITEM_SCHEMA`. Of two files with one id
    the one modified last wins. ``options`` go to :func:`leafmill.plans.flow.items_from_files`.
    A file of more than ``limit`` bytes, or one that cannot be read, becomes an item without text and
    with an error. Names are kept below ``checkpoint``, see :func:`stream_new_files`.
    """

    def prepare(batch: DataFrame) -> DataFrame:
        items = items_from_files(batch, extractor, keep=["modificationTime"], **options)
        order = F.struct("modificationTime", "Filepath")
        return items.withColumn("order", order).drop("modificationTime")

    arrivals = f"{checkpoint}/leafmill_arrivals"
    stream = stream_new_files(spark, folder, arrivals, suffix, limit, **(limits or {}))
    upsert_stream(stream, store, "order", checkpoint, prepare)
