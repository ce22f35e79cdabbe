"""What the training-data operators share: column selection, shipping the code, batches, shared keys.

All operators take a frame, the name of its id column and the name of its text column, and select
those two first, so further columns of any name cannot clash with what an operator adds.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parents[1]
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a Python task turns into one output batch; bounds what a batch holds besides texts.
OUT_ROWS = 20_000


def ship(spark: SparkSession) -> None:
    """Hand the package to the Python workers, once per application (what ``--py-files`` does)."""
    context = spark.sparkContext
    if getattr(context, "_leafmill_shipped", False):
        return
    folder = Path(tempfile.mkdtemp(prefix="leafmill-code-"))
    archive = folder / "leafmill_code.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    context._leafmill_shipped = True


def tidy(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of a query when it has ended.

    The multi-step operators write what they need again, so the files of earlier steps are waste.
    """
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def id_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, as ``id`` and ``text``."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if the table has a column of that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def id_type(df: DataFrame, id_col: str) -> str:
    return df.schema[id_col].dataType.simpleString()


#: What one Arrow batch may hold; whole texts are large rows.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def map_rows(df: DataFrame, make: Callable, schema) -> DataFrame:
    """``mapInArrow`` with a function from an iterator of batches to an iterator of batches.

    Batches are kept small, so that a worker's memory does not follow the length of the texts.
    """
    spark = df.sparkSession
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(make, schema)


def small_batches(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds about ``most`` bytes of text, or a single longer row."""
    for batch in batches:
        rows, start = batch.num_rows, 0
        if not rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.binary_length(column).fill_null(0).to_pylist()
        held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start, rows - start)


def arrow_schema(fields: list[tuple[str, pa.DataType]]) -> pa.Schema:
    return pa.schema([pa.field(name, kind) for name, kind in fields])


def rewrite(df: DataFrame, change: Callable, text_col: str) -> DataFrame:
    """All columns of ``df`` with texts changed and rows left out.

    ``change`` is called once per task and returns a function from a list of texts to new texts
    (None: as they are) and a list of flags for the rows that stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        act = change()
        for batch in small_batches(batches, text_col):
            at = batch.schema.get_field_index(text_col)
            texts, stay = act(batch.column(at).to_pylist())
            if texts is not None:
                columns = list(batch.columns)
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch.filter(pa.array(stay, pa.bool_()))

    return map_rows(df, run, df.schema)
