"""Schemas out of the footers of Parquet files."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from leafmill.plans.workers import ship_package
from leafmill.sources.files import Connect, connect_arrow, located

# Fixed value: where Spark keeps a schema in a footer.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def footer_schemas(
    spark: SparkSession, files: DataFrame, folder: str, connect: Connect = connect_arrow
) -> list[T.StructType]:
    """The different schemas of the Parquet files named in the column ``path``, read in tasks.

    Paths lie below ``folder``, as a listing of it gives them. Only the different schemas come to
    the driver.
    """
    ship_package(spark)
    root, reached = located(spark, folder)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = connect(reached)
        seen: set[str] = set()
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with store.open_input_file(base + name[len(root) :]) as source:
                    schema = pq.read_schema(source)
                kept = (schema.metadata or {}).get(SPARK_SCHEMA)
                seen.add(kept.decode() if kept else from_arrow_schema(schema).json())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], ["schema"])

    found = files.select("path").repartition(tasks, "path").mapInArrow(run, "schema string")
    texts = sorted(r[0] for r in found.distinct().collect())
    return [T.StructType.fromJson(json.loads(text)) for text in texts]


def merge_schemas(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns, those of earlier schemas first. A column with two types is an error."""
    merged: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            kind = merged.setdefault(field.name, field.dataType)
            if kind.simpleString() != field.dataType.simpleString():
                raise ValueError(
                    f"column {field.name} is {kind.simpleString()} and "
                    f"{field.dataType.simpleString()}"
                )
    return T.StructType([T.StructField(name, kind) for name, kind in merged.items()])
