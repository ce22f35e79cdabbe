"""Where jobs put the tables they write between steps."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_passing: ContextVar[list[str] | None] = ContextVar("_passing", default=None)


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; on a local master a temporary folder if none is set."""
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    made = tempfile.mkdtemp(prefix="leafmill-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path that no other run uses. The folder itself is made by whoever writes to it."""
    return f"{shared_root(spark)}/leafmill/{name}-{uuid.uuid4().hex}"


def fresh_table(name: str) -> str:
    """A table name that no other run uses."""
    return f"leafmill_{name}_{uuid.uuid4().hex}"


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what :func:`written` made inside, except for what it was told to keep."""
    made: list[str] = []
    token = _passing.set(made)
    try:
        yield
    finally:
        _passing.reset(token)
        for name in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def written(
    spark: SparkSession, df: DataFrame, name: str, codec: str | None = None, keep: bool = False
) -> DataFrame:
    """``df`` computed once into the shared folder; later steps read the files, whose size is known.

    Inside :func:`passing` the files go when the block ends, unless they are to be kept.
    """
    path = fresh_dir(spark, name)
    made = _passing.get()
    if made is not None and not keep:
        made.append(path)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
