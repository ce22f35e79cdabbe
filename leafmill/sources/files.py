"""Files: listing a tree, and reading contents.

Names and contents are separate steps. A tree is listed breadth first in tasks, one folder per row,
until no folder is left; every name is a row, also those that begin with ``_`` or ``.``, which
Spark's file sources leave out. Contents are read by the task that holds the name, after every filter
and join on names, and are never shuffled.

Tasks reach the files through Arrow's file systems (local, HDFS, S3, GCS, Azure). A path that the
session resolves to another one, such as a mount, is resolved once on the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.operators.filters import keep_substring
from leafmill.plans.settings import settings
from leafmill.plans.workdir import fresh_dir, written
from leafmill.plans.workers import ship_package

# Fixed value: the columns of a binary file row.
BINARY_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), True),
        T.StructField("modificationTime", T.TimestampType(), True),
        T.StructField("length", T.LongType(), True),
        T.StructField("content", T.BinaryType(), True),
    ]
)
#: What identifies a version of a file.
IDENTITY = ["path", "modificationTime", "length"]

# The largest content one value can hold, and the bytes of contents in one batch unless one is larger.
MAX_CONTENT = 2**31 - 1 - 1024
BATCH_BYTES = 8 << 20
#: Bytes in one row of a file that is kept in pieces: a task holds some copies of a row.
PIECE_BYTES = 4 << 20
#: Entries that a task lists below one folder before it hands the folders that are left on.
ENTRIES = 10_000
#: Names of one store in Hadoop and in Arrow.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}

Connect = Callable[[str], tuple[arrow_fs.FileSystem, str]]


def connect_arrow(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of ``uri`` and the path in it."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return arrow_fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return arrow_fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{quote(rest, safe='/:@')}")


def located(spark: SparkSession, folder: str) -> tuple[str, str]:
    """``folder`` as the session names it and as tasks reach it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return (
        fs.makeQualified(path).toString().rstrip("/"),
        fs.resolvePath(path).toString().rstrip("/"),
    )


_LISTED = "folder string, path string, millis bigint, length bigint"


def _expand(root: str, reached: str, suffix: str, connect: Connect, left) -> Callable:
    """Task that lists folders (given relative to the root) and what lies below them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = connect(reached)

        def below(folder: str) -> Iterator[tuple]:
            open_folders, seen = [folder], 0
            while open_folders and seen < ENTRIES:
                at = open_folders.pop()
                infos = store.get_file_info(
                    arrow_fs.FileSelector(f"{base}/{at}".rstrip("/") or "/", allow_not_found=True)
                )
                seen += len(infos) + 1
                for info in infos:
                    inner = f"{at}/{info.base_name}".lstrip("/")
                    if info.type == arrow_fs.FileType.Directory:
                        open_folders.append(inner)
                    elif info.type == arrow_fs.FileType.File and info.base_name.endswith(suffix):
                        millis = (info.mtime_ns or 0) // 1_000_000
                        yield None, f"{root}/{inner}", millis, info.size
            left.add(len(open_folders))
            for rest in open_folders:
                yield rest, None, None, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            folders, paths, times, sizes = zip(*rows) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(folders, pa.string()),
                    pa.array(paths, pa.string()),
                    pa.array(times, pa.int64()),
                    pa.array(sizes, pa.int64()),
                ],
                ["folder", "path", "millis", "length"],
            )

        for batch in batches:
            for folder in batch.column(0).to_pylist():
                rows: list[tuple] = []
                for row in below(folder):
                    rows.append(row)
                    if len(rows) >= ENTRIES:
                        yield out(rows)
                        rows = []
                yield out(rows)

    return run


def list_tree(
    spark: SparkSession, folder: str, suffix: str = "", connect: Connect = connect_arrow
) -> DataFrame:
    """``path, modificationTime, length`` of every file below ``folder`` whose name ends in ``suffix``.

    Breadth first: each round lists the folders that the one before left open, spread over the tasks,
    and writes what it found to the shared folder; only the number of open folders comes to the
    driver. A task goes on below a folder until it has seen ``ENTRIES`` entries, so a small tree takes
    one round. The entries of a single folder are listed by one task. No content is opened. An empty
    folder gives no rows; a missing one fails.
    """
    ship_package(spark)
    context = spark.sparkContext
    root, reached = located(spark, folder)
    folders, rounds = spark.range(1).select(F.lit("").alias("folder")).coalesce(1), []
    while True:
        left = context.accumulator(0)
        rounds.append(fresh_dir(spark, "listing"))
        run = _expand(root, reached, suffix, connect, left)
        folders.mapInArrow(run, _LISTED).write.parquet(rounds[-1])
        if not left.value:
            break
        level = spark.read.schema(_LISTED).parquet(rounds[-1]).where("folder IS NOT NULL")
        folders = level.select("folder").repartition(context.defaultParallelism, "folder")
    found = spark.read.schema(_LISTED).parquet(*rounds).where("folder IS NULL")
    return found.select("path", F.timestamp_millis("millis").alias("modificationTime"), "length")


def list_files(
    spark: SparkSession, folder: str, suffix: str = ".pdf", modified_after: str | None = None
) -> DataFrame:
    """Paths of the files below ``folder`` whose name ends in ``suffix``, hidden names included."""
    listed = list_tree(spark, folder, suffix)
    if modified_after:
        listed = listed.where(F.col("modificationTime") > F.lit(modified_after).cast("timestamp"))
    return listed.select("path")


def list_files_containing(spark: SparkSession, folder: str, part: str = ".pdf") -> DataFrame:
    """Paths of the files below ``folder`` with ``part`` anywhere in the path, hidden names included."""
    return keep_substring(list_tree(spark, folder).select("path"), part)


def new_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of a listing whose version of the file is not among ``known``. Names alone move."""
    same: list[Column] = [listed[c].eqNullSafe(known[c]) for c in IDENTITY]
    return listed.join(known.select(*IDENTITY), same, "left_anti")


def with_contents(
    spark: SparkSession,
    listed: DataFrame,
    folder: str,
    limit: int = MAX_CONTENT,
    connect: Connect = connect_arrow,
) -> DataFrame:
    """``listed`` and ``content, error``: the bytes of each file, read by the task that holds its row.

    ``listed`` holds paths below ``folder`` and their ``length``. The rows are spread over the tasks
    first, while they are names; whatever is joined or filtered afterwards would move contents. A
    file of more than ``limit`` bytes is not opened; it and one that cannot be read, or is gone, have
    an error in place of the content, so no file is lost and none fails the run.
    """
    ship_package(spark)
    root, reached = located(spark, folder)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = connect(reached)

        def read(path: str, length: int) -> tuple[bytes | None, str | None]:
            if length is not None and length > limit:
                return None, "file too large"
            try:
                with store.open_input_stream(base + path[len(root) :]) as source:
                    content = source.read(limit + 1)
            except Exception as problem:  # whatever the store raises
                return None, f"{type(problem).__name__}: {problem}"
            return (content, None) if len(content) <= limit else (None, "file too large")

        for batch in batches:
            paths, lengths = (batch.column(c).to_pylist() for c in ("path", "length"))
            start, held, size = 0, [], 0
            for at, (path, length) in enumerate(zip(paths, lengths)):
                if held and size + (length or 0) > BATCH_BYTES:
                    yield _with(batch.slice(start, at - start), held)
                    start, held, size = at, [], 0
                held.append(read(path, length))
                size += len(held[-1][0] or b"")
            if held:
                yield _with(batch.slice(start), held)

    fields = [*listed.schema.fields, BINARY_SCHEMA["content"], T.StructField("error", T.StringType())]
    return listed.repartition(tasks, "path").mapInArrow(run, T.StructType(fields))


def _with(batch: pa.RecordBatch, read: list[tuple]) -> pa.RecordBatch:
    contents, errors = zip(*read)
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(contents, pa.binary()), pa.array(errors, pa.string())],
        [*batch.schema.names, "content", "error"],
    )


def with_pieces(
    spark: SparkSession,
    listed: DataFrame,
    folder: str,
    limit: int | None = None,
    piece: int = PIECE_BYTES,
    connect: Connect = connect_arrow,
) -> DataFrame:
    """``listed`` and ``part, last, content, error``: the bytes of each file in rows of at most ``piece``.

    A file of any length is as many rows as it has pieces, numbered by ``part`` from 0; ``last`` marks
    the last one. A smaller or empty file is one row. The pieces are spread over the tasks while they
    are names, so those of one file are read by many tasks; what a file has grown by since it was
    listed follows in further pieces. Of one that has more than ``limit`` bytes, or cannot be read, a
    row has an error in place of the content.
    """
    ship_package(spark)
    root, reached = located(spark, folder)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = F.lit(limit).cast("long")
    pieces = F.ceil(F.coalesce("length", F.lit(0)) / F.lit(piece)).cast("int")
    count = F.when(F.col("length") > most, 1).otherwise(F.greatest(pieces, F.lit(1)))
    parts = listed.withColumn("part", F.explode(F.sequence(F.lit(0), count - 1)))
    fields = [*parts.schema.fields, T.StructField("last", T.BooleanType())]
    fields += [BINARY_SCHEMA["content"], T.StructField("error", T.StringType())]
    parts = parts.withColumn("last", F.col("part") == count - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = connect(reached)

        def read(path: str, length: int | None, part: int, last: bool) -> Iterator[tuple]:
            """``part, last, content, error`` of a piece, and of what follows the last one."""
            if limit is not None and (length or 0) > limit:
                yield part, last, None, "file too large"
                return
            try:
                with store.open_input_file(base + path[len(root) :]) as source:
                    source.seek(min(part * piece, source.size()))
                    content = source.read(piece)
                    while last and (more := source.read(piece)):
                        yield part, False, content, None
                        part, content = part + 1, more
                    grown = limit is not None and part * piece + len(content) > limit
            except Exception as problem:  # whatever the store raises
                yield part, last, None, f"{type(problem).__name__}: {problem}"
                return
            yield part, last, *((None, "file too large") if grown else (content, None))

        for batch in batches:
            names = batch.schema.names
            kept = [c for c, name in zip(batch.columns, names) if name not in ("part", "last")]
            kept_names = [name for name in names if name not in ("part", "last")]
            asked = zip(*(batch.column(c).to_pylist() for c in ("path", "length", "part", "last")))
            of, held, size = [], [], 0

            def flush() -> pa.RecordBatch:
                kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.string())
                made = [pa.array(c, k) for c, k in zip(zip(*held), kinds)]
                return pa.RecordBatch.from_arrays(
                    [*(c.take(pa.array(of, pa.int64())) for c in kept), *made],
                    [*kept_names, "part", "last", "content", "error"],
                )

            for row, file in enumerate(asked):
                for found in read(*file):
                    if held and size + len(found[2] or b"") > BATCH_BYTES:
                        yield flush()
                        of, held, size = [], [], 0
                    of.append(row)
                    held.append(found)
                    size += len(found[2] or b"")
            if held:
                yield flush()

    return parts.repartition(tasks, "path", "part").mapInArrow(run, T.StructType(fields))


def digests(pieces: DataFrame) -> DataFrame:
    """``path, modificationTime, length, digest``: the SHA-256 of each file kept in pieces.

    ``pieces`` has the columns of :func:`with_pieces`. A file of one row is digested where it lies;
    the pieces of others move to one task in order, which holds one of them at a time. A file with a
    piece that could not be read has no digest. A file that was added twice is digested twice. The
    digests are computed once, into the shared folder.
    """
    spark = pieces.sparkSession
    single = (F.col("part") == 0) & F.col("last")
    whole = pieces.where(single).select(*IDENTITY, F.sha2("content", 256).alias("digest"))
    moved = pieces.where(~single).select(*IDENTITY, "part", "content")
    moved = moved.repartition(*IDENTITY).sortWithinPartitions(*IDENTITY, "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, file, before, states = None, None, None, []

        def finish() -> Iterator[pa.RecordBatch]:
            if states:
                made = [s and s.hexdigest() for s in states]
                columns = [pa.array([v] * len(made), f.type) for v, f in zip(file, schema)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(made, pa.string())], [*IDENTITY, "digest"])

        for batch in batches:
            schema = [batch.schema.field(name) for name in IDENTITY]
            for row in range(batch.num_rows):
                here = [batch.column(c)[row] for c in range(len(IDENTITY))]
                if file is None or here != file:
                    yield from finish()
                    file, before, states = here, None, []
                part, content = batch.column(3)[row].as_py(), batch.column(4)[row]
                copy = copy + 1 if part == before else 0
                before = part
                if copy == len(states):
                    states.append(hashlib.sha256())
                if not content.is_valid:
                    states[copy] = None
                elif states[copy]:
                    states[copy].update(content.as_buffer())
        yield from finish()

    kind = T.StructType([*moved.schema.fields[:3], T.StructField("digest", T.StringType())])
    # Else a batch has 10 000 rows, whatever they hold.
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        return written(spark, whole.unionByName(moved.mapInArrow(run, kind)), "digests")


def read_files(
    spark: SparkSession, folder: str, suffix: str = ".pdf", limit: int = MAX_CONTENT
) -> DataFrame:
    """Every file below ``folder`` whose name ends in ``suffix``: its row, ``content`` and ``error``."""
    return with_contents(spark, list_tree(spark, folder, suffix), folder, limit)
