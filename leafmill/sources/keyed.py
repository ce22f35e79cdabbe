"""A table of items by key on partitioned Parquet: upsert, load, delete all, read.

Rows lie in ``parts`` partitions by the hash of their key. An upsert reads and rewrites the partitions
that its keys fall into and no other, by Spark's dynamic partition overwrite: the new files are
staged next to the table and take the place of the partitions' old ones when the job commits. Every
key lives in one partition, so that partition's rows and its share of the batch are all an upsert
needs. On a table format with row-level operations use ``operators.upsert.merge_sql`` instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill.operators.upsert import collapse_keyed, merge_keyed
from leafmill.plans.settings import settings
from leafmill.plans.workdir import written

PARTS = 16
_PART = "_part"
#: The join goes by partition and key; rows dealt by partition alone need not move again.
_BY_PART = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


class KeyedTable:
    """Items keyed by ``key`` with the columns of ``schema``; ``maps`` are merged entry by entry.

    ``parts`` stays the same for the life of a table; choose it so that one partition of the full
    table fits a task comfortably. One writer at a time. NULL is a key like any other.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType | str,
        key: Sequence[str] = ("id",),
        maps: Sequence[str] = (),
        parts: int = PARTS,
    ) -> None:
        self.spark, self.key, self.maps, self.parts = spark, list(key), list(maps), parts
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self.path = f"{root.rstrip('/')}/parts-{parts}"
        if self._exists(root) and not self._exists(self.path):
            raise ValueError(f"{root} is not a table of {parts} parts")

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def _part(self, key: Column) -> Column:
        """Partition of a key struct."""
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def _key(self) -> Column:
        kinds = {f.name: f.dataType for f in self.schema.fields}
        return F.struct(*(F.col(c).cast(kinds[c]).alias(c) for c in self.key))

    def _stored(self) -> DataFrame:
        """Items with the partition they lie in, which prunes what is read."""
        schema = T.StructType([*self.schema.fields, T.StructField(_PART, T.IntegerType())])
        if not self._exists(self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def state(self) -> DataFrame:
        """The current items, one row per key."""
        return self._stored().drop(_PART)

    def _write(self, items: DataFrame, how: str) -> None:
        typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        writer = items.select(*typed, _PART).write.partitionBy(_PART).mode("overwrite")
        writer.option("partitionOverwriteMode", how).parquet(self.path)

    def merged(self, batch: DataFrame, seq: str, touched: Sequence[int]) -> DataFrame:
        """The rows of the touched partitions after ``batch``, which has been collapsed to its keys.

        Both sides are dealt by partition once; the join uses that.
        """
        stored = self._stored().where(F.col(_PART).isin(list(touched)))
        tasks = max(1, min(len(touched), int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        old = stored.withColumn("_key", self._key()).repartition(tasks, _PART)
        new = batch.withColumn(_PART, self._part(F.col("_key"))).repartition(tasks, _PART)
        return merge_keyed(old, new, [_PART, "_key"], self.schema.names, self.key, self.maps)

    def upsert(self, batch: DataFrame, seq: str) -> None:
        """Apply ``batch``; ``seq`` orders items of one key. Applying it again changes nothing.

        Columns that ``batch`` lacks keep their values. A value that its column's type cannot hold
        fails the batch before anything is replaced. An empty batch writes nothing.
        """
        unknown = [c for c in batch.columns if c != seq and c not in self.schema.names]
        if unknown:
            raise ValueError(f"not columns of the table: {unknown}")
        typed = [
            F.col(c).cast(self.schema[c].dataType).alias(c) if c != seq else F.col(c)
            for c in batch.columns
        ]
        given = batch.select(*typed)
        latest = written(
            self.spark, collapse_keyed(given, self._key(), self.key, seq, self.maps), "batch"
        )
        # At most ``parts`` numbers.
        touched = [r[0] for r in latest.select(self._part(F.col("_key"))).distinct().collect()]
        if touched:
            with settings(self.spark, _BY_PART):
                self._write(self.merged(latest, seq, touched), "dynamic")

    def load(self, items: DataFrame) -> None:
        """Replace the whole table by ``items``, which hold one row per key and are not read from it."""
        dealt = items.withColumn(_PART, self._part(self._key()))
        # One file per partition, or several where a partition is large.
        self._write(dealt.hint("rebalance", _PART), "static")

    def delete_all(self) -> int:
        """Remove every item and return how many there were."""
        count = self._stored().count()
        self.load(self.spark.createDataFrame([], self.schema))
        return count
