"""What a plan can know before it runs: splits of scans, sizes of sides."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame, *key: str) -> DataFrame:
    """Distribute a scan by ``key`` if it has fewer input splits than the cluster has cores.

    Costly row expressions would otherwise run on a few cores, for instance over one file with one
    row group. A large input has more splits than cores and is returned as it is, without a
    shuffle. ``scan`` should be a plain scan: its splits are counted, nothing is run.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *key)


def broadcast_fits(df: DataFrame) -> bool:
    """Whether Spark itself will broadcast ``df`` in a join, by its own estimate and threshold."""
    session = df._jdf.sparkSession().sessionState()
    limit = session.conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return 0 <= int(str(size)) <= limit
