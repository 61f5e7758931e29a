"""Partitioning helpers.  None of them starts a job or looks at an executed
plan: they read the optimizer's size estimate of the frame."""

from __future__ import annotations

from pyspark.sql import DataFrame


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate for the frame's output (no job runs)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _split_bytes(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("spark.sql.files.maxPartitionBytes", "134217728b").lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(conf[-1:], 0)
    return max(1, int(conf[:-1] if unit else conf) << unit)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Deal a small input (fewer splits' worth of bytes than the cluster has
    cores) to all cores before CPU-heavy per-row work.  A large input already
    arrives in many splits and passes through, so nothing is shuffled at scale,
    and so does one of as many files as cores, whatever their size.
    A frame without an estimate (an RDD behind it) counts as large, and so does
    a join, whose estimate is the product of its sides: spread a scan before it
    is joined."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    few = estimated_bytes(df) < want * _split_bytes(df) and len(df.inputFiles()) < want
    return df.repartition(want) if few else df


def range_parts(df: DataFrame) -> int:
    """Partition count for a range repartition: the session's shuffle width,
    which its user sets to the data, and never fewer than the cluster's cores."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)
