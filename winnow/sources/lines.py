"""Text-line sources with stable, distributed line numbers.

``spark.read.text`` keeps line order inside a file split and numbers rows
with ``monotonically_increasing_id``, which has no gap inside a split.  A small
count table per split (file, first byte) gives every split its offset in byte
order, however the splits are packed into tasks, so global line numbers are
computed without a sort and without moving lines through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLICE_BYTES = 32 << 20  # of the optimizer's estimate, which for Parquet is of compressed bytes
MOST_PARTS = 2000


def read_lines(spark: SparkSession, paths, per_file: bool = False, with_split: bool = False) -> DataFrame:
    """(path, line_no, value): 1-based physical line numbers over the files
    taken in path order (or restarting in every file with ``per_file``).
    ``with_split`` keeps the split's first byte as _block."""
    if isinstance(paths, str):
        paths = [paths]
    raw = spark.read.text(paths).select(F.input_file_name().alias("path"), F.col("_metadata.file_block_start").alias("_block"), "value",
                                        F.monotonically_increasing_id().alias("_mid"))
    splits = raw.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # offsets over the (tiny) split table: one row per file split
    order = Window.orderBy("path", "_block") if not per_file else Window.partitionBy("path").orderBy("_block")
    ahead = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("path", "_block", "_first", ahead.alias("_off"))
    out = raw.join(F.broadcast(splits), ["path", "_block"])  # one short row per split: the lines are not shuffled
    return out.select("path", *(["_block"] if with_split else []), (F.col("_off") + F.col("_mid") - F.col("_first") + 1).alias("line_no"), "value")


def in_order(df: DataFrame, order_col: str, partitions: int | None = None, ids: DataFrame | None = None) -> DataFrame:
    """``df`` in ``order_col`` order, every partition one ordered slice of about
    SLICE_BYTES; per-row expressions put on top of it are run once, behind the
    shuffle.

    A range partitioning samples its input, which runs a costly ``df`` twice.
    With ``ids``, a cheap table of (at least) the values of a numeric order
    column, the cuts come from a sketch of those instead, and ``df`` runs once."""
    from winnow.operators.partitioning import estimated_bytes, range_parts
    n = partitions or max(range_parts(df), min(MOST_PARTS, estimated_bytes(df if ids is None else ids) // SLICE_BYTES))
    if ids is None:
        out = df.repartitionByRange(n, order_col)
    else:
        probs = [i / n for i in range(1, n)]
        cuts = ids.agg(F.percentile_approx(order_col, probs, 100 * n).alias("q")).first()["q"] if probs else None
        edges = F.array(*[F.lit(c) for c in sorted(set(cuts or []))])
        slot = F.size(F.filter(edges, lambda c: c < F.col(order_col))) if cuts else F.lit(0)
        out = df.withColumn("_slot", slot).repartitionById(n, F.col("_slot")).drop("_slot")
    return out.sortWithinPartitions(order_col)


def write_lines(df: DataFrame, path: str, order_col: str, value_col: str = "value",
                partitions: int | None = None, ids: DataFrame | None = None) -> None:
    """Write one text line per row, files and lines in ``order_col`` order:
    every task writes one ordered slice (``ids``: see ``in_order``)."""
    in_order(df, order_col, partitions, ids).select(value_col).write.mode("overwrite").text(path)
