"""Helpers shared by the operators: written intermediates, document-order
buckets, Arrow text access and per-process caches."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back: cuts lineage, survives lost executors, and gives joins a plain scan
    side that adaptive execution can split when a key is hot."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id bigint, text string), whatever other columns there are."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def utf8(batch: pa.RecordBatch, col: str = "text") -> list[bytes]:
    """The column's values as UTF-8 bytes (null: empty), without decoding."""
    return [b or b"" for b in batch.column(col).cast(pa.binary()).to_pylist()]


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def order_cuts(df: DataFrame, col: str, parts: int) -> list[int]:
    """At most ``parts - 1`` ascending cut points of a bigint column, from one
    narrow aggregate over it (bounded sketch; null values are left out).  A
    row's bucket is the number of cuts at or below its value, so buckets are
    in value order whatever the sketch's error."""
    if parts <= 1:
        return []
    probs = [i / parts for i in range(1, parts)]
    got = df.agg(F.percentile_approx(col, probs, 100 * parts).alias("q")).first()["q"]
    return sorted(set(got or []))


def bucket_of(col: Column, cuts: list[int]) -> Column:
    """The bucket of a bigint column among cut points (null: the first)."""
    edges = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def bucket(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(), side="right").astype(np.int32))

    return F.when(col.isNull(), 0).otherwise(bucket(F.coalesce(col, F.lit(0).cast("bigint"))))


def process_cache(name: str) -> dict:
    """A dict that lives as long as this Python worker process, so models and
    lookups loaded by one task serve the next ones too."""
    store = sys.modules["__main__"].__dict__.setdefault("_winnow_process_cache", {})
    return store.setdefault(name, {})


LEAN_ROWS, LEAN_BYTES = 512, 4 << 20  # rows and bytes handled at once


def slices(batch: pa.RecordBatch | pa.Array) -> Iterator:
    """The batch in slices of at most LEAN_ROWS rows, fewer where rows are long."""
    step = max(1, min(LEAN_ROWS, LEAN_BYTES * len(batch) // max(1, batch.nbytes)))
    for lo in range(0, len(batch), step):
        yield batch.slice(lo, step)


def release() -> None:
    """Give memory that this worker has freed back to the system: worker
    processes live on and serve the tasks of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def trimmed(run):
    """A mapInArrow body that leaves a trimmed worker behind its task."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()
    return wrapped


def lean(run):
    """A trimmed body that sees its batches in small slices, so Python objects
    of a few rows exist at a time."""
    return trimmed(lambda batches: run(s for b in batches for s in slices(b)))


def map_rows(docs: DataFrame, fn) -> DataFrame:
    """``docs`` with every batch slice put through ``fn`` (RecordBatch -> the
    same columns, of changed or fewer rows).  Rows pass through the worker
    whole, so the JVM keeps no copy of them while it waits for results."""
    schema = docs.schema

    def run(batches):
        for b in batches:
            yield fn(b)
    return docs.mapInArrow(lean(run), schema)


def replaced(batch: pa.RecordBatch, col: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with one column's values replaced, in the column's own type."""
    at = batch.schema.get_field_index(col)
    arrays = list(batch.columns)
    arrays[at] = values.cast(batch.schema.field(at).type)
    return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)
