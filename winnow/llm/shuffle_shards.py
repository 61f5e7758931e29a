"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass 1 scatters records with seeded hashes: the shard is the one of highest
hash weight of (doc_id, shard) -- rendezvous hashing, so a further shard takes
rows only into itself -- and the bucket inside the shard is a second hash of
the record.  The bucket count follows the measured bytes, so a bucket is
memory-sized at any scale, and each bucket is one partition of one exchange.
Pass 2 holds a bucket as one array, puts it in hash order (so a task that is run
again starts from the same array), applies the seeded Fisher-Yates ``shuffle``
and writes it.  A slot is the bucket's first slot, a prefix sum over the
buckets of its shard, plus the position in the shuffled bucket.

Law: ``key``.  Hot sources and copies do not matter, since ids decide the shard
and ids with texts the bucket.

Defined results: null text has size 1 and a null crc of text; null doc_ids share
a shard (nothing but the id decides it) but spread over its buckets; repeated
rows each get a slot; an empty table gives no rows; input columns named shard,
slot, grown_shard or size are replaced, all others are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.common import materialize
from winnow.session import scratch_path

SHARDS = 16
SEED = 20260
BUCKET_BYTES = 16 << 20  # texts of one bucket, about
OWN = ("shard", "slot", "grown_shard", "size")


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """Rendezvous hashing: the shard of highest weight for this key."""
    weight = lambda s: F.struct(F.xxhash64(F.lit(seed), key, s).alias("w"), s.alias("s"))
    return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), weight))["s"]


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def shuffled(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with size, shard, slot and grown_shard, in slot order inside
    every bucket's partition."""
    docs = docs.drop(*OWN)
    key = F.col(id_col).cast("bigint")
    total = docs.agg(F.sum(byte_size(F.col(text_col)))).first()[0] or 0
    per_shard = max(1, -(-total // (shards * bucket_bytes)))
    at = (shard_of(key, shards, seed) * per_shard
          + F.pmod(F.xxhash64(F.lit(seed + 1), key, F.col(text_col)), F.lit(per_shard))).cast("int")
    # counts per bucket: at most total / bucket_bytes rows
    counts = materialize(docs.select(at.alias("_bucket")).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")), "buckets")
    before = Window.partitionBy("_shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (counts.withColumn("_shard", (F.col("_bucket") / per_shard).cast("int"))
             .select("_bucket", "_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    record = F.struct(F.xxhash64(F.lit(seed + 2), key, F.col(text_col)).alias("_h"), F.struct(*docs.columns).alias("_r"))
    # ordered by hash, then by id: no column needs to be orderable but these
    scattered = docs.select(at.alias("_bucket"), record.alias("_x")).repartitionById(shards * per_shard, F.col("_bucket"))
    order = lambda a, b: F.when(a["_h"] < b["_h"], -1).when(a["_h"] > b["_h"], 1).otherwise(0)
    mixed = (scattered.groupBy("_bucket")
             .agg(F.shuffle(F.array_sort(F.collect_list("_x"), order), seed).alias("_all"))
             .select("_bucket", F.posexplode("_all").alias("_pos", "_x")))
    return (mixed.join(bases, "_bucket")
            .select("_x._r.*", "_shard", (F.col("_base") + F.col("_pos")).alias("slot"))
            .withColumnRenamed("_shard", "shard")
            .withColumn("size", byte_size(F.col(text_col)))
            .withColumn("grown_shard", shard_of(key, shards + 1, seed)))


def write_shards(docs: DataFrame, path: str | None = None, **kw) -> DataFrame:
    """Write one folder per shard and read the shards back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shards")
    out = shuffled(docs, **kw)
    out.write.mode("overwrite").partitionBy("shard").parquet(path)
    return spark.read.schema(out.schema).parquet(path)
