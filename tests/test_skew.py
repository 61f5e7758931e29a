"""A third of the corpus in one duplicate group: results stay whole and the
intermediate tables stay linear in the group size (no pair blow-up)."""

from pyspark.sql import functions as F

from winnow.operators import dedup as dd
from winnow.session import table

SF = "/root/testdata/sf0.001"


def test_hot_group(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    n = docs.count()
    copies = docs.where(F.col("doc_id") < n // 2).select((F.col("doc_id") + 1_000_000).alias("doc_id"))
    text0 = docs.where("doc_id = 0").first().text
    copies = copies.select("doc_id", F.lit(text0).alias("text"))
    corpus = docs.unionByName(copies)
    res = dd.deduplicate(dd.normalize_docs(corpus))
    hot = [r.cluster_id for r in res.members.where(F.col("doc_id") == 1_000_000).select("cluster_id").collect()]
    assert hot == [0]
    size = res.members.where(F.col("cluster_id") == 0).count()
    assert size >= n // 2 + 1
    # membership rows stay linear: at most one row per band per linked doc
    assert res.linked.count() <= 9 * res.linked.select("doc_id").distinct().count()
    kept_hot = res.kept.where((F.col("doc_id") == 0) | (F.col("doc_id") >= 1_000_000)).count()
    assert kept_hot == 1
    assert res.kept.count() + res.removed.count() == corpus.count()


def test_hot_bucket_is_spread(spark):
    """Half of the rows in one bucket: the joins of the graph loops deal it to
    several tasks, none of which gets more than a small multiple of the mean."""
    n, parts = 40_000, 32
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(0).alias("band"),
                                 F.when(F.col("id") < n // 2, 7).otherwise(F.col("id")).cast("bigint").alias("k1"),
                                 F.lit(1).cast("bigint").alias("k2"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold",
                                             "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        linked = dd.linked_members(rows)
        per_task = linked.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in per_task) == n // 2
        assert max(r["count"] for r in per_task) <= 4 * (n // 2) / dd.SALTS
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    groups = dd.connected_groups(linked)
    assert groups.agg(F.countDistinct("group_id")).first()[0] == 1 and groups.count() == n // 2
