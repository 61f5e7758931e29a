"""A signature index that outlives the session, and deduplication batch by batch.

An index is a folder of bucketed, sorted Parquet tables:

* ``signatures`` (doc_id, len, sig), clustered by doc_id -- for inspection;
* ``buckets``    (band, k1, k2, seed, best_len, best_id, n), clustered by the
  bucket -- per batch and LSH bucket: the seed in it, its longest document and
  how many documents it got;
* ``clusters``   (cluster_id, best_len, best_id), clustered by cluster -- the
  longest document each batch brought to a cluster;
* ``linked``     (doc_id), clustered by doc_id -- documents in some cluster;
* ``commits``    one row per finished batch.

Visiting documents in id order, a new batch (ids above all stored ones) cannot
change who is a seed among the old documents, and of the old members of a bucket
only the seed and the longest one can matter to a new document.  So one row per
bucket stands for all old members, a hot bucket of any size is one row a batch,
and all stored tables are merged by max, min and sum alone.  A batch's documents
are signed, joined to the stored buckets (bucketed on the join key: the stored
side is read without an exchange), the greedy rule runs among the new documents
that no old seed covers, and the batch appends its rows.  Old documents are
never signed, shingled or read again.

Rows carry the run that wrote them, and readers look at committed runs alone, so
a batch that fails half-way leaves no trace and can simply be run again.
"""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.operators import dedup as dd

TABLES = {
    "signatures": ("doc_id bigint, len int, sig array<bigint>", ["doc_id"]),
    "buckets": ("band int, k1 bigint, k2 bigint, seed bigint, best_len int, best_id bigint, n bigint", dd.BUCKET),
    "clusters": ("cluster_id bigint, best_len int, best_id bigint", ["cluster_id"]),
    "linked": ("doc_id bigint", ["doc_id"]),
}
COMMITS = "run string, docs bigint, first_id bigint, last_id bigint, bands int, rows int, num_perm int, seed bigint, file_buckets int"


def _best(length: str = "_len", doc: str = "doc_id") -> F.Column:
    """Longest document, ties to the smallest id."""
    return F.max(F.struct(F.col(length).alias("len"), (-F.col(doc)).alias("neg")))


class SignatureIndex:
    """The index in a folder; opened anew in any session."""

    def __init__(self, spark: SparkSession, path: str, cfg: dd.DedupConfig = dd.DEFAULT, file_buckets: int = 32):
        self.spark, self.path, self.cfg = spark, path.rstrip("/"), cfg
        self.file_buckets = file_buckets
        known = self.commits().limit(1).collect()
        if known:
            r = known[0]
            if (r.bands, r.rows, r.num_perm, r.seed) != (cfg.bands, cfg.rows, cfg.num_perm, cfg.seed):
                raise ValueError(f"the index was built with other parameters: {r.asDict()}")
            self.file_buckets = r.file_buckets
        for name in TABLES:
            self._attach(name, written=bool(known))

    # ------------------------------------------------------------ tables

    def _name(self, table: str) -> str:
        return f"winnow_index_{zlib.crc32(self.path.encode()):08x}_{table}"

    def _attach(self, table: str, written: bool) -> None:
        """Name the folder in the session's catalog; the bucket of a file is in
        its name, so nothing but the folder has to survive."""
        cols, keys = TABLES[table]
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self._name(table)} ({cols}, run string) USING parquet PARTITIONED BY (run) "
                       f"CLUSTERED BY ({', '.join(keys)}) SORTED BY ({', '.join(keys)}) INTO {self.file_buckets} BUCKETS "
                       f"LOCATION '{self.path}/{table}'")
        if written:
            self.spark.catalog.recoverPartitions(self._name(table))

    def commits(self) -> DataFrame:
        self.spark.createDataFrame([], COMMITS).write.mode("append").parquet(f"{self.path}/commits")
        return self.spark.read.schema(COMMITS).parquet(f"{self.path}/commits")

    def table(self, table: str) -> DataFrame:
        """The rows of committed runs (one name a batch; ``compact`` merges them)."""
        runs = [r.run for r in self.commits().select("run").collect()]
        return self.spark.table(self._name(table)).where(F.col("run").isin(runs) if runs else F.lit(False)).drop("run")

    def _append(self, table: str, rows: DataFrame, run: str) -> None:
        cols, keys = TABLES[table]
        names = [c.split()[0] for c in cols.split(", ")]
        (rows.select(*names, F.lit(run).alias("run")).repartition(self.file_buckets, *keys)
         .write.mode("append").format("parquet").partitionBy("run").bucketBy(self.file_buckets, *keys).sortBy(*keys)
         .option("path", f"{self.path}/{table}").saveAsTable(self._name(table)))

    def signatures(self) -> DataFrame:
        return self.table("signatures").select("doc_id", "sig")

    def buckets(self) -> DataFrame:
        """One row per bucket: its seed (null if none), longest document, size."""
        t = self.table("buckets").withColumn("neg", -F.col("best_id"))
        return t.groupBy(*dd.BUCKET).agg(F.max("seed").alias("seed"), F.max(F.struct("best_len", "neg")).alias("b"), F.sum("n").alias("n")) \
                .select(*dd.BUCKET, "seed", F.col("b.best_len").alias("best_len"), (-F.col("b.neg")).alias("best_id"), "n")

    # ------------------------------------------------------------- batches

    def add(self, docs: DataFrame, normalized: bool = False) -> None:
        """Sign a batch, decide its documents against all before it, append."""
        ids = docs.agg(F.count(F.lit(1)).alias("n"), F.min(self.cfg.id_col).alias("lo"), F.max(self.cfg.id_col).alias("hi")).first()
        if not ids.n:
            return
        last = self.commits().agg(F.max("last_id")).first()[0]
        if last is not None and ids.lo <= last:
            raise ValueError(f"batch ids start at {ids.lo}, but {last} is stored already")
        run, cfg = uuid.uuid4().hex[:12], self.cfg
        sigs = dd._reliable(dd.signatures(docs, cfg, preprocessed=normalized, with_length=True).withColumnRenamed(cfg.id_col, "doc_id"))
        members = dd._reliable(dd.bucket_members(sigs, dd.replace_id(cfg)))
        new = members.groupBy(*dd.BUCKET).agg(_best().alias("new"), F.count(F.lit(1)).alias("new_n"))
        old = dd._reliable(new.join(self.buckets(), dd.BUCKET, "left"))  # touched buckets alone, with what is stored of them
        live = F.coalesce(F.col("n"), F.lit(0)) + F.col("new_n") > 1

        m = dd.salted_join(members, old.where(live).select(*dd.BUCKET, "seed"), dd.BUCKET, "doc_id")
        covered = dd._reliable(m.where(F.col("seed").isNotNull()).select("doc_id").distinct())
        open_ = dd._reliable(m.join(covered, "doc_id", "left_anti").select("doc_id", *dd.BUCKET))
        seeds = dd.greedy_seeds(open_, materialized=True).where("is_seed").select("doc_id")
        alone = members.select("doc_id").distinct().join(m.select("doc_id").distinct(), "doc_id", "left_anti")
        heads = dd._reliable(seeds.withColumn("is_linked", F.lit(True)).unionByName(alone.withColumn("is_linked", F.lit(False))))

        # the seed of every touched bucket: the old one, or the new document that became one
        in_bucket = members.join(heads.select("doc_id"), "doc_id").groupBy(*dd.BUCKET).agg(F.max("doc_id").alias("new_seed"))
        state = dd._reliable(old.join(in_bucket, dd.BUCKET, "left").withColumn("head", F.coalesce("seed", "new_seed")))
        rows = state.select(*dd.BUCKET, F.col("new_seed").alias("seed"), F.col("new.len").alias("best_len"),
                            (-F.col("new.neg")).alias("best_id"), F.col("new_n").alias("n"))
        # a cluster is its seed and all members of the seed's buckets, old and new
        met = state.where(live & F.col("head").isNotNull())
        stored = F.struct(F.col("best_len").alias("len"), (-F.col("best_id")).alias("neg"))
        longest = met.groupBy(F.col("head").alias("cluster_id")).agg(
            F.max(F.greatest(F.col("new"), F.coalesce(F.when(F.col("best_id").isNotNull(), stored), F.col("new")))).alias("b"))
        clusters = longest.select("cluster_id", F.col("b.len").alias("best_len"), (-F.col("b.neg")).alias("best_id"))
        in_clusters = dd.salted_join(members, met.select(*dd.BUCKET), dd.BUCKET, "doc_id").select("doc_id")
        linked = in_clusters.unionByName(longest.select(F.col("cluster_id").alias("doc_id"))).distinct()

        self._append("signatures", sigs.select("doc_id", F.col("_len").cast("int").alias("len"), "sig"), run)
        self._append("buckets", rows, run)
        self._append("clusters", clusters, run)
        self._append("linked", linked, run)
        self._commit(run, ids.n, ids.lo, ids.hi)

    def _commit(self, run: str, n: int, lo: int, hi: int, mode: str = "append") -> None:
        c = self.cfg
        self.spark.createDataFrame([(run, n, lo, hi, c.bands, c.rows, c.num_perm, c.seed, self.file_buckets)], COMMITS) \
            .coalesce(1).write.mode(mode).parquet(f"{self.path}/commits")

    def dropped(self) -> DataFrame:
        """(doc_id) in a cluster and representative of none, over all batches."""
        reps = self.table("clusters").groupBy("cluster_id").agg(_best("best_len", "best_id").alias("b")) \
                   .select((-F.col("b.neg")).alias("doc_id")).distinct()
        return self.table("linked").distinct().join(reps, "doc_id", "left_anti")

    def kept(self, docs: DataFrame) -> DataFrame:
        """``docs`` (any of the indexed documents) without the dropped ones."""
        gone = self.dropped().withColumnRenamed("doc_id", self.cfg.id_col)
        return docs.join(gone, self.cfg.id_col, "left_anti")

    def compact(self) -> None:
        """Merge all committed runs into one: a row per bucket, cluster and
        document, and one sorted file per file bucket."""
        c = self.commits().agg(F.sum("docs").alias("n"), F.min("first_id").alias("lo"), F.max("last_id").alias("hi")).first()
        if not c.n:
            return
        run = uuid.uuid4().hex[:12]
        reps = self.table("clusters").groupBy("cluster_id").agg(_best("best_len", "best_id").alias("b"))
        whole = {"signatures": self.table("signatures"), "buckets": self.buckets(), "linked": self.table("linked").distinct(),
                 "clusters": reps.select("cluster_id", F.col("b.len").alias("best_len"), (-F.col("b.neg")).alias("best_id"))}
        for name, rows in whole.items():
            self._append(name, dd._reliable(rows), run)
        self._commit(run, c.n, c.lo, c.hi, mode="overwrite")
