"""Near-duplicate removal: shingles -> MinHash -> LSH buckets -> greedy
clusters -> representatives -> kept / removed documents.

Scale notes
-----------
* Shingling and signatures are per-row expressions: no shuffle until the
  bucket aggregation.
* Candidate pairs are never materialised.  Two documents are candidates when
  they share an LSH bucket, so every graph step is written against the
  (doc, bucket) membership table: per-bucket aggregates joined back to
  members, then per-doc aggregates.  Work per round is O(memberships), even
  when one bucket holds a third of the corpus (a k-member bucket would give
  k^2/2 pairs).  Hot buckets meet partial aggregation (map-side combine)
  and joins salted by document (``salted_join``).
* Iterative loops (greedy seeds, connected groups) cut lineage every round
  with reliable ``checkpoint()`` into the session's checkpoint folder, work on
  what is still undecided alone, and stop when nothing is left.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions import minhash as mh
from winnow.functions import text as tx
from winnow.operators.partitioning import spread
from winnow.session import checkpoint_dir

BUCKET = ["band", "k1", "k2"]


@dataclass(frozen=True)
class DedupConfig:
    threshold: float = 0.8
    num_perm: int = mh.NUM_PERM
    ngram_size: int = 5
    jamo_ngram_size: int = 3
    bands: int = mh.DEFAULT_BANDS
    rows: int = mh.DEFAULT_ROWS
    seed: int = mh.PERM_SEED
    min_chars: int = 10
    min_grams: int = 5
    id_col: str = "doc_id"
    text_col: str = "text"
    scope_col: str | None = None  # e.g. a chunk number: buckets never cross scopes


def config_for(threshold: float = 0.8, num_perm: int = mh.NUM_PERM, **kw) -> DedupConfig:
    """Config whose banding is the FP/FN optimum for ``threshold``."""
    b, r = mh.optimal_bands(threshold, num_perm, steps=200)
    return DedupConfig(threshold=threshold, num_perm=num_perm, bands=b, rows=r, **kw)


DEFAULT = DedupConfig()


def replace_id(cfg: DedupConfig, id_col: str = "doc_id") -> DedupConfig:
    """``cfg`` for a table whose id column has been renamed."""
    return replace(cfg, id_col=id_col)


# --------------------------------------------------------------------------
# shingles and signatures (narrow, per row)
# --------------------------------------------------------------------------

def _gated(docs: DataFrame, cfg: DedupConfig, preprocessed: bool, with_length: bool) -> tuple[DataFrame, list[str]]:
    """(id, [scope], [_len], _t) of documents that pass the two gates:
    preprocessed text ``_t`` of at least ``min_chars`` characters and at least
    ``min_grams`` word+jamo grams (counted before set semantics).
    Skipped documents are never duplicates."""
    text = F.col(cfg.text_col) if preprocessed else tx.preprocess(F.coalesce(F.col(cfg.text_col), F.lit("")))
    keep = [cfg.id_col] + ([cfg.scope_col] if cfg.scope_col else [])
    if with_length:
        docs = docs.withColumn("_len", doc_length("tokens", cfg.text_col, docs.columns))
        keep = keep + ["_len"]
    d = spread(docs).select(*keep, text.alias("_t")).where(F.length("_t") >= cfg.min_chars)
    # Gate 2 (word + jamo grams >= min_grams) is implied by gate 1 whenever a
    # text of min_chars characters already yields enough jamo grams; only
    # otherwise is it evaluated, from gram counts (no arrays are built twice).
    if cfg.min_chars - cfg.jamo_ngram_size + 1 < cfg.min_grams:
        ntok = F.size(F.split("_t", " "))
        n_w = F.greatest(ntok - cfg.ngram_size + 1, F.lit(1))
        n_j = F.greatest(F.length(tx.hangul_to_jamo(F.col("_t"))) - cfg.jamo_ngram_size + 1, F.lit(1))
        d = d.where(n_w + n_j >= cfg.min_grams)
    return d, keep


def shingle_sets(docs: DataFrame, cfg: DedupConfig = DEFAULT, preprocessed: bool = False,
                 with_length: bool = False) -> DataFrame:
    """(id, [scope], shingles) for documents that pass the gates."""
    d, keep = _gated(docs, cfg, preprocessed, with_length)
    grams = F.concat(tx.word_ngrams("_t", cfg.ngram_size), tx.jamo_ngrams("_t", cfg.jamo_ngram_size))
    return d.select(*keep, F.array_distinct(grams).alias("shingles"))


def shingle_totals(docs: DataFrame, cfg: DedupConfig = DEFAULT, preprocessed: bool = False) -> DataFrame:
    """(id, [scope], totals struct<n, hash_sum>) of every document's shingle set."""
    d, keep = _gated(docs, cfg, preprocessed, False)
    return d.select(*keep, mh.text_totals(F.col("_t"), cfg.ngram_size, cfg.jamo_ngram_size).alias("totals"))


def shingle_elements(docs: DataFrame, cfg: DedupConfig = DEFAULT, preprocessed: bool = False,
                     run=None, schema: str = "") -> DataFrame:
    """(id, [scope], shingles): the shingle sets as 64-bit hashes.  With ``run``:
    the rows (``schema``) of the record batches that it makes, in a task, of the
    pairs (ids, sets) of its slices; no set leaves the task."""
    d, keep = _gated(docs, cfg, preprocessed, False)
    sizes = cfg.ngram_size, cfg.jamo_ngram_size
    if run is None:
        return d.select(*keep, mh.text_elements(F.col("_t"), *sizes).alias("shingles"))

    made = mh.text_element_slices  # the function alone goes to the tasks

    def slices(batches):
        for b in batches:
            for lo, sets in made(b.column(1), b.column(2), *sizes):
                yield b.column(0).slice(lo, len(sets)), sets

    # preprocessing leaves single spaces alone, and lower case adds none
    low = mh.lowered(F.col("_t")) if preprocessed else F.lower("_t")
    return d.select(cfg.id_col, "_t", low).mapInArrow(lambda batches: run(slices(batches)), schema)


def signatures(docs: DataFrame, cfg: DedupConfig = DEFAULT, preprocessed: bool = False,
               with_length: bool = False) -> DataFrame:
    """(id, [scope], [_len], sig array<bigint>) for every indexed document."""
    d, keep = _gated(docs, cfg, preprocessed, with_length)
    return d.select(*keep, mh.text_signature(F.col("_t"), cfg.ngram_size, cfg.jamo_ngram_size, cfg.num_perm, cfg.seed).alias("sig"))


def bucket_members(sigs: DataFrame, cfg: DedupConfig = DEFAULT) -> DataFrame:
    """(id, band, k1, k2): one row per document and band (the LSH index).
    With a scope column the scope is folded into the bucket key."""
    keys = mh.band_keys("sig", cfg.bands, cfg.rows)
    extra = [c for c in sigs.columns if c == "_len"]
    m = sigs.select(cfg.id_col, *([cfg.scope_col] if cfg.scope_col else []), *extra, F.explode(keys).alias("b"))
    k1 = F.col("b.k1")
    if cfg.scope_col:
        k1 = F.xxhash64(F.col(cfg.scope_col), k1)
    return m.select(F.col(cfg.id_col).alias("doc_id"), F.col("b.band").alias("band"), k1.alias("k1"), F.col("b.k2").alias("k2"),
                    *extra)


SALTS = 16  # pieces a hot bucket or label is cut into


def salted_join(rows: DataFrame, keyed: DataFrame, keys: list[str], spread_by: str) -> DataFrame:
    """Inner join of many ``rows`` with ``keyed``, which has one row per key: the
    rows of a key are dealt to SALTS tasks by a hash of ``spread_by`` and the
    key's one row is sent to each, so a hot key does not meet in one task.  (The
    engine's own skew rule cannot split such a join: the keyed side is an
    aggregate on the same key.)"""
    many = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    one = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.join(one, [*keys, "_salt"]).drop("_salt")


def linked_members(members: DataFrame) -> DataFrame:
    """Memberships of buckets that hold at least two documents, with the
    bucket's size and first (smallest) document id.  Per-bucket statistics
    come from a partially aggregated groupBy; the join back to the members is
    salted, so a hot bucket is spread over tasks."""
    stats = (members.groupBy(*BUCKET)
             .agg(F.count(F.lit(1)).alias("bucket_size"), F.min("doc_id").alias("bucket_first"))
             .where(F.col("bucket_size") >= 2))
    return salted_join(members, stats, BUCKET, "doc_id")


def _reliable(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# --------------------------------------------------------------------------
# greedy one-hop clustering (lexicographically-first maximal independent set)
# --------------------------------------------------------------------------

def greedy_seeds(linked: DataFrame, max_rounds: int | None = None, materialized: bool = False,
                 trace: list[int] | None = None) -> DataFrame:
    """(doc_id, is_seed) for every document with at least one candidate.

    Visiting documents in id order, an unprocessed document becomes a seed
    and takes all of its candidates as its cluster.  Equivalently: a doc is
    a seed iff no smaller seed shares a bucket with it.  Delta iteration over
    the memberships of undecided documents alone:
      * a document that is the smallest undecided one of all its buckets
        becomes a seed;
      * every other undecided document in a bucket of a new seed becomes a
        non-seed (the new seed is the smallest of such a bucket).
    What a round settles is written once and never touched again; the next
    round's memberships are those of the documents still undecided, so the
    rows written fall from round to round (``trace`` receives them).
    ``materialized``: ``linked`` is already a checkpoint, do not write it again."""
    m = linked.select("doc_id", *BUCKET)
    m = m if materialized else _reliable(m)
    settled: list[DataFrame] = []
    rounds = 0
    while not m.isEmpty():
        if max_rounds is not None and rounds >= max_rounds:
            raise RuntimeError(f"greedy_seeds did not converge in {max_rounds} rounds")
        firsts = m.groupBy(*BUCKET).agg(F.min("doc_id").alias("first"))
        x = salted_join(m, firsts, BUCKET, "doc_id")
        seeds = x.groupBy("doc_id").agg(F.min(F.col("first") == F.col("doc_id")).alias("is_seed")).where("is_seed")
        near = salted_join(x.where(F.col("first") != F.col("doc_id")), seeds.select(F.col("doc_id").alias("first")), ["first"], "doc_id")
        now = _reliable(seeds.unionByName(near.select("doc_id", F.lit(False).alias("is_seed")).distinct()))
        settled.append(now)
        rounds += 1
        m = _reliable(m.join(now.select("doc_id"), "doc_id", "left_anti"))
        if trace is not None:
            trace.append(m.count() + now.count())
    logging.getLogger(__name__).info("greedy seeds: %d rounds", rounds)
    out = linked.select("doc_id", F.lit(False).alias("is_seed")).limit(0)
    for part in settled:
        out = out.unionByName(part)
    return out


def cluster_members(linked: DataFrame, seeds: DataFrame) -> DataFrame:
    """(cluster_id, doc_id): cluster of seed s = s plus every doc sharing a
    bucket with s.  Each bucket holds at most one seed, so the output is at
    most one row per membership (before the distinct)."""
    m = linked.select("doc_id", *BUCKET)
    seed_buckets = (m.join(seeds.where("is_seed").select("doc_id"), "doc_id")
                    .select(F.col("doc_id").alias("cluster_id"), *BUCKET))
    return seed_buckets.join(m, BUCKET).select("cluster_id", "doc_id").distinct()


# --------------------------------------------------------------------------
# representatives
# --------------------------------------------------------------------------

def doc_length(tokens_col: str | None = "tokens", text_col: str = "text", cols: list[str] | None = None) -> Column:
    """Token count when a token list is present, else character count."""
    txt = F.coalesce(F.length(F.col(text_col)), F.lit(0))
    if tokens_col and cols is not None and tokens_col in cols:
        return F.when(F.col(tokens_col).isNotNull(), F.size(F.col(tokens_col))).otherwise(txt)
    return txt


def pick(members: DataFrame, score: Column, score_name: str = "_score") -> DataFrame:
    """(cluster_id, rep_id): member with the highest score, ties to the
    smallest doc_id.  ``max(struct(score, -id))`` keeps it a partial
    aggregate, so a huge cluster never lands whole in one task."""
    best = (members.withColumn(score_name, score)
            .groupBy("cluster_id")
            .agg(F.max(F.struct(F.col(score_name), (-F.col("doc_id")).alias("neg"))).alias("b")))
    return best.select("cluster_id", (-F.col("b.neg")).alias("rep_id"))


def representatives(members: DataFrame, docs: DataFrame, strategy: str = "longest",
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(cluster_id, rep_id) by strategy: longest | newest | highest_quality.
    Unknown strategies fall back to longest."""
    from winnow.functions import scoring

    if strategy not in ("longest", "newest", "highest_quality"):
        logging.getLogger(__name__).warning("Unknown strategy %s, using 'longest'", strategy)
    cols = docs.columns
    d = docs.withColumnRenamed(id_col, "doc_id") if id_col != "doc_id" else docs
    length = doc_length("tokens", text_col, cols).alias("_len")
    if strategy == "newest" and "timestamp" in cols:
        ts = scoring.parse_timestamp_col(docs, "timestamp").alias("_ts")
        feat = d.select("doc_id", length, ts)
        # one ordering covers both cases: members with a valid time beat those
        # without (newest first, ties to the smallest id); in a cluster with
        # no valid time at all, the length decides
        has = F.col("_ts").isNotNull()
        score = F.struct(has.alias("v"), F.col("_ts").alias("t"),
                         F.when(has, F.lit(0)).otherwise(F.col("_len")).alias("l"))
        return pick(members.join(feat, "doc_id"), score)
    if strategy == "highest_quality":
        feat = d.select("doc_id", scoring.quality_score(docs.dtypes, text_col).alias("_q"))
        return pick(members.join(feat, "doc_id"), F.col("_q"))
    feat = d.select("doc_id", length)
    return pick(members.join(feat, "doc_id"), F.col("_len"))


# --------------------------------------------------------------------------
# end-to-end removal
# --------------------------------------------------------------------------

@dataclass
class DedupResult:
    kept: DataFrame
    removed: DataFrame
    members: DataFrame      # (cluster_id, doc_id)
    reps: DataFrame         # (cluster_id, rep_id)
    linked: DataFrame       # (doc_id, band, k1, k2, bucket_size, bucket_first)
    seeds: DataFrame        # (doc_id, is_seed)
    extra: dict = field(default_factory=dict)


def deduplicate(docs: DataFrame, cfg: DedupConfig = DEFAULT, strategy: str = "longest",
                normalized: bool = True) -> DedupResult:
    """Keep a document if it is in no cluster or represents any cluster.

    ``docs`` must carry ``doc_id`` and ``text``; with ``normalized`` the text
    is already preprocessed (as after ``normalize_docs``) and is shingled
    as is, otherwise it is preprocessed for shingling only."""
    docs = spread(docs)
    longest = strategy not in ("newest", "highest_quality")
    # The length used by "longest" rides along with the signature pass into
    # the checkpointed bucket table, so picking representatives never
    # re-reads (or re-normalizes) the corpus.
    sigs = signatures(docs, cfg, preprocessed=normalized, with_length=longest)
    # The membership table is read twice (bucket sizes, then the join back),
    # so it is materialised once: ~9 narrow rows per document, far cheaper
    # than running the text pipeline a second time.
    members_all = _reliable(bucket_members(sigs, cfg))
    linked = _reliable(linked_members(members_all))
    seeds = greedy_seeds(linked, materialized=True)
    members = _reliable(cluster_members(linked, seeds))
    if longest:
        lens = linked.select("doc_id", "_len").distinct()
        reps = pick(members.join(lens, "doc_id"), F.col("_len"))
    else:
        reps = representatives(members, docs, strategy, cfg.id_col, cfg.text_col)
    rep_ids = reps.select(F.col("rep_id").alias("doc_id")).distinct()
    drop = _reliable(members.select("doc_id").distinct().join(rep_ids, "doc_id", "left_anti"))
    idc = cfg.id_col
    kept = docs.join(drop.withColumnRenamed("doc_id", idc), idc, "left_anti")
    removed = docs.join(drop.withColumnRenamed("doc_id", idc), idc, "left_semi")
    return DedupResult(kept, removed, members, reps, linked, seeds, {"dropped_ids": drop})


def dedup_stats(docs: DataFrame, res: DedupResult) -> DataFrame:
    """original, kept, removed, clusters, rate (0 on an empty corpus).
    One union of tagged rows and a single global aggregate."""
    # removed ids are a subset of the input, so kept = original - removed:
    # one count of the input plus counts of two small tables, no anti-join
    tag = lambda df, o, r, c: df.select(F.lit(o).alias("o"), F.lit(r).alias("r"), c.cast("bigint").alias("c"))
    dropped = res.extra.get("dropped_ids", res.removed.select("doc_id"))
    u = (tag(docs, 1, 0, F.lit(None))
         .unionByName(tag(dropped, 0, 1, F.lit(None)))
         .unionByName(tag(res.members.select("cluster_id").distinct(), 0, 0, F.col("cluster_id"))))
    a = u.agg(F.sum("o").alias("original_count"), F.sum("r").alias("_removed"),
              F.count("c").alias("duplicate_clusters")).select(
        "original_count", (F.col("original_count") - F.coalesce(F.col("_removed"), F.lit(0))).alias("deduplicated_count"),
        "duplicate_clusters")
    return a.select(
        F.coalesce(F.col("original_count"), F.lit(0)).alias("original_count"),
        F.coalesce(F.col("deduplicated_count"), F.lit(0)).alias("deduplicated_count"),
        F.coalesce(F.col("original_count") - F.col("deduplicated_count"), F.lit(0)).alias("removed_count"),
        "duplicate_clusters",
        F.when(F.col("original_count") > 0,
               F.round((F.col("original_count") - F.col("deduplicated_count")) / F.col("original_count"), 6))
         .otherwise(F.lit(0.0)).alias("deduplication_rate"))


def cluster_stats(members: DataFrame) -> DataFrame:
    """count, docs, avg/max/min size and the size histogram; empty -> no row."""
    sizes = members.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    agg = sizes.agg(
        F.count(F.lit(1)).alias("total_clusters"),
        F.sum("n").alias("total_documents_in_clusters"),
        F.round(F.avg("n"), 6).alias("avg_cluster_size"),
        F.max("n").alias("max_cluster_size"),
        F.min("n").alias("min_cluster_size"),
        F.count_if(F.col("n") == 2).alias("size_2"),
        F.count_if(F.col("n").between(3, 5)).alias("size_3_5"),
        F.count_if(F.col("n").between(6, 10)).alias("size_6_10"),
        F.count_if(F.col("n") > 10).alias("size_10_plus"))
    return agg.where(F.col("total_clusters") > 0)


# --------------------------------------------------------------------------
# connected groups (documented policy: mutually connected docs form a group)
# --------------------------------------------------------------------------

def connected_groups(linked: DataFrame, materialized: bool = False, trace: list[int] | None = None) -> DataFrame:
    """(doc_id, group_id = smallest doc id of its connected component) over
    the doc-bucket graph, by contraction.

    A bucket's edges are the star around its first document.  In a round every
    node picks the first node of its closed neighbourhood -- by id in the first
    round, which folds the buckets at once, then by a seeded hash, which folds
    any graph by a constant share on average -- and the edges are rewritten to
    the picked nodes; loops and repeats go, so the edge table shrinks from round
    to round (``trace`` receives its rows) and folded nodes are never read
    again.  The rounds' choices are then followed backwards."""
    m = linked.select("doc_id", *BUCKET)
    m = m if materialized else _reliable(m)
    firsts = m.groupBy(*BUCKET).agg(F.min("doc_id").alias("a"))
    edges = _reliable(salted_join(m, firsts, BUCKET, "doc_id").where(F.col("a") != F.col("doc_id"))
                      .select("a", F.col("doc_id").alias("b")).distinct())
    picks: list[DataFrame] = []
    while not edges.isEmpty():
        if trace is not None:
            trace.append(edges.count())
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        key = [F.xxhash64(F.lit(len(picks)), c) if picks else F.col(c) for c in ("a", "b")]
        best = both.groupBy("a").agg(F.min(F.struct(key[1].alias("k"), "b")).alias("n"))
        own = F.struct(key[0].alias("k"), F.col("a").alias("b"))
        pick = _reliable(best.select("a", F.least("n", own)["b"].alias("to")))
        picks.append(pick)
        one = salted_join(edges, pick, ["a"], "b").select(F.col("to").alias("x"), "b")
        two = salted_join(one, pick.withColumnRenamed("a", "b"), ["b"], "x").select("x", F.col("to").alias("y"))
        edges = _reliable(two.where(F.col("x") != F.col("y"))
                          .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if not picks:
        return m.select("doc_id", F.col("doc_id").alias("group_id")).distinct()
    root = picks[-1]
    for pick in reversed(picks[:-1]):  # what a node picked, and what that node came to
        ahead = root.select(F.col("a").alias("to"), F.col("to").alias("end"))
        hit = pick.select("to").distinct().join(ahead, "to", "left").select("to", F.coalesce("end", "to").alias("end"))
        root = _reliable(salted_join(pick, hit, ["to"], "a").select("a", F.col("end").alias("to")))
    least = root.groupBy("to").agg(F.min("a").alias("group_id"))
    return salted_join(root, least, ["to"], "a").select(F.col("a").alias("doc_id"), "group_id")


def normalize_docs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """NFKC + whitespace collapse of the text (null when empty or missing);
    every other string column stripped; non-strings untouched."""
    out = []
    for f in docs.schema.fields:
        c = F.col(f.name)
        if f.name == text_col:
            c = F.when(c.isNull() | (c == ""), F.lit(None).cast("string")).otherwise(tx.preprocess(c))
        elif f.dataType.simpleString() == "string":
            c = tx.strip_ws(c)
        out.append(c.alias(f.name))
    return spread(docs).select(*out)
