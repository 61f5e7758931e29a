"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

DataFrame operations only.  The mix takes ``share`` of all words; sources, in
code-point order with null last, weigh ``weights`` in turn; a target above
``most`` times its source's size stops there and the excess is shared again by
weight until none is above.

Every source's rows fall by a seeded hash into ``BLOCKS`` blocks, so a block is
a random sample of its source.  A target is met by whole passes over the source
and, in a last pass, by the first blocks of a seeded order of its blocks; the
one block in which the quota ends is cut at a row hash, and the row there gives
its first words.  A source's taken words thus miss its target by less than one
word (by less than one word a copy where equal rows meet the cut).

The drawn blocks, an exact number of every source, are parted among the output
shards by a binary tree over the shards: a node with n drawn blocks gives its
left child exactly the left shards' part of n, drawn uniformly without
replacement by a seeded order, so the numbers of blocks a source sends to each
side are one draw of the multivariate hypergeometric distribution, and the
children share no block.  The leaves are the shards; a shard's records are
dealt to files and shuffled there (sorted by a seeded hash, which spills).

Scale: texts move once, to their shard.  All planning works on rows of a few
numbers: one table of (id, source, size, hash), partial aggregates over it, and
tables of at most BLOCKS rows a source.  No window holds more than RANGES rows
or one range of a block; ranks are taken range by range.  The block table is
broadcast up to BROADCAST_ROWS rows and joined by a shuffle beyond.  Equal rows
share a hash and so a block; nothing is gathered by block, and a shard deals
its records by hash and input split, so a large group of copies does not meet
in one task.  Every intermediate table is written to the shared folder.

Defined results: null text has no words; null sources are a source; null and
repeated ids and equal rows each get their row; rows without words are taken
with their block and count nothing; an empty table, or one without any word,
has targets and takings of 0; input columns named shard or pass are replaced,
all others are carried along into the shards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from winnow.llm.common import materialize
from winnow.session import scratch_path
from winnow.sources.io import with_ordinal

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
SHARDS, SEED = 16, 1913
BLOCKS = 256               # blocks of a source
RANGES = 4096              # ranges of a hash, by its top 12 bits
FILE_BYTES = 64 << 20      # texts of one written file, about
BROADCAST_ROWS = 1 << 18   # rows of the block table, about 60 bytes each, that are broadcast
WORD = r"[^\x20\x09-\x0D]+"  # fixed value: what a word is
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def range_of(key: Column) -> Column:
    return F.shiftright(key, 52).cast("int")


def source_key(source: Column) -> Column:
    """A string that sorts like the source by code points, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def before(total: str, part: list[str], order: list[str]) -> Column:
    """Sum of ``total`` over the preceding rows."""
    w = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(w), F.lit(0))


def first_ranked(rows: DataFrame, part: list[str], key: str, tie: list[str]) -> DataFrame:
    """``rows`` with _rank, the 0-based rank by (key, tie) within ``part``: counts
    per range of the key give every range its first rank, so no window holds a
    whole part."""
    rows = rows.withColumn("_range", range_of(F.col(key)))
    counts = rows.groupBy(*part, "_range").agg(F.count(F.lit(1)).alias("_n"))
    base = counts.select(*part, "_range", before("_n", part, ["_range"]).alias("_base"))
    inner = F.row_number().over(Window.partitionBy(*part, "_range").orderBy(key, *tie))
    return (rows.withColumn("_inner", inner).join(base, [*part, "_range"])
            .withColumn("_rank", F.col("_base") + F.col("_inner") - 1).drop("_range", "_base", "_inner"))


# -------------------------------------------------------------------- targets

def with_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``sources`` (_src, _size) with the double _target."""
    ranked = with_ordinal(sources, "_src", "_ord")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    out = materialize(ranked.select("_src", "_size", F.element_at(cycle, ((F.col("_ord") - 1) % len(weights) + 1).cast("int")).alias("_w"),
                                    (F.col("_size") * F.lit(float(most))).alias("_cap")), "mix-sources")
    total = out.agg(F.sum("_size")).first()[0] or 0
    rate, stopped = 0.0, -1
    while True:  # the set of stopped sources grows until none is above
        above = F.col("_w") * F.lit(rate) > F.col("_cap")
        r = out.agg(F.sum(F.when(above, F.col("_cap")).otherwise(0.0)).alias("cap"),
                    F.sum(F.when(above, 0.0).otherwise(F.col("_w"))).alias("w"), F.count_if(above).alias("n")).first()
        if r["n"] == stopped or not r["w"]:
            break
        rate, stopped = max(0.0, share * total - r["cap"]) / r["w"], r["n"]
    return out.select("_src", "_size", F.least(F.col("_w") * F.lit(rate), F.col("_cap")).alias("_target"))


# ------------------------------------------------------------------ the draws

def quota_cuts(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """(_src, _block, _cut, _part) of the blocks in which a quota of _take words
    ends: rows with a hash below _cut are taken, those at it with _part of
    their words.  Range by range, then row by row in the range that holds the
    end."""
    ending = blocks.where((F.col("_take") > 0) & (F.col("_take") < F.col("_words"))).select("_src", "_block", "_take")
    inside = rows.join(ending, ["_src", "_block"]).withColumn("_range", range_of(F.col("_h")))
    place = ["_src", "_block", "_take"]

    def crossing(sums: DataFrame, part: list[str], order: str) -> DataFrame:
        s = sums.withColumn("_before", before("_sum", part, [order]))
        return s.where((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_sum")))

    ranges = crossing(inside.groupBy(*place, "_range").agg(F.sum("size").alias("_sum")), place, "_range")
    ranges = ranges.select("_src", "_block", "_range", (F.col("_take") - F.col("_before")).alias("_take"))
    last = inside.drop("_take").join(ranges, ["_src", "_block", "_range"])
    ends = crossing(last.groupBy(*place, "_h").agg(F.sum("size").alias("_sum")), place, "_h")
    return ends.select("_src", "_block", F.col("_h").alias("_cut"), ((F.col("_take") - F.col("_before")) / F.col("_sum")).alias("_part"))


def split_tree(drawn: DataFrame, shards: int, seed: int) -> DataFrame:
    """``drawn`` blocks (_src, _block, _pass) with the shard of each: level by
    level, a node's left child gets its exact number of the node's blocks in a
    fresh seeded order."""
    tie = ["_src", "_block", "_pass"]
    total = drawn.count()
    at = drawn.select(*tie, F.lit(0).alias("_lo"), F.lit(shards).alias("_hi"))
    level, width = 0, shards
    leaf = lambda shard: F.floor(shard.cast("bigint") * F.lit(total) / F.lit(shards))
    while width > 1:  # the widest node; a node of one shard is a leaf already and keeps all it has
        at = at.withColumn("_mid", F.floor((F.col("_lo") + F.col("_hi") + 1) / 2).cast("int"))
        key = F.xxhash64(F.lit(seed), F.lit(level), *tie)
        left = F.col("_rank") < leaf(F.col("_mid")) - leaf(F.col("_lo"))
        ranked = first_ranked(at.withColumn("_key", key), ["_lo", "_hi", "_mid"], "_key", tie)
        at = materialize(ranked.select(*tie, F.when(left, F.col("_lo")).otherwise(F.col("_mid")).alias("_lo"),
                                       F.when(left, F.col("_mid")).otherwise(F.col("_hi")).alias("_hi")), f"mix-level{level}")
        level, width = level + 1, (width + 1) // 2
    return at.select(*tie, F.col("_lo").alias("_shard"))


# ------------------------------------------------------------------- operator

@dataclass
class Mix:
    ledger: DataFrame   # one row per input row: doc_id, size, source_size, target, taken
    quotas: DataFrame   # (source, shard, blocks): the tree's leaves
    shards: DataFrame   # the written shards, read back


def _keyed(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    h = F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), F.col(text_col))
    return docs.withColumns({"_src": source_key(F.col(source_col)), "_h": h}).withColumn("_block", F.pmod("_h", F.lit(BLOCKS)).cast("int"))


def plan(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, weights=WEIGHTS, share: float = SHARE, most: int = MOST,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame, int]:
    """(rows, blocks, bytes): the narrow table of all rows, the table that says
    what is taken from every block and where it goes, and the bytes of all texts."""
    narrow = _keyed(docs.select(F.col(id_col), F.col(text_col), F.col(source_col)), seed, id_col, text_col, source_col).select(
        F.col(id_col).alias("doc_id"), "_src", "_block", "_h",
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint").alias("_bytes"))
    rows = materialize(narrow, "mix-rows")
    blocks = materialize(rows.groupBy("_src", "_block").agg(F.sum("size").alias("_words"), F.sum("_bytes").alias("_bytes")), "mix-blocks")
    sources = with_targets(blocks.groupBy("_src").agg(F.sum("_words").alias("_size")), weights, share, most)
    passes = F.when(F.col("_size") > 0, F.floor(F.col("_target") / F.col("_size"))).otherwise(0).cast("int")
    sources = sources.withColumn("_passes", passes).withColumn(
        "_rest", F.round(F.col("_target") - F.col("_passes") * F.col("_size")).cast("bigint"))
    # the last pass takes blocks in a seeded order; at most BLOCKS rows a source
    blocks = blocks.join(sources, "_src").withColumn("_key", F.xxhash64(F.lit(seed), F.lit("order"), "_src", "_block"))
    left = F.col("_rest") - before("_words", ["_src"], ["_key", "_block"])
    blocks = materialize(blocks.withColumn("_take", F.least("_words", F.greatest(left, F.lit(0)))), "mix-takes")
    copies = F.col("_passes") + (F.col("_take") > 0).cast("int")
    drawn = blocks.where(copies > 0).select("_src", "_block", F.explode(F.sequence(F.lit(0), copies - 1)).alias("_pass"))
    at = split_tree(materialize(drawn, "mix-drawn"), shards, seed)
    at = at.groupBy("_src", "_block").agg(F.sort_array(F.collect_list(F.struct("_pass", "_shard"))).alias("_at"))  # at most most + 1
    cut = F.when(F.col("_take") <= 0, F.lit(LOWEST)).when(F.col("_take") >= F.col("_words"), F.lit(HIGHEST)).otherwise(F.col("_cut"))
    full = (blocks.join(quota_cuts(rows, blocks), ["_src", "_block"], "left").join(at, ["_src", "_block"], "left")
            .select("_src", "_block", "_size", "_target", "_passes", cut.alias("_cut"),
                    F.coalesce("_part", F.lit(0.0)).alias("_part"), "_at", "_bytes"))
    full = materialize(full, "mix-plan")
    r = full.agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("b")).first()
    return rows, F.broadcast(full.drop("_bytes")) if r["n"] <= BROADCAST_ROWS else full.drop("_bytes"), r["b"] or 0


def mix(docs: DataFrame, path: str | None = None, shards: int = SHARDS, seed: int = SEED, weights=WEIGHTS,
        share: float = SHARE, most: int = MOST, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """Write the mix, one folder of Parquet files per shard with the columns of
    ``docs`` and the pass, and return its ledger, quotas and shards."""
    docs = docs.drop("shard", "pass")
    path = path or scratch_path(docs.sparkSession, "mix")
    rows, blocks, size = plan(docs, shards, seed, weights, share, most, id_col, text_col, source_col)
    last = F.when(F.col("_h") < F.col("_cut"), F.col("size")).when(
        F.col("_h") == F.col("_cut"), F.floor(F.col("size") * F.col("_part"))).otherwise(0)
    ledger = rows.join(blocks, ["_src", "_block"]).select(
        "doc_id", "size", F.col("_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("size") * F.col("_passes") + last).cast("bigint").alias("taken"))

    cols = [F.col(f"`{c}`") for c in docs.columns]
    pieces = (_keyed(docs, seed, id_col, text_col, source_col).join(blocks, ["_src", "_block"])
              .select("*", F.explode("_at").alias("_x"))
              .where((F.col("_x._pass") < F.col("_passes")) | (F.col("_h") <= F.col("_cut"))))
    words = F.regexp_extract_all(F.col(text_col), F.lit(WORD), 0)
    cut = (F.col("_x._pass") >= F.col("_passes")) & (F.col("_h") == F.col("_cut"))
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.floor(F.size(words) * F.col("_part")).cast("int")), " ")).otherwise(F.col(text_col))
    files = max(1, int(-(-size * share // (shards * FILE_BYTES))))
    # equal rows have equal hashes; the input split tells them apart, the same way when a task is run again
    file = F.pmod(F.xxhash64("_h", "_x._pass", F.spark_partition_id()), F.lit(files)).cast("int")
    records = pieces.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
                            F.col("_x._pass").alias("pass"), F.col("_x._shard").alias("shard"), file.alias("_file"),
                            F.xxhash64(F.lit(seed), F.lit("shuffle"), "_h", "_x._pass").alias("_order"))
    records = (records.repartitionById(shards * files, F.col("shard") * files + F.col("_file"))
               .sortWithinPartitions("_order").select(*cols, "pass", "shard"))
    records.write.mode("overwrite").option("compression", "zstd").partitionBy("shard").parquet(path)
    source = F.when(F.col("_src") != "1", F.expr("substring(_src, 2)"))
    quotas = blocks.select(source.alias("source"), F.explode("_at._shard").alias("shard")).groupBy("source", "shard").agg(
        F.count(F.lit(1)).alias("blocks"))
    return Mix(ledger, quotas, docs.sparkSession.read.schema(records.schema).parquet(path))
