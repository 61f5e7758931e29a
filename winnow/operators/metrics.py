"""Text-generation metrics over a (pair_id, reference, prediction) table.

BLEU and ROUGE-1/2 are n-gram count joins: grams of both sides are exploded
per pair, counted per (pair, n, gram) -- each pair's grams come from one row,
so the partial aggregate collapses them before the shuffle -- clipped with
``least`` and summed.  ROUGE-L needs an LCS per pair: a small bit-parallel
Arrow UDF helper.  Greedy embedding matching multiplies tiles of the two sides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from winnow.functions import text as tx
from winnow.operators.partitioning import range_parts, spread
from winnow.session import checkpoint_dir

MAX_ORDER = 4
# The public "13a" BLEU tokenizer -- entity unescapes, then
# regex rules applied in order (pattern, replacement).
BLEU_UNESCAPE = [("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
BLEU_RULES = [
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
]
# Fixed value: the ROUGE tokenizer keeps lower-case ASCII letters and digits.
ROUGE_KEEP = "[^a-z0-9]+"


def align_pairs(references: DataFrame, predictions: DataFrame, key: str = "pair_id") -> DataFrame:
    """(key, reference, prediction): full outer join of the two sides; any
    key present on one side only raises (the count check of the metrics)."""
    ok = F.col("_r").isNotNull() & F.col("_p").isNotNull()
    j = references.select(key, "reference", F.lit(True).alias("_r")).join(
        predictions.select(key, "prediction", F.lit(True).alias("_p")), key, "full_outer")
    return j.select(key, F.when(ok, F.col("reference")).otherwise(
        F.raise_error(F.lit("Reference and prediction counts do not match"))).alias("reference"), "prediction")


def bleu_tokenize(c: Column) -> Column:
    s = F.replace(c, F.lit("<skipped>"), F.lit(""))
    s = F.replace(s, F.lit("-\n"), F.lit(""))
    s = F.replace(s, F.lit("\n"), F.lit(" "))
    for a, b in BLEU_UNESCAPE:
        s = F.replace(s, F.lit(a), F.lit(b))
    s = F.concat(F.lit(" "), s, F.lit(" "))
    for pat, rep in BLEU_RULES:
        s = F.regexp_replace(s, pat, rep)
    return tx.collapse_ws(s)


def rouge_tokenize(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), ROUGE_KEEP, " "))


def _ngrams(tok: Column, n: int) -> Column:
    """n-grams of a single-space token string ('' -> none)."""
    pat = f"(?<![^ ])(?=([^ ]+(?: [^ ]+){{{n - 1}}}))"
    return F.when(tok == "", F.array().cast("array<string>")).otherwise(F.regexp_extract_all(tok, F.lit(pat), F.lit(1)))


def _ntok(tok: Column) -> Column:
    return F.when(tok == "", F.lit(0)).otherwise(F.size(F.split(tok, " ")))


def ngram_overlap(pairs: DataFrame, hyp: Column, ref: Column, orders) -> DataFrame:
    """(pair_id, n, matches, hyp_total, ref_total): clipped n-gram matches.

    The pair texts are hash-partitioned by pair_id once; every gram of a
    pair then lives in its partition, so both count aggregations (keyed by
    pair_id plus more) run without another exchange -- the shuffle moves the
    texts, never the several-times-larger exploded grams."""
    # explicit count (>= input splits, >= cores): AQE must not fold the CPU-heavy
    # per-pair work into a few partitions just because the texts are small
    base = pairs.repartition(range_parts(pairs), "pair_id").select("pair_id", hyp.alias("_h"), ref.alias("_r"))
    sides = []
    for n in orders:
        for side, col in (("h", "_h"), ("r", "_r")):
            sides.append(F.struct(F.lit(n).alias("n"), F.lit(side).alias("side"), _ngrams(F.col(col), n).alias("g")))
    e = base.select("pair_id", F.explode(F.array(*sides)).alias("s")) \
            .select("pair_id", "s.n", "s.side", F.explode_outer("s.g").alias("gram"))
    cnt = e.groupBy("pair_id", "n", "gram").agg(F.count_if(F.col("side") == "h").alias("ch"),
                                                 F.count_if(F.col("side") == "r").alias("cr"))
    return cnt.groupBy("pair_id", "n").agg(
        F.sum(F.when(F.col("gram").isNotNull(), F.least("ch", "cr")).otherwise(0)).alias("matches"),
        F.sum(F.when(F.col("gram").isNotNull(), F.col("ch")).otherwise(0)).alias("hyp_total"),
        F.sum(F.when(F.col("gram").isNotNull(), F.col("cr")).otherwise(0)).alias("ref_total"))


def bleu_corpus(pairs: DataFrame, hyp_col: str = "prediction", ref_col: str = "reference") -> DataFrame:
    """Corpus BLEU (13a tokens, one reference, exponential smoothing): one
    row with bleu, brevity penalty, lengths and the four precisions."""
    p = pairs.where(F.col(ref_col).isNotNull() & F.col(hyp_col).isNotNull())
    h = bleu_tokenize(F.col(hyp_col))
    r = bleu_tokenize(F.col(ref_col))
    ov = ngram_overlap(p, h, r, range(1, MAX_ORDER + 1))
    # corpus lengths are the unigram totals of the same aggregate (no second
    # tokenization pass): sum of hypothesis / reference 1-grams
    row = ov.agg(*[F.coalesce(F.sum(F.when(F.col("n") == k, F.col(c))), F.lit(0)).alias(f"{a}{k}")
                   for k in range(1, MAX_ORDER + 1) for c, a in (("matches", "m"), ("hyp_total", "t"))],
                 F.coalesce(F.sum(F.when(F.col("n") == 1, F.col("ref_total"))), F.lit(0)).alias("_ref_len"))
    sys_len, ref_len = F.col("t1"), F.col("_ref_len")
    # exponential smoothing: the k-th zero-match order gets 100 / (2^k * total);
    # an order with no n-grams at all ends the product (precision 0).
    precs, zeros, stop = [], F.lit(0), F.lit(False)
    for k in range(1, MAX_ORDER + 1):
        m, t = F.col(f"m{k}"), F.col(f"t{k}")
        stop = stop | (t == 0)
        zeros = zeros + F.when(~stop & (m == 0), 1).otherwise(0)
        precs.append(F.when(stop, F.lit(0.0))
                     .when(m == 0, 100.0 / (F.pow(F.lit(2.0), zeros) * t))
                     .otherwise(100.0 * m / t))
    row = row.select(*[pk.alias(f"p{i + 1}") for i, pk in enumerate(precs)],
                     sys_len.alias("sys_len"), ref_len.alias("ref_len"))
    bp = (F.when(F.col("sys_len") == 0, F.lit(0.0))
          .when(F.col("sys_len") >= F.col("ref_len"), F.lit(1.0))
          .otherwise(F.exp(1 - F.col("ref_len") / F.col("sys_len"))))
    mean_log = sum((F.when(F.col(f"p{k}") > 0, F.log(F.col(f"p{k}"))).otherwise(F.lit(-9999999999.0))
                    for k in range(1, MAX_ORDER + 1)), F.lit(0.0)) / MAX_ORDER
    return row.select(F.round(bp * F.exp(mean_log), 6).alias("bleu"), F.round(bp, 6).alias("bp"),
                      "sys_len", "ref_len", *[F.round(f"p{k}", 6).alias(f"p{k}") for k in range(1, MAX_ORDER + 1)])


def rouge_n(pairs: DataFrame, hyp_col: str = "prediction", ref_col: str = "reference", orders=(1, 2)) -> DataFrame:
    """Mean ROUGE-n F-measure over pairs (ASCII tokenizer, no stemming)."""
    p = pairs.where(F.col(ref_col).isNotNull() & F.col(hyp_col).isNotNull())
    ov = ngram_overlap(p, rouge_tokenize(F.col(hyp_col)), rouge_tokenize(F.col(ref_col)), orders)
    prec = F.col("matches") / F.greatest(F.col("hyp_total"), F.lit(1))
    rec = F.col("matches") / F.greatest(F.col("ref_total"), F.lit(1))
    f = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    # every pair has exactly one (pair, n) row per order, so the pair count
    # comes from the same aggregate (no second pass over the texts)
    per = ov.select("n", f.alias("f"))
    agg = per.agg(F.count_if(F.col("n") == orders[0]).alias("_np"),
                  *[F.coalesce(F.sum(F.when(F.col("n") == k, F.col("f"))), F.lit(0.0)).alias(f"_s{k}") for k in orders])
    return agg.select(*[F.round(F.col(f"_s{k}") / F.greatest(F.col("_np"), F.lit(1)), 6).alias(f"rouge{k}") for k in orders])


def _lcs_len(a: list, b: list) -> int:
    """Bit-parallel LCS length (Hyyro's formulation)."""
    if not a or not b:
        return 0
    masks: dict = {}
    for j, t in enumerate(b):
        masks[t] = masks.get(t, 0) | (1 << j)
    v = (1 << len(b)) - 1
    full = v
    for t in a:
        u = v & masks.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - bin(v).count("1")


@F.arrow_udf(LongType())
def _lcs_udf(h: pa.Array, r: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(h.to_pylist(), r.to_pylist()):
        out.append(None if x is None or y is None else _lcs_len(x, y))
    return pa.array(out, type=pa.int64())


def rouge_l(pairs: DataFrame, hyp_col: str = "prediction", ref_col: str = "reference") -> DataFrame:
    """Mean ROUGE-L F-measure over pairs."""
    p = spread(pairs).where(F.col(ref_col).isNotNull() & F.col(hyp_col).isNotNull())
    th, tr = rouge_tokenize(F.col(hyp_col)), rouge_tokenize(F.col(ref_col))
    arr = lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))
    x = p.select(arr(th).alias("h"), arr(tr).alias("r"))
    x = x.select("h", "r", _lcs_udf("h", "r").alias("lcs"))
    prec = F.when(F.size("h") > 0, F.col("lcs") / F.size("h")).otherwise(0.0)
    rec = F.when(F.size("r") > 0, F.col("lcs") / F.size("r")).otherwise(0.0)
    f = F.when((F.size("h") == 0) | (F.size("r") == 0), F.lit(0.0)) \
         .when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return x.agg(F.round(F.coalesce(F.sum(f), F.lit(0.0)) / F.greatest(F.count(F.lit(1)), F.lit(1)), 6).alias("rougeL"))


# Header rows of the comparison table.
COMPARISON_HEAD = ["| Prompt | Base | Merged |", "| --- | --- | --- |"]


def comparison_rows(pairs: DataFrame) -> DataFrame:
    """(pair_id, row): Markdown rows | prompt | base | merged |, newlines
    folded; the header rows have the ids -2 and -1."""
    fold = lambda c: F.replace(F.col(c), F.lit("\n"), F.lit(" "))
    bar = F.lit(" | ")
    row = F.concat(F.lit("| "), F.col("prompt"), bar, fold("base_output"), bar, fold("prediction"), F.lit(" |"))
    head = pairs.sparkSession.createDataFrame(list(zip((-2, -1), COMPARISON_HEAD)), "pair_id bigint, row string")
    return head.unionByName(pairs.select(F.col("pair_id").cast("bigint"), row.alias("row")))


def reference_fallback(pairs: DataFrame, ref_col: str = "reference", base_col: str = "base_output") -> DataFrame:
    """Use the references when any is non-empty (remaining nulls stay),
    otherwise the base model outputs."""
    any_ref = pairs.select(F.max(F.col(ref_col).isNotNull() & (F.col(ref_col) != ""))).scalar()
    return pairs.select("pair_id", F.when(F.coalesce(any_ref, F.lit(False)), F.col(ref_col)).otherwise(F.col(base_col)).alias("reference_used"))


def perplexity(logprobs: DataFrame, by: str = "seq_id") -> DataFrame:
    """exp(-mean log-probability) per sequence."""
    return logprobs.groupBy(by).agg(F.round(F.exp(-F.avg("logprob")), 6).alias("perplexity"), F.count(F.lit(1)).alias("tokens"))


TILE = 1024  # vectors of one side that meet in a row


@F.arrow_udf(StructType([StructField(n, ArrayType(DoubleType())) for n in ("c", "r")]))
def _best_of_tiles(cs: pa.Array, rs: pa.Array) -> pa.Array:
    """Per pair of tiles: each candidate's best product with a reference, and
    the converse."""
    best_c, best_r = [], []
    for c, r in zip(cs, rs):
        a, b = (np.array(x.values.flatten().to_numpy(zero_copy_only=False)).reshape(len(x), -1) for x in (c, r))
        m = a @ b.T
        best_c.append(m.max(axis=1))
        best_r.append(m.max(axis=0))
    kind = pa.list_(pa.float64())
    return pa.StructArray.from_arrays([pa.array(best_c, kind), pa.array(best_r, kind)], names=["c", "r"])


def greedy_match_f1(vectors: DataFrame, group_col: str, side_col: str, tile: int = TILE) -> DataFrame:
    """Greedy cosine matching between the candidate (side = 0) and reference
    (side = 1) token vectors of each group: precision = mean over candidate
    tokens of the best cosine to a reference token, recall the converse,
    F1 = 2PR/(P+R).

    A group's sides are dealt into tiles of about ``tile`` vectors, every pair
    of tiles is one row and gives a partial best for each of its vectors, and
    the partial bests are aggregated by max: no row or task holds a group."""
    def unit(v):
        nrm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
        return F.transform(v, lambda x: x / nrm)

    checkpoint_dir(vectors.sparkSession)
    v = vectors.select(F.col(group_col).alias("g"), F.col(side_col).cast("int").alias("side"),
                       unit(F.col("embedding").cast("array<double>")).alias("u"))
    v = v.withColumn("id", F.monotonically_increasing_id()).checkpoint(eager=True)  # the numbers stay as they are
    sizes = v.groupBy("g", "side").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    dealt = v.join(sizes, ["g", "side"]).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    blocks = dealt.groupBy("g", "side", "tile").agg(F.collect_list(F.struct("id", "u")).alias("b"))  # about ``tile`` vectors
    pick = lambda side, name: blocks.where(F.col("side") == side).select("g", F.col("tile").alias(f"t{name}"), F.col("b").alias(name))
    pairs = pick(0, "c").join(pick(1, "r"), "g")
    pairs = pairs.repartition(range_parts(pairs), "g", "tc", "tr").select(
        "g", "c.id", F.col("r.id").alias("rid"), _best_of_tiles(F.col("c.u"), F.col("r.u")).alias("best"))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.arrays_zip(F.col("id").alias("id"), F.col("best.c").alias("best")).alias("z")),
                    F.struct(F.lit(1).alias("side"), F.arrays_zip(F.col("rid").alias("id"), F.col("best.r").alias("best")).alias("z")))
    partial = pairs.select("g", F.explode(sides).alias("s")).select("g", "s.side", F.explode("s.z").alias("z")).select("g", "side", "z.id", "z.best")
    best = partial.groupBy("g", "side", "id").agg(F.max("best").alias("best")).groupBy("g").agg(
        F.avg(F.when(F.col("side") == 0, F.col("best"))).alias("p"), F.avg(F.when(F.col("side") == 1, F.col("best"))).alias("r"))
    # a group without one side matches nothing: all zero
    out = v.select("g").distinct().join(best, "g", "left").select(
        F.col("g").alias(group_col), F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("r", F.lit(0.0)).alias("r"))
    f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(0.0)
    return out.select(group_col, F.round("p", 6).alias("precision"), F.round("r", 6).alias("recall"), F.round(f1, 6).alias("f1"))


def summary(pairs: DataFrame, vectors: DataFrame | None = None, group_col: str = "grp", side_col: str = "side") -> DataFrame:
    """The metric row: bleu, rouge1, rouge2, rougeL and, with token vectors, the
    mean greedy-match F1 (null without)."""
    b = bleu_corpus(pairs).select("bleu").scalar()
    rl = rouge_l(pairs).select("rougeL").scalar()
    gm = F.lit(None).cast("double") if vectors is None else \
        greedy_match_f1(vectors, group_col, side_col).select(F.round(F.avg("f1"), 6)).scalar()
    return rouge_n(pairs).select(b.alias("bleu"), "rouge1", "rouge2", rl.alias("rougeL"), gm.alias("bert_score_f1"))
