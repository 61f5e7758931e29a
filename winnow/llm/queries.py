"""Registered queries of the subpackage: each applies one operator to its whole
table and derives the digest columns from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from winnow.llm import (best_fit, bloom_lm, decontaminate, densified_minhash, gru_langid, period_runs, pii_transducer,
                        shuffle_shards, simhash_vptree, source_mix, spelling_variants, token_files, zstd_toxicity)
from winnow.llm.tokenizing import vocabulary
from winnow.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
END_ID = 2  # appended to every document's token ids


def query(fn: Callable) -> Callable:
    QUERIES[fn.__name__] = fn
    return fn


def oracle(sql: str) -> Callable:
    def add(fn: Callable) -> Callable:
        ORACLES[fn.__name__] = sql
        return fn
    return add


@query
def op1_simhash_vptree(spark, sf_dir):
    """Component of every document under SimHash links of at most 3 bits."""
    found = simhash_vptree.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_pii_transducer(spark, sf_dir):
    """Personal data of every document: counts and places."""
    found = pii_transducer.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query
def op3_gru_langid(spark, sf_dir):
    """Language of every document."""
    return gru_langid.identify(table(spark, sf_dir, "documents"))


@query
def op4_densified_minhash(spark, sf_dir):
    """Fingerprints of every document and its edited text, with likenesses."""
    return densified_minhash.compare_neighbours(table(spark, sf_dir, "documents"))


@query
def op5_bloom_lm(spark, sf_dir):
    """Language-model score of every document."""
    return bloom_lm.score(table(spark, sf_dir, "documents"))


@query
def op6_zstd_toxicity(spark, sf_dir):
    """Toxicity of every document."""
    return zstd_toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_simhash_decontamination(spark, sf_dir):
    """Benchmark items found in documents, one row per document and item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_token_files(spark, sf_dir):
    """Every document's place in the token files, read back from them."""
    return token_files.token_files(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), END_ID)


@query
def op9_best_fit(spark, sf_dir):
    """Every piece's place in the packed sequences."""
    return best_fit.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), END_ID)


@query
def op10_shuffle_shards(spark, sf_dir):
    """Every document's shard and slot, read back from the written shards."""
    out = shuffle_shards.write_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "size", F.crc32("text").alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# The checksum by its rule (256 remainders, then byte by byte), the near words by
# their forms with one letter left out.
VARIANTS_SQL = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS v FROM bits WHERE k = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
         FROM documents),
per_doc AS (SELECT doc_id, run, count(*) AS n, coalesce(doc_id::VARCHAR, '') || ':' || run AS key FROM runs GROUP BY doc_id, run),
bytes AS (SELECT run, n, flatten(list_transform(string_split(key, ''), lambda x:
                   CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)]::BIGINT[] END)) AS b
          FROM per_doc),
hashed AS (SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, v[(xor(c & 255, x) + 1)::INT]), 4294967295::BIGINT), 4294967295) AS h
           FROM bytes, crc_table),
spelled AS (SELECT CASE WHEN h % 199 = 0 THEN run[1:(h % length(run))::INT] || run[(h % length(run))::INT + 2:] ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
         UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM near GROUP BY word),
form AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
                CASE WHEN b.top >= 5 * w.n THEN (SELECT min(x.other) FROM near x WHERE x.word = w.word AND x.other_n = b.top) END AS form,
                CASE WHEN b.top >= 5 * w.n THEN b.top END AS form_n
         FROM words w LEFT JOIN best b USING (word)),
chain(word, root, depth) AS (SELECT word, word, 0 FROM form
                             UNION ALL SELECT c.word, f.form, c.depth + 1 FROM chain c JOIN form f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, (SELECT max_by(c.root, c.depth) FROM chain c WHERE c.word = f.word) AS root, f.n, f.n_near, f.form_n FROM form f"""


@query
@oracle(VARIANTS_SQL)
def op11_fm_variants(spark, sf_dir):
    """Near words and forms of every frequent word of the documents, with the
    contract's lost letters."""
    runs = spelling_variants.occurrences(table(spark, sf_dir, "documents"))
    found = spelling_variants.group_variants(spelling_variants.counted(spelling_variants.with_typos(runs)))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query
def op12_recompression_runs(spark, sf_dir):
    """Periodic runs of every document, with the contract's repeated stretches."""
    found = period_runs.find(period_runs.with_cycles(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "start", "length", "period",
        F.expr("1000 * length div period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op13_hypergeometric_mix(spark, sf_dir):
    """What the mix of all documents takes from each; the shards are written."""
    return source_mix.mix(table(spark, sf_dir, "documents")).ledger
