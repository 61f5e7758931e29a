"""MinHash / Jaccard literal fixtures and the hash-family contract."""

import hashlib
import random

import pyarrow as pa
from pyspark.sql import functions as F

from winnow.functions import minhash as mh
from winnow.functions import text as tx
from winnow.operators import dedup as dd


def test_signature_length(spark):
    df = spark.createDataFrame([(["a b", "b c", "c d"],)], "s array<string>")
    sig = df.select(mh.minhash_signature("s", num_perm=64).alias("x")).first().x
    assert len(sig) == 64


def test_signature_matches_definition(spark):
    grams = ["안녕", "hello", "x y z"]
    df = spark.createDataFrame([(grams,)], "s array<string>")
    sig = df.select(mh.minhash_signature("s").alias("x")).first().x
    h = [int.from_bytes(hashlib.md5(g.encode()).digest()[:4], "big") % mh.MERSENNE_P for g in grams]
    want = [min((a * x + b) % mh.MERSENNE_P for x in h) for a, b in mh.perm_constants()]
    assert sig == want


def test_jaccard(spark):
    df = spark.createDataFrame([(["a", "b", "c"], ["b", "c", "d"]), ([], [])], "a array<string>, b array<string>")
    assert [r.j for r in df.select(mh.jaccard("a", "b").alias("j")).collect()] == [0.5, 1.0]


def test_estimate(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 5, 6]), ([], [])], "a array<bigint>, b array<bigint>")
    assert [r.e for r in df.select(mh.estimate_jaccard("a", "b").alias("e")).collect()] == [0.5, 0.0]


def test_identical_grams_estimate(spark):
    df = spark.createDataFrame([(["p q", "q r", "r s"],)], "s array<string>")
    s = df.select(mh.minhash_signature("s", num_perm=16).alias("a"), mh.minhash_signature("s", num_perm=16).alias("b"))
    assert s.select(mh.estimate_jaccard("a", "b").alias("e")).first().e >= 0.99


def test_short_texts_are_not_indexed(spark):
    docs = spark.createDataFrame([(0, "가나다라마바사"), (1, "가나다라마바사")], "doc_id long, text string")
    assert dd.signatures(docs).count() == 0


def test_band_keys_split_signature(spark):
    df = spark.createDataFrame([(list(range(128)),)], "sig array<bigint>")
    b = df.select(F.explode(mh.band_strings("sig")).alias("b")).select("b.*").collect()
    assert len(b) == 9 and b[0].key == ",".join(str(i) for i in range(13))


def test_text_signature_is_that_of_the_shingle_set(spark):
    """Against the set of shingles, for long, short, Hangul, four-word and astral
    texts, whatever the gram sizes; a long document is signed in pieces."""
    import random

    from winnow.operators import dedup as dd
    rng = random.Random(4)
    words = ["가각", "tree", "İstanbul", "ΟΔΟΣ", "𝔘nd", "x", "입니다", "Straße", "a.b"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(40)]
    texts += ["하나 둘 셋 넷입니다", "one two three four", "abcdefghij", " ".join(f"w{i}" for i in range(30_000)), None, "short"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for cfg in (dd.DEFAULT, dd.DedupConfig(ngram_size=2, jamo_ngram_size=4, min_chars=3), dd.DedupConfig(ngram_size=3, jamo_ngram_size=3, min_chars=1, min_grams=1)):
        sets = dd.shingle_sets(docs, cfg)
        want = {r.doc_id: r.s for r in sets.select("doc_id", mh.minhash_signature("shingles").alias("s")).collect()}
        plain = {}
        consts = mh.perm_constants()
        for r in sets.select("doc_id", mh.shingle_hashes("shingles").alias("h")).where("doc_id < 8").collect():
            plain[r.doc_id] = [min((a * h + b) % mh.MERSENNE_P for h in r.h) for a, b in consts]
        got = {r.doc_id: r.sig for r in dd.signatures(docs, cfg).collect()}
        assert got == want and {k: got[k] for k in plain} == plain and len(got) > 40


def test_gram_totals_are_those_of_the_grams(spark):
    """Counts and hash sums without a row per gram, with repeats and as a set in
    which a word window may equal a character window."""
    import random

    from winnow.functions import text as tx
    from winnow.operators import dedup as dd
    rng = random.Random(5)
    words = ["가각", "tree", "İ", "a", "𝔘nd", "입니다", "aaa", "Straße"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 30))) for _ in range(30)] + ["", "ab", "하나 둘 셋 넷입니다", "aaaaaaaaaa aaa aaa"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def summed(rows, col):
        e = rows.select("doc_id", F.explode(col).alias("s"))
        return {r[0]: (r[1], r[2]) for r in e.groupBy("doc_id").agg(F.count("s"), F.sum(mh.base_hash_expr("s"))).collect()}

    for w, c, grams in ((5, 0, tx.word_ngrams("text", 5)), (0, 3, tx.jamo_ngrams("text", 3)), (0, 4, tx.jamo_ngrams("text", 4))):
        got = docs.select("doc_id", mh.text_totals(F.col("text"), w, c, distinct=False).alias("t")).select("doc_id", "t.*").collect()
        assert {r[0]: (r[1], r[2]) for r in got} == summed(docs, grams)
    for cfg in (dd.DEFAULT, dd.DedupConfig(ngram_size=1, min_chars=1, min_grams=1), dd.DedupConfig(ngram_size=2, jamo_ngram_size=4, min_chars=3)):
        got = dd.shingle_totals(docs, cfg).select("doc_id", "totals.*").collect()
        want = summed(dd.shingle_sets(docs, cfg), F.col("shingles"))
        assert {r[0]: (r[1], r[2]) for r in got} == want and len(want) > 20
        assert {r[0]: len(set(r[1])) for r in dd.shingle_elements(docs, cfg).collect()} == {k: v[0] for k, v in want.items()}


def test_gram_queries_make_no_row_per_gram(spark):
    from winnow.plans import q_dedup as q
    for query in (q.shingles, q.word_ngrams, q.jamo_ngrams):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Generate" not in plan


def test_elements_tell_grams_apart_as_their_strings_do():
    """The hashes by array arithmetic and the ones of the grams' strings give the same sets."""
    rng = random.Random(5)
    docs = ["".join(rng.choice("ab é가") for _ in range(rng.choice((0, 1, 2, 3, 4, 9, 20)))) for _ in range(200)]
    docs = [" ".join(d.split()) for d in docs] + ["a b c d입니다", "a b c", "ab", "ABC d", "x" * 99 + " " + "y" * 70 + " z", "y" * 70]
    lows = [d.lower() for d in docs]
    for word_n, char_n in ((5, 3), (3, 3), (2, 3), (5, 2)):
        jamo = tx._jamo_slice(pa.array(docs)).to_pylist()
        want = mh.gram_hashes(jamo, lows, word_n, char_n, hashed=mh._hashed_wide).to_pylist()
        got = [s for _, part in mh.text_element_slices(pa.array(docs), pa.array(lows), word_n, char_n) for s in part.to_pylist()]
        assert [len(s) for s in got] == [len(set(s)) for s in got] == [len(s) for s in want]
        assert all(len({*got[i]} & {*got[k]}) == len({*want[i]} & {*want[k]}) for i in range(len(docs)) for k in range(i))
