"""Parameter deltas/merges and text metrics on literal fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from winnow.operators import metrics as me
from winnow.operators import params as pa


def vecs(spark, d):
    return spark.createDataFrame([(k, [float(v)]) for k, v in d.items()], "name string, vec array<double>")


def as_dict(df):
    return {r.name: round(r.vec[0], 6) for r in df.collect()}


def test_vector_diff(spark):
    d = pa.vector_diff(vecs(spark, {"in": -4.0, "out": 7.25}), vecs(spark, {"in": -1.0, "out": 7.0, "other": 5}))
    assert as_dict(d) == {"in": 3.0, "out": -0.25}


def test_vector_diff_missing_name_raises(spark):
    with pytest.raises(Exception):
        pa.vector_diff(vecs(spark, {"in": -4.0, "out": 7.25}), vecs(spark, {"out": 3.0})).collect()
    two = vecs(spark, {"in": 1.0, "out": 2.0}).withColumn("model", F.lit("a")).unionByName(vecs(spark, {"in": 1.0}).withColumn("model", F.lit("b")))
    with pytest.raises(Exception):
        pa.vector_diff(vecs(spark, {"in": -4.0, "out": 7.25}), two).collect()


def test_merge(spark):
    base = vecs(spark, {"in": 10.0, "out": -3.0})
    d1 = vecs(spark, {"in": 4.0, "out": 6.0}).withColumn("model", F.lit("a"))
    d2 = vecs(spark, {"in": -8.0}).withColumn("model", F.lit("b"))
    w = spark.createDataFrame([("a", 0.5), ("b", 0.25)], "model string, weight double")
    assert as_dict(pa.merge_weighted(base, d1.unionByName(d2), w)) == {"in": 10.0, "out": 0.0}


def test_diff_stats(spark):
    d = pa.vector_diff(vecs(spark, {"p": 2.0, "q": 0.0}), vecs(spark, {"p": 5.0, "q": -4.0}))
    r = pa.diff_stats(d).first()
    assert (r.norm, r.max, r.min) == (5.0, 3.0, -4.0)


def pairs(spark, rows):
    return spark.createDataFrame([(i, r, p) for i, (r, p) in enumerate(rows)], "pair_id long, reference string, prediction string")


def test_identical_pairs_score(spark):
    p = pairs(spark, [("Rain fell on seven tin roofs all night.", "Rain fell on seven tin roofs all night."),
                      ("No gardener plants onions under an old walnut tree.", "No gardener plants onions under an old walnut tree.")])
    assert me.bleu_corpus(p).first().bleu == pytest.approx(100.0)
    assert me.rouge_l(p).first().rougeL == pytest.approx(1.0)
    r = me.rouge_n(p).first()
    assert r.rouge1 == pytest.approx(1.0) and r.rouge2 == pytest.approx(1.0)


def test_bleu_tokenizer(spark):
    df = spark.createDataFrame([("Well, sailors. Paid 12.75 [net]-like?",)], "t string")
    assert df.select(me.bleu_tokenize(F.col("t")).alias("x")).first().x == "Well , sailors . Paid 12.75 [ net ] -like ?"


def test_lcs_matches_dynamic_programming():
    rnd = random.Random(3)
    for _ in range(200):
        a = [rnd.choice("abcd") for _ in range(rnd.randint(0, 12))]
        b = [rnd.choice("abcd") for _ in range(rnd.randint(0, 12))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
        assert me._lcs_len(a, b) == t[-1][-1]


def test_reference_fallback(spark):
    p = spark.createDataFrame([(0, None, "base")], "pair_id long, reference string, base_output string")
    assert me.reference_fallback(p).first().reference_used == "base"
    p = spark.createDataFrame([(0, "Ahoy", "base"), (1, None, "b2")], "pair_id long, reference string, base_output string")
    assert [r.reference_used for r in me.reference_fallback(p).orderBy("pair_id").collect()] == ["Ahoy", None]


def test_chunked_merge_equals_whole(spark):
    import random as rnd
    r = rnd.Random(5)
    base = spark.createDataFrame([("w", [r.random() for _ in range(10)])], "name string, vec array<double>")
    d = spark.createDataFrame([("a", "w", [r.random() for _ in range(10)]), ("b", "w", [r.random() for _ in range(10)])],
                              "model string, name string, vec array<double>")
    w = spark.createDataFrame([("a", 0.5), ("b", 0.25)], "model string, weight double")
    whole = pa.merge_weighted(base, d, w).first().vec
    parts = pa.merge_weighted(pa.chunk_vectors(base, 3), pa.chunk_vectors(d, 3), w).orderBy("chunk").collect()
    assert [c.chunk for c in parts] == [0, 1, 2, 3]
    assert sum((p.vec for p in parts), []) == pytest.approx(whole)


def test_group_without_one_side_is_kept(spark):
    rows = [(1, 0, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 0, [0.0, 1.0])]
    v = spark.createDataFrame(rows, "g long, side int, embedding array<double>")
    got = {r.g: (r.precision, r.recall, r.f1) for r in me.greedy_match_f1(v, "g", "side").collect()}
    assert got == {1: (1.0, 1.0, 1.0), 2: (0.0, 0.0, 0.0)}


def test_files_to_pairs(spark, tmpdir_session):
    import os
    from winnow.sources import io
    for name, lines in (("refs", ["one", "", " two "]), ("preds", ["uno", "dos"]), ("short", ["uno"])):
        with open(os.path.join(tmpdir_session, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    load = lambda n, side: io.read_texts(spark, os.path.join(tmpdir_session, n), side)
    got = me.align_pairs(load("refs", "reference"), load("preds", "prediction")).orderBy("pair_id").collect()
    assert [tuple(r) for r in got] == [(1, "one", "uno"), (2, "two", "dos")]
    with pytest.raises(Exception, match="counts do not match"):
        me.align_pairs(load("refs", "reference"), load("short", "prediction")).collect()


def test_prompts(spark, tmpdir_session):
    import os
    from winnow.sources import io
    path = os.path.join(tmpdir_session, "prompts.jsonl")
    with open(path, "w") as f:
        f.write('{"prompt": "tide?", "reference": "high"}\n{"prompt": "wind?"}\n')
    assert [tuple(r) for r in io.read_prompts(spark, path).orderBy("line_no").collect()] == [(1, "tide?", "high"), (2, "wind?", None)]
    with open(path, "a") as f:
        f.write("{oops\n")
    with pytest.raises(Exception):
        io.read_prompts(spark, path).collect()


def test_queries_on_a_table_whose_last_name_lacks_models(spark, tmp_path):
    """Six vectors: w0 has all models, w1 the base and m1 alone."""
    from winnow.plans import q_params as qp
    spark.createDataFrame([(i, [float(i)]) for i in range(6)], "vec_id bigint, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    sf = str(tmp_path)
    assert sorted(map(tuple, qp.vector_diff(spark, sf).collect())) == [("m1", "w0", 0, 1.0), ("m1", "w1", 0, 1.0), ("m2", "w0", 0, 2.0), ("m3", "w0", 0, 3.0)]
    assert sorted(map(tuple, qp.merge_weighted(spark, sf).collect())) == [("w0", 0, 1.7), ("w1", 0, 4.5)]
    assert sorted((r.model, r.norm) for r in qp.diff_stats(spark, sf).collect()) == [("m1", 1.414214), ("m2", 2.0), ("m3", 3.0)]
    assert {r.model for r in qp.diff_outliers(spark, sf).collect()} == {"m1", "m2", "m3"}
