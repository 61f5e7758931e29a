import random
import zlib

import numpy as np

from winnow.llm import zstd_toxicity as zt


def auc(p, y):
    p, y = np.asarray(p), np.asarray(y)
    return np.mean([(a > b) + 0.5 * (a == b) for a in p[y == 1] for b in p[y == 0]])


def corpus(n, seed=0):
    rng = random.Random(seed)
    syl = [a + b for a in "bcdfglmnprst" for b in ("a", "en", "or", "ist", "u")]
    bad = ["idiotic", "scumbag", "worthless", "moronic", "disgusting", "pathetic"]
    rows = []
    for i in range(n):
        w = ["".join(rng.choice(syl) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(60, 250))]
        toxic = int(rng.random() < 0.2)
        for _ in range(6 * toxic):
            w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w), toxic))
    return rows


def run(spark, rows, labels=None):
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t, _ in rows], "doc_id bigint, text string, toxic string, score string")
    marks = spark.createDataFrame([(i, 1, y) for i, _, y in (rows if labels is None else labels)], "doc_id bigint, quality int, toxic int")
    return zt.toxicity(docs, marks).collect()


def test_held_out_quality(spark):
    rows = corpus(1500)
    got = {r["doc_id"]: r for r in run(spark, rows)}
    held = [(got[i]["score"], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(got) == len(rows) and all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert auc(*zip(*held)) > 0.95
    assert np.mean([(s >= 0.5) == y for s, y in held]) > 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_contrast_counts_contexts_not_copies():
    copies = [b"same passage of strange zyxwords here again and again"] * 200
    varied = [f"w{i} insult v{i} then insult u{i}".encode() for i in range(60)]
    ordinary = [f"w{i} hello v{i} then good u{i}".encode() for i in range(200)]
    words = zt.contrast(copies + varied, ordinary)
    assert b"insult" in words and b"zyxwords" not in words


def test_edge_cases(spark):
    rows = [(1, None, 0), (2, "", 1), (3, "plain words", 0), (3, "plain words", 0), (None, "no id", 0), (4, "long " * 50000, 0)]
    got = run(spark, rows, labels=[])
    assert len(got) == 6 and {r["score"] for r in got} == {0.0} and {r["predicted"] for r in got} == {0}
    one_class = run(spark, rows, labels=[(i, None, 1) for i in (1, 2, 3, 4)])
    assert all(r["score"] == 1.0 for r in one_class)
    trained = corpus(300, 1) + [(1000, None, 0), (1001, "", 0), (None, "idiotic", 0), (1002, "x " * 100000, 0)]
    got = run(spark, trained)
    assert len(got) == len(trained) and all(np.isfinite(r["score"]) for r in got)
    assert not next(r for r in got if r["doc_id"] is None)["held_out"]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert zt.toxicity(empty, spark.createDataFrame([], "doc_id bigint, toxic int")).count() == 0
