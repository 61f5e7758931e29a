"""Durable signature index: batches give what one run gives."""

import random

import pytest
from pyspark.sql import functions as F

from winnow.operators import dedup as dd
from winnow.operators import sigindex as si
from winnow.session import scratch_path

WORDS = [f"w{i}" for i in range(500)]


def corpus(seed=1, n=90):
    """(doc_id, text) with families of near copies that span the ids."""
    rng = random.Random(seed)
    bases = [[rng.choice(WORDS) for _ in range(60)] for _ in range(12)]
    rows = []
    for d in range(n):
        w = list(rng.choice(bases)) if rng.random() < 0.7 else [rng.choice(WORDS) for _ in range(rng.choice((0, 1, 40)))]
        for _ in range(rng.choice((0, 0, 1, 2, 6))):
            if w:
                w[rng.randrange(len(w))] = rng.choice(WORDS)
        rows.append((d, " ".join(w + [rng.choice(WORDS)] * rng.choice((0, 0, 3)))))
    return rows


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


@pytest.mark.parametrize("cuts", [[45], [10, 20, 80]])
def test_batches_keep_what_one_run_keeps(spark, cuts):
    rows = corpus(len(cuts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = dd.deduplicate(docs)
    path = scratch_path(spark, "index")
    for lo, hi in zip([0, *cuts], [*cuts, len(rows)]):
        si.SignatureIndex(spark, path).add(docs.where(F.col("doc_id").between(lo, hi - 1)), normalized=True)
    index = si.SignatureIndex(spark, path)
    assert ids(index.kept(docs)) == ids(want.kept)
    assert 0 < index.dropped().count() < len(rows)
    sigs = {r["doc_id"]: r["sig"] for r in dd.signatures(docs, preprocessed=True).collect()}
    assert {r["doc_id"]: r["sig"] for r in index.signatures().collect()} == sigs
    # another session: nothing but the folder is there
    for t in si.TABLES:
        spark.sql(f"DROP TABLE {index._name(t)}")
    again = si.SignatureIndex(spark, path)
    assert ids(again.kept(docs)) == ids(want.kept)
    again.compact()
    assert ids(again.kept(docs)) == ids(want.kept) and again.commits().count() == 1
    more = spark.createDataFrame([(1000, rows[5][1]), (1001, "entirely other words stand here alone")], "doc_id long, text string")
    again.add(more, normalized=True)
    assert ids(again.kept(docs.unionByName(more))) == ids(dd.deduplicate(docs.unionByName(more)).kept)


def test_a_failed_batch_leaves_no_trace(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(7, 40), "doc_id long, text string")
    path = scratch_path(spark, "index")
    index = si.SignatureIndex(spark, path)
    index.add(docs.where("doc_id < 20"), normalized=True)
    before = ids(index.kept(docs.where("doc_id < 20")))

    def lost(*_):
        raise RuntimeError("executor lost")
    with monkeypatch.context() as m:
        m.setattr(si.SignatureIndex, "_commit", lost)
        with pytest.raises(RuntimeError):
            index.add(docs.where("doc_id >= 20"), normalized=True)
    assert ids(index.kept(docs.where("doc_id < 20"))) == before and index.signatures().where("doc_id >= 20").count() == 0
    index.add(docs.where("doc_id >= 20"), normalized=True)
    assert ids(index.kept(docs)) == ids(dd.deduplicate(docs).kept)


def test_stored_side_has_no_exchange(spark):
    docs = spark.createDataFrame(corpus(3, 60), "doc_id long, text string")
    index = si.SignatureIndex(spark, scratch_path(spark, "index"))
    index.add(docs, normalized=True)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "-1")
        new = dd.bucket_members(dd.signatures(docs, preprocessed=True)).groupBy(*dd.BUCKET).count()
        plan = new.join(index.buckets(), dd.BUCKET, "left")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    lines = plan.splitlines()
    depth = lambda s: len(s) - len(s.lstrip(" :+-"))
    scan = next(i for i, s in enumerate(lines) if "FileScan parquet" in s and "Bucketed: true" in s)
    above, at = [], depth(lines[scan])
    for s in reversed(lines[:scan]):  # the path from the stored scan up to the join
        if depth(s) < at:
            above.append(s)
            at = depth(s)
            if "Join" in s:
                break
    assert "Join" in above[-1] and not any("Exchange" in s for s in above), plan


def test_guards_and_empty(spark):
    path = scratch_path(spark, "index")
    index = si.SignatureIndex(spark, path)
    docs = spark.createDataFrame(corpus(4, 10), "doc_id long, text string")
    index.add(docs.limit(0))
    assert index.commits().count() == 0 and index.dropped().count() == 0 and index.kept(docs).count() == 10
    index.compact()
    index.add(docs, normalized=True)
    with pytest.raises(ValueError, match="stored already"):
        index.add(docs, normalized=True)
    with pytest.raises(ValueError, match="other parameters"):
        si.SignatureIndex(spark, path, dd.config_for(0.5))


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9])
def test_config_for_minimises_the_error(threshold):
    """The chosen bands and rows against a plain numeric integration of all choices."""
    import numpy as np
    x = np.linspace(0, 1, 4001)

    def error(b, r):
        p = 1 - (1 - x ** r) ** b
        left, right = x <= threshold, x >= threshold
        return 0.5 * np.trapezoid(p[left], x[left]) + 0.5 * np.trapezoid(1 - p[right], x[right])
    best = min((error(b, r), b, r) for b in range(1, 129) for r in range(1, 128 // b + 1))
    cfg = dd.config_for(threshold)
    assert cfg.threshold == threshold and cfg.bands * cfg.rows <= 128
    assert error(cfg.bands, cfg.rows) <= best[0] + 2e-4
    if threshold == 0.8:
        assert (cfg.bands, cfg.rows) == (9, 13) == (dd.DEFAULT.bands, dd.DEFAULT.rows)
