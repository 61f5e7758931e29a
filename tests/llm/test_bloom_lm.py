import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from winnow.llm import bloom_lm as lm


def brute(rows):
    """(n, v, per row: held, n_tokens, n_known, base, exact smoothed score)"""
    def words(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    uni, bi = Counter(), Counter()
    for (d, t), h in zip(rows, held):
        if d is not None and not h:
            w = words(t)
            uni.update(w)
            bi.update(zip([None, *w], w))
    n, v = sum(uni.values()), len(uni)
    out = []
    for (d, t), h in zip(rows, held):
        w = words(t)
        base = [math.log10((uni[x] + 1) / (n + v + 1)) for x in w]
        smooth = 0.0
        for u, x in zip([None, *w], w):
            c = bi[u, x]
            c = min(lm.level_counts()[int(lm.quantise(np.array([c]))[0])] if c else 0, uni[u], uni[x])
            smooth += math.log10((c + lm.MU * (uni[x] + 1) / (n + v + 1)) / (uni[u] + lm.MU))
        out.append((d, h, len(w), sum(uni[x] > 0 for x in w), n, sum(base), smooth))
    return out


def compare(got, want, loose=0.03):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9, atol=1e-6)
    assert np.allclose([g[6] for g in got], [w[6] for w in want], rtol=loose, atol=1.0)  # the filter may overcount
    return np.array([g[6] for g in got]), np.array([w[6] for w in want])


def test_filter_never_undercounts_and_rarely_overcounts():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**48, 60000, dtype=np.int64)).astype(np.uint64)
    counts = rng.zipf(1.7, len(keys)).clip(1, 10**9)
    raw = lm.build_range(keys, counts)
    got = lm.probe_range(raw, keys)
    want = lm.quantise(counts)
    assert (got >= want).all() and (got > want).mean() < 0.03
    other = np.setdiff1d(rng.integers(0, 2**48, 60000, dtype=np.int64).astype(np.uint64), keys)
    assert (lm.probe_range(raw, other) > 0).mean() < 0.02
    assert (lm.probe_range(b"", keys[:5]) == 0).all()


def test_quantisation_brackets_counts():
    for c in [1, 2, 3, 4, 5, 7, 10, 100, 12345, 10**12]:
        q = int(lm.quantise(np.array([c]))[0])
        assert lm.BASE ** (q - 1) <= c + 1e-6 < lm.BASE ** q + 1e-3
        assert 0.6 < lm.level_counts()[q] / c < 1.6


def test_packing_round_trips():
    a = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000, dtype=np.int64)).astype(np.uint64)
    assert (lm.unpack_sorted(lm.pack_sorted(a)) == a).all()
    assert (lm.unpack_planes(lm.pack_planes(np.arange(9, dtype=np.uint32)), np.uint32) == np.arange(9)).all()


def test_query_matches_brute_force(spark):
    from winnow.llm.queries import op5_bloom_lm
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op5_bloom_lm(spark, sf).collect()
    a, b = compare(got, brute(rows))
    assert a.sum() > np.sum([r["base_score"] for r in got])  # bigrams tell more than unigrams


@pytest.mark.parametrize("kw", [{"block": 50}, {"group_tokens": 40}, {"block": 200, "group_tokens": 30, "shard_bytes": 256}])
def test_blocks_groups_and_shards_do_not_change_results(spark, make_docs, kw):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 60).clip(1, 300))) for i in range(120)]
    compare(lm.score(make_docs([t for _, t in rows], ids=[d for d, _ in rows]), **kw).collect(), brute(rows), loose=0.08)


def test_edge_cases(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "A b a"), (3, "A b a"), (None, "zz new"), (5, "x " * 60000)]
    docs = make_docs([t for _, t in rows], ids=[d for d, _ in rows], block=["q"] * 6, keys=["r"] * 6, score=["s"] * 6)
    compare(lm.score(docs).collect(), brute(rows))
    assert lm.score(make_docs([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = lm.score(make_docs(["a b"], ids=[held])).collect()
    assert only[0]["train_tokens"] == 0 and only[0]["base_score"] == 0 and math.isfinite(only[0]["score"])


def test_a_range_is_answered_where_it_is_built(spark, make_docs, monkeypatch):
    """No part of the filter is collected or broadcast, and every request gets its level."""
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda *a: pytest.fail("broadcast"))
    rows = [(d, " ".join(f"w{(d * k) % 7}" for k in range(20))) for d in range(40)]
    compare(lm.score(make_docs([t for _, t in rows], ids=[d for d, _ in rows]), block=60, group_tokens=20).collect(), brute(rows), loose=0.08)
