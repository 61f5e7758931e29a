"""Tiled greedy matching against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.operators import metrics as me


def frame(spark, groups):
    rows = [(g, side, [float(x) for x in v]) for g, (c, r) in groups.items() for side, vs in ((0, c), (1, r)) for v in vs]
    return spark.createDataFrame(rows, "grp long, side int, embedding array<double>").repartition(3)


def plain(c, r):
    if not len(c) or not len(r):
        return 0.0, 0.0, 0.0
    u = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    m = u(c) @ u(r).T
    p, q = m.max(axis=1).mean(), m.max(axis=0).mean()
    return p, q, 2 * p * q / (p + q) if p + q > 0 else 0.0


@pytest.mark.parametrize("tile", [1, 3, 1024])
def test_any_tile_size_gives_the_same(spark, tile):
    rng = np.random.default_rng(tile)
    groups = {g: (rng.normal(size=(int(rng.integers(0, 9)), 5)), rng.normal(size=(int(rng.integers(0, 9)), 5))) for g in range(12)}
    groups[12] = (np.ones((4, 5)), np.ones((4, 5)))  # repeats of one vector
    groups = {g: x for g, x in groups.items() if len(x[0]) + len(x[1])}
    got = {r["grp"]: (r["precision"], r["recall"], r["f1"]) for r in me.greedy_match_f1(frame(spark, groups), "grp", "side", tile).collect()}
    assert set(got) == set(groups)
    for g, (c, r) in groups.items():
        assert got[g] == pytest.approx(plain(c, r), abs=1e-6)


def test_a_large_group_is_met_in_tiles(spark):
    """One group of 40 000 vectors: every row holds two tiles at most, and the result is exact."""
    n = 20_000
    angle = F.col("id") * 0.7 + F.when(F.col("id") % 2 == 0, 0.0).otherwise(0.01)
    v = spark.range(2 * n, numPartitions=8).select(F.lit(1).alias("grp"), (F.col("id") % 2).cast("int").alias("side"),
                                                   F.array(F.cos(angle), F.sin(angle), F.lit(0.1)).alias("embedding"))
    got = me.greedy_match_f1(v, "grp", "side").first()
    ids = np.arange(2 * n)
    a = ids * 0.7 + np.where(ids % 2 == 0, 0.0, 0.01)
    m = np.c_[np.cos(a), np.sin(a), np.full(2 * n, 0.1)]
    # best partner on a circle: the nearest angle of the other side
    want = plain_sorted(a[0::2], a[1::2], m)
    assert (got["precision"], got["recall"]) == pytest.approx(want, abs=1e-6)


def plain_sorted(a, b, m):
    norm = (m[0] ** 2).sum()

    def mean_best(x, y):
        y = np.sort(y % (2 * np.pi))
        y = np.concatenate((y[-1:] - 2 * np.pi, y, y[:1] + 2 * np.pi))
        at = np.searchsorted(y, x % (2 * np.pi))
        gap = np.minimum(np.abs(y[np.minimum(at, len(y) - 1)] - x % (2 * np.pi)), np.abs(x % (2 * np.pi) - y[at - 1]))
        return ((np.cos(gap) + 0.01) / norm).mean()
    return mean_best(a, b), mean_best(b, a)
