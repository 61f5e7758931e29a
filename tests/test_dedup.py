"""Clustering rules and removal invariants."""

import random

import pytest
from pyspark.sql import functions as F

from winnow.operators import dedup as dd

SF = "/root/testdata/sf0.001"


def _random_graphs(n_graphs=25, seed=7):
    """Disjoint random doc-bucket graphs; returns membership rows."""
    rnd = random.Random(seed)
    rows, base, key = [], 0, 0
    for _ in range(n_graphs):
        n = rnd.randint(2, 30)
        for _ in range(rnd.randint(1, 2 * n)):
            members = rnd.sample(range(n), rnd.randint(1, min(n, 5)))
            band = rnd.randint(0, 8)
            key += 1
            rows += [(base + m, band, key, -key) for m in members]
        base += n
    return rows


def _sequential(rows):
    buckets = {}
    for d, b, k1, k2 in rows:
        buckets.setdefault((b, k1, k2), set()).add(d)
    adj = {}
    for mem in buckets.values():
        if len(mem) < 2:
            continue
        for d in mem:
            adj.setdefault(d, set()).update(mem - {d})
    processed, clusters = set(), {}
    for d in sorted(adj):
        if d in processed:
            continue
        clusters[d] = adj[d] | {d}
        processed |= clusters[d]
    return adj, clusters


def test_greedy_matches_sequential_rule(spark):
    rows = _random_graphs()
    members = spark.createDataFrame(rows, "doc_id long, band int, k1 long, k2 long")
    linked = dd.linked_members(members)
    seeds = dd.greedy_seeds(linked)
    got = {}
    for r in dd.cluster_members(linked, seeds).collect():
        got.setdefault(r.cluster_id, set()).add(r.doc_id)
    _, want = _sequential(rows)
    assert got == want


def test_connected_groups_match_union_find(spark):
    rows = _random_graphs(seed=11)
    members = spark.createDataFrame(rows, "doc_id long, band int, k1 long, k2 long")
    got = {r.doc_id: r.group_id for r in dd.connected_groups(dd.linked_members(members)).collect()}
    adj, _ = _sequential(rows)
    parent = {d: d for d in adj}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for d, ns in adj.items():
        for m in ns:
            a, b = find(d), find(m)
            parent[max(a, b)] = min(a, b)
    comp = {}
    for d in adj:
        comp.setdefault(find(d), []).append(d)
    want = {d: min(c) for c in comp.values() for d in c}
    assert got == want


def _chain(spark, n):
    """Documents 0..n-1, each sharing one bucket with the next: the longest chain of decisions."""
    rows = [(d, 0, min(d, o), 1) for d in range(n) for o in (d - 1, d + 1) if 0 <= o < n]
    return spark.createDataFrame(rows, "doc_id long, band int, k1 long, k2 long")


def test_greedy_rounds_write_less_and_less(spark):
    trace = []
    seeds = dd.greedy_seeds(_chain(spark, 24), trace=trace)
    assert sorted(r.doc_id for r in seeds.where("is_seed").collect()) == list(range(0, 24, 2))
    assert seeds.count() == 24
    assert len(trace) == 12 and all(a > b for a, b in zip(trace, trace[1:])) and trace[-1] == 2


def test_contraction_shrinks_the_edges(spark):
    trace = []
    groups = dd.connected_groups(_chain(spark, 120), trace=trace)
    assert {(r.doc_id, r.group_id) for r in groups.collect()} == {(d, 0) for d in range(120)}
    assert all(a > b for a, b in zip(trace, trace[1:])) and len(trace) <= 16
    # a hub with many leaves folds in one round
    hub = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(0).alias("band"), F.lit(7).cast("bigint").alias("k1"),
                                  F.lit(1).cast("bigint").alias("k2"))
    trace = []
    assert dd.connected_groups(hub, trace=trace).where("group_id = 0").count() == 500
    assert trace == [499]
    assert dd.connected_groups(hub.limit(0)).count() == dd.greedy_seeds(hub.limit(0)).count() == 0


@pytest.fixture(scope="module")
def flagship(spark):
    from winnow.plans.q_dedup import flagship as fl, normalized
    return normalized(spark, SF), fl(spark, SF)


def test_kept_and_removed_partition_input(flagship):
    docs, res = flagship
    all_ids = {r.doc_id for r in docs.select("doc_id").collect()}
    kept = {r.doc_id for r in res.kept.select("doc_id").collect()}
    removed = {r.doc_id for r in res.removed.select("doc_id").collect()}
    assert kept | removed == all_ids and not kept & removed
    assert removed, "sf0.001 has exact copies, something must be removed"


def test_removed_docs_have_a_kept_representative(flagship):
    _, res = flagship
    kept = {r.doc_id for r in res.kept.select("doc_id").collect()}
    removed = {r.doc_id for r in res.removed.select("doc_id").collect()}
    reps = {r.cluster_id: r.rep_id for r in res.reps.collect()}
    by_doc = {}
    for r in res.members.collect():
        by_doc.setdefault(r.doc_id, set()).add(r.cluster_id)
    for d in removed:
        assert any(reps[c] in kept for c in by_doc[d])


def test_independent_of_partitioning(spark, flagship):
    docs, res = flagship
    again = dd.deduplicate(docs.repartition(3))
    assert sorted(r.doc_id for r in again.kept.select("doc_id").collect()) == \
        sorted(r.doc_id for r in res.kept.select("doc_id").collect())


def test_identity_without_candidates(spark, flagship):
    docs, res = flagship
    alone = docs.join(res.linked.select("doc_id").distinct(), "doc_id", "left_anti")
    again = dd.deduplicate(alone)
    assert again.removed.count() == 0 and again.kept.count() == alone.count()


def test_longest_representative(spark):
    rows = [(0, "강물", None), (1, "강물이 천천히 흐른다", None), (2, "강물이 천천히 흐르고 새가 물 위를 낮게 난다", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens array<string>")
    members = spark.createDataFrame([(0, 0), (0, 1), (0, 2)], "cluster_id long, doc_id long")
    assert dd.representatives(members, docs).first().rep_id == 2
    rows = [(0, "a very long line of text", ["x"]), (1, "tiny", ["p", "q", "r"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens array<string>")
    members = spark.createDataFrame([(0, 0), (0, 1)], "cluster_id long, doc_id long")
    assert dd.representatives(members, docs).first().rep_id == 1


def test_newest_representative_falls_back_to_longest(spark):
    rows = [(0, "aaaa", "2024-01-01"), (1, "bb", "2024-03-01 10:00:00"), (2, "cccccc", "junk")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, timestamp string")
    members = spark.createDataFrame([(0, 0), (0, 1), (0, 2), (5, 0), (5, 2)], "cluster_id long, doc_id long")
    got = {r.cluster_id: r.rep_id for r in dd.representatives(members, docs, "newest").collect()}
    assert got[0] == 1
    docs2 = docs.withColumn("timestamp", F.lit("junk"))
    assert {r.cluster_id: r.rep_id for r in dd.representatives(members, docs2, "newest").collect()}[0] == 2


def test_exact_copies_collapse(spark):
    rows = [(0, "구름이 산을 넘어간다"), (1, "구름이 산을 넘어간다"), (2, "시장에서 사과를 샀다"), (3, "구름이 산을 넘어간다 그리고 사라진다")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    res = dd.deduplicate(dd.normalize_docs(docs))
    kept = sorted(r.doc_id for r in res.kept.collect())
    assert 0 in kept and 1 not in kept and 2 in kept


def test_chunk_local_dedup_keeps_cross_chunk_copies(spark):
    rows = [(0, "a", 0), (1, "a", 1), (2, "같은 문장이 반복됩니다 여기", 2), (3, "같은 문장이 반복됩니다 여기", 3),
            (4, "같은 문장이 반복됩니다 여기", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk long")
    res = dd.deduplicate(docs, dd.DedupConfig(scope_col="chunk"), normalized=False)
    # copies in different chunks survive; the copy inside chunk 3 collapses
    assert sorted(r.doc_id for r in res.kept.collect()) == [0, 1, 2, 3]
