import numpy as np
import pytest
import xxhash

from winnow.llm import simhash_vptree as sv


def brute_fp(text):
    import re
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, ids, r=3):
    comp = {i: i for i in ids}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a, fa in zip(ids, fps):
        for b, fb in zip(ids, fps):
            if bin(fa ^ fb).count("1") <= r:
                x, y = find(a), find(b)
                comp[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \t\n", "one", "One TWO", "a b c d a b c d", "É ü ñ É ü ñ x" * 40])
def test_fingerprint_matches_definition(text):
    assert sv.fingerprint((text or "").encode()) == brute_fp(text)


def test_spark_hash_is_the_same_xxh64(spark):
    from pyspark.sql import functions as F
    got = spark.createDataFrame([("héllo wörld again",)], "s string").select(F.xxhash64("s")).first()[0]
    assert got & (2**64 - 1) == xxhash.xxh64_intdigest("héllo wörld again".encode(), seed=42)


def clustered(rng, n):
    """Random fingerprints plus chains and dense balls around some of them."""
    base = rng.integers(0, 2**63, n, dtype=np.int64).view(np.uint64)
    out = [base]
    for _ in range(3):
        flips = np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        out.append(base[: n // 4] ^ flips[: n // 4] ^ np.uint64(1))
    hub = base[0]
    out.append(hub ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64)))
    return np.unique(np.concatenate(out))


@pytest.mark.parametrize("shard", [16, 64, 100000])
def test_links_are_exact(spark, shard):
    fps = clustered(np.random.default_rng(shard), 600)
    ids = list(range(len(fps)))
    distinct = spark.createDataFrame([(int(f.view(np.int64)), i) for i, f in enumerate(fps)], "fp bigint, rep bigint")
    from winnow.llm.components import connected
    got = {i: i for i in ids} | {r[0]: r[1] for r in connected(sv.links(distinct, 3, shard)).collect()}
    want = brute_components([int(f) for f in fps], ids)
    assert got == want


def test_routing_brings_every_close_pair_together():
    rng = np.random.default_rng(1)
    fps = clustered(rng, 3000)
    tree = sv.fit_tree(fps[::3], 50, 3)
    assert tree["shards"] > 8
    idx, shard = sv.route(fps, tree)
    homes = {}
    for i, s in zip(idx.tolist(), shard.tolist()):
        homes.setdefault(i, set()).add(s)
    assert len(homes) == len(fps)
    near = np.argwhere(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    assert all(homes[a] & homes[b] for a, b in near.tolist())


def test_edge_cases(spark, make_docs):
    long = "lorem ipsum dolor sit amet " * 20000
    texts = [None, "", "  ", "same words here", "same words here", "Same Words HERE", long, long + "x", "solo"]
    docs = make_docs(texts, fp=["x"] * 9, component_id=["y"] * 9, rep=["z"] * 9)
    got = {r["doc_id"]: (r["component_id"], r["fp"]) for r in sv.near_duplicates(docs).collect()}
    assert [got[i][0] for i in range(9)] == [0, 0, 0, 3, 3, 3, 6, 6, 8]
    assert got[0][1] == 0
    kept = sv.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 3, 6, 8]


def test_null_and_repeated_ids_and_empty_table(spark, make_docs):
    docs = make_docs(["a b c d", "a b c d", "q r s t", "q r s t", "u v w"], ids=[5, None, None, None, 9])
    rows = sv.near_duplicates(docs).collect()
    assert len(rows) == 5
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in rows) == [(-1, -1), (-1, -1), (-1, 5), (5, 5), (9, 9)]
    twice = make_docs(["a b c d", "a b c d", "z z z"], ids=[1, 1, 2])
    assert sorted(r["component_id"] for r in sv.near_duplicates(twice).collect()) == [1, 1, 2]
    assert sv.near_duplicates(make_docs([])).count() == 0
    assert sv.drop_near_duplicates(make_docs([])).count() == 0


def test_query_matches_brute_force(spark):
    from winnow.llm.queries import op1_simhash_vptree
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = {r["doc_id"]: brute_fp(r["text"]) for r in docs}
    want = brute_components(list(fps.values()), list(fps))
    got = op1_simhash_vptree(spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {i: (f"{fps[i]:016x}", want[i]) for i in fps}
