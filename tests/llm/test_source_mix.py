import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from winnow.llm import source_mix as sm

SF = "/root/testdata/sf0.001"


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Water-filling by rounds; sources by code point, null last."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out = share * sum(sizes.values()), {}
    free = list(names)
    while free:
        rest = total - sum(out.values())
        give = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if give[s] > most * sizes[s]]
        if not over:
            return out | give
        out |= {s: most * sizes[s] for s in over}
        free = [s for s in free if s not in over]
    return out


def check(m, docs, per_copy=1):
    """Ledger and written shards against the laws of the mix."""
    given = [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]
    ledger = m.ledger.collect()
    sizes = defaultdict(int)
    for _, s, t in given:
        sizes[s] += size(t)
    want = targets(sizes)
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 3)) for r in ledger) == Counter(
        (d, size(t), sizes[s], round(want[s], 3)) for d, s, t in given)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in ledger)
    shards = m.shards.collect()
    words = Counter()
    for r in shards:
        words[r["source"]] += size(r["text"])
    for s, t in want.items():
        assert abs(words[s] - t) <= per_copy, (s, words[s], t)
    taken, written = Counter(), Counter()
    for r in ledger:
        taken[r["doc_id"]] += r["taken"]
    for r in shards:
        written[r["doc_id"]] += size(r["text"])
    assert +taken == +written
    whole = {(d, s, t) for d, s, t in given}
    cut = [r for r in shards if (r["doc_id"], r["source"], r["text"]) not in whole]
    assert all(any(d == r["doc_id"] and re.findall(r"[^\x20\x09-\x0D]+", t)[:size(r["text"])] == r["text"].split(" ")
                   for d, _, t in given if t) for r in cut)
    return ledger, shards, cut


def test_query_and_rerun(spark):
    from winnow.llm.queries import op13_hypergeometric_mix
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(sm.mix(docs), docs)
    one = sorted(tuple(r) for r in op13_hypergeometric_mix(spark, SF).collect())
    two = sorted(tuple(r) for r in op13_hypergeometric_mix(spark, SF).collect())
    assert one == two and len(one) == docs.count()


def many(make_docs, n=3000):
    texts = [" ".join(f"w{i}x{j}" for j in range(1 + i * 7 % 40)) for i in range(n)]
    return make_docs(texts, source=[f"s{i % 7}" if i % 3 else "big" for i in range(n)], lang=["en"] * n)


def test_shards_share_the_blocks_by_exact_numbers(spark, make_docs):
    docs = many(make_docs)
    m = sm.mix(docs, shards=6)
    _, shards, cut = check(m, docs)
    assert len(cut) <= 8  # one record a source
    leaf, source = Counter(), Counter()
    for r in m.quotas.collect():
        leaf[r["shard"]] += r["blocks"]
        source[r["source"], r["shard"]] += r["blocks"]
    assert len(leaf) == 6 and max(leaf.values()) - min(leaf.values()) <= 1
    # a hot source is spread by chance, near its even share
    big = [source["big", s] for s in range(6)]
    assert max(big) < 1.35 * sum(big) / 6 and len(set(big)) > 1
    other = sm.mix(docs, shards=6, seed=4)
    assert sorted(tuple(r) for r in other.quotas.collect()) != sorted(tuple(r) for r in m.quotas.collect())
    order = [r["doc_id"] for r in shards if r["shard"] == 0]
    assert order != sorted(order) and order != sorted(order, reverse=True)


def test_split_is_a_hypergeometric_draw(spark):
    """Mean and variance of a source's part of the left half over many seeds."""
    rows = spark.createDataFrame([("a" if i < 30 else "b", i, 0) for i in range(90)], "_src string, _block int, _pass int")
    got = []
    for seed in range(60):
        at = sm.split_tree(rows, 2, seed).where("_src = 'a' AND _shard = 0")
        got.append(at.count())
    mean = sum(got) / len(got)
    var = sum((x - mean) ** 2 for x in got) / (len(got) - 1)
    assert abs(mean - 15) < 1.2                        # 45 drawn of 90, 30 of them a's
    assert 2.5 < var < 10                              # 45 * 1/3 * 2/3 * 45/89 = 5.06; 10 for independent draws


def test_copies_of_one_row_and_a_null_source(spark, make_docs):
    texts = ["same words here now"] * 1500 + [f"other {i}" for i in range(600)] + [None, ""]
    docs = make_docs(texts, ids=[None] * 1500 + list(range(602)), source=["hot"] * 1500 + [None] * 300 + ["a"] * 302)
    check(sm.mix(docs, shards=4), docs, per_copy=1500)


@pytest.mark.parametrize("texts,sources", [([], []), ([None, "", " "], ["a", None, "b"]), (["one"], [None]),
                                           (["x y z"] * 3, ["a", "a", "b"]), (["w " * 200_000, "v"], ["a", "b"])])
def test_edge_cases(spark, make_docs, texts, sources):
    n = len(texts)
    docs = make_docs(texts, source=sources, shard=["s"] * n, target=["t"] * n) if n else make_docs([]).withColumn("source", F.lit("a"))
    check(sm.mix(docs, shards=3), docs, per_copy=2)


def test_targets_stop_and_the_excess_is_shared_again(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 5}, {"a": 0, "b": 0}, {"a": 7}, {"a": 1, "b": 100, "c": 10_000, "d": 1, "e": 3, None: 50}):
        df = spark.createDataFrame([("1" if s is None else "0" + s, n) for s, n in sizes.items()], "_src string, _size long")
        got = {r["_src"]: r["_target"] for r in sm.with_targets(df).collect()}
        want = targets(sizes)
        assert {k: round(v, 6) for k, v in got.items()} == {"1" if s is None else "0" + s: round(v, 6) for s, v in want.items()}


def test_ranks_need_no_whole_window(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), "id", F.xxhash64("id").alias("k"))
    got = defaultdict(list)
    for r in sm.first_ranked(rows, ["g"], "k", ["id"]).collect():
        got[r["g"]].append((r["k"], r["_rank"]))
    for v in got.values():
        assert [x[1] for x in sorted(v)] == list(range(len(v)))


def test_no_python_in_the_plan(spark, make_docs, capsys):
    m = sm.mix(many(make_docs, 50))
    m.ledger.explain()
    m.quotas.explain()
    plan = capsys.readouterr().out
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
