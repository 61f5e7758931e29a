import zlib
from collections import Counter

from winnow.llm import shuffle_shards as ss

SF = "/root/testdata/sf0.001"


def check(rows, shards=16):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert 0 <= r["shard"] < shards
        assert r["grown_shard"] in (r["shard"], shards)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query(spark):
    from winnow.llm.queries import op10_shuffle_shards
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op10_shuffle_shards(spark, SF).collect()
    check(rows)
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {d: (len(t) + 1, zlib.crc32(t)) for d, t in docs.items()}
    assert len(rows) == len(docs) and {r["law"] for r in rows} == {"key"}
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in op10_shuffle_shards(spark, SF).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}


def test_many_buckets_mix_and_keep_the_key_law(spark, make_docs):
    docs = make_docs([f"text {i} " * 20 for i in range(2000)])
    small = ss.shuffled(docs, shards=4, bucket_bytes=5000).collect()
    check(small, 4)
    whole = {r["doc_id"]: r["shard"] for r in ss.shuffled(docs, shards=4).collect()}
    assert whole == {r["doc_id"]: r["shard"] for r in small}  # bucket size does not move a row
    grown = {r["doc_id"]: r["shard"] for r in ss.shuffled(docs, shards=5).collect()}
    assert grown == {r["doc_id"]: r["grown_shard"] for r in small}
    assert max(Counter(whole.values()).values()) < 1.2 * 500
    order = [r["doc_id"] for r in sorted(small, key=lambda r: (r["shard"], r["slot"])) if r["shard"] == 0]
    assert order != sorted(order) and order != sorted(order, reverse=True)


def test_edge_cases(spark, make_docs):
    docs = make_docs([None, "", "same", "same", "é" * 100000, "n", "n"], ids=[1, 2, 3, 3, 4, None, None],
                     shard=["a"] * 7, slot=["b"] * 7, lang=["en"] * 7, _bucket=["q"] * 7)
    rows = ss.write_shards(docs).collect()
    check(rows)
    assert len(rows) == 7
    assert sorted((r["doc_id"] or 0, r["size"]) for r in rows) == [(0, 2), (0, 2), (1, 1), (2, 1), (3, 5), (3, 5), (4, 200001)]
    assert {r["lang"] for r in rows} == {"en"} and {r["_bucket"] for r in rows} == {"q"}
    assert ss.write_shards(make_docs([])).count() == 0


def test_no_python_in_the_plan(spark, make_docs, capsys):
    ss.shuffled(make_docs(["a", "b"])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
