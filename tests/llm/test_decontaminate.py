import random
from collections import Counter

import numpy as np
import pytest

from winnow.llm import decontaminate as dc


def shingles(words, k):
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def best_similarity(text, item):
    """Best weighted Jaccard over all item-sized windows, by brute force."""
    w, q = dc.words_of((text or "").encode()), dc.words_of((item or "").encode())
    k = min(5, len(q))
    if not q or len(w) < k:
        return 0.0
    a, b = shingles(w, k), Counter(shingles(q, k))
    n, best = sum(b.values()), 0.0
    for s in range(-n + 1, len(a)):
        part = Counter(a[max(0, s):s + n])
        shared = sum((part & b).values())
        if shared:
            best = max(best, shared / (n + sum(part.values()) - shared))
    return best


def prose(rng, n):
    return " ".join("".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_window_hashes_equal_direct_simhash():
    rng = np.random.default_rng(0)
    sh = rng.integers(0, 2**63, 9000, dtype=np.int64).astype(np.uint64)
    for n in (3, 40, 9000):
        seen = {}
        for size, at, fps in dc.window_hashes(sh[:n], np.arange(n, 0, -1), [2, 13, 50]):
            seen.setdefault(size, []).extend(fps.tolist())
            assert at.tolist() == list(range(at[0], at[0] + len(at)))
        for size in (2, 13, 50):
            w = min(size, n)
            at = range(n - w + 1) if n < 100 else list(range(0, n - w + 1, 997)) + [4095, 4096, 4097, n - w]
            assert len(seen[size]) == n - w + 1
            assert all(seen[size][i] == dc.simhash(np.ascontiguousarray(sh[i:i + w])) for i in at)


def test_windows_of_texts_laid_end_to_end():
    """Each text's windows are what they are alone, across slices too."""
    rng = np.random.default_rng(2)
    sizes = [1, 4, 7, 40, 300, 4090, 1, 1, 13, 5000]
    texts = [rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) for n in sizes]
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - np.arange(ends[-1])
    got = {}
    for size, at, fps in dc.window_hashes(np.concatenate(texts), room, [4, 13, 260]):
        got.setdefault(size, {}).update(zip(at.tolist(), fps.tolist()))
    for size in (4, 13, 260):
        want = {}
        for t, end in zip(texts, ends.tolist()):
            for _, at, fps in dc.window_hashes(t, np.arange(len(t), 0, -1), [size]):
                want |= dict(zip((at + end - len(t)).tolist(), fps.tolist()))
        assert got[size] == want and len(want) == sum(max(1, n - size + 1) for n in sizes)


def test_index_finds_all_within_radius():
    rng = np.random.default_rng(1)
    stored = rng.integers(0, 2**63, 50, dtype=np.int64).astype(np.uint64)
    probes = []
    for f in stored:
        for flips in (0, 1, 5, 11, 12, 20):
            p = int(f)
            for b in rng.choice(64, flips, replace=False):
                p ^= 1 << int(b)
            probes.append(p)
    probes = np.array(probes, np.uint64)
    got = set(zip(*(x.tolist() for x in dc.HammingIndex(stored).probe(probes))))
    near = np.argwhere(np.bitwise_count(probes[:, None] ^ stored[None, :]) <= dc.RADIUS)
    assert got == set(map(tuple, near.tolist()))


def test_query_matches_brute_force(spark):
    from winnow.llm.queries import op7_simhash_decontamination
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    marks = {i: set(shingles(dc.words_of(t.encode()), 5)) for i, t in items.items()}
    want = {}
    for d, t in docs.items():
        own = set(shingles(dc.words_of(t.encode()), 5))
        for i in items:
            if own & marks[i] and (s := best_similarity(t, items[i])) >= 0.8:
                want[d, i] = s
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in op7_simhash_decontamination(spark, sf).collect()}
    assert want and set(got) == set(want)
    assert all(got[k] == pytest.approx(want[k]) for k in got)


def test_found_and_clean(spark, make_docs):
    rng = random.Random(3)
    items = [prose(rng, n) for n in (3, 6, 12, 25, 60, 200)]
    pad = lambda: prose(rng, rng.randrange(0, 80))
    planted = [f"{pad()} {q.upper() if i % 2 else q.replace(' ', ', ')} {pad()}" for i, q in enumerate(items)]
    edge = [q.split(" ", 1)[1] if len(q.split()) > 30 else q for q in items]  # first word lost
    clean = [prose(rng, 300) for _ in range(20)]
    texts = planted + edge + clean + [None, "", "x " * 60000 + items[3]]
    docs = make_docs(texts, item_id=["q"] * len(texts), similarity=["r"] * len(texts))
    bench = spark.createDataFrame([*enumerate(items), (6, None), (7, ""), (8, items[2])], "item_id bigint, text string")
    got = {}
    for r in dc.contaminated(docs, bench).collect():
        got.setdefault(r["doc_id"], {})[r["item_id"]] = r["similarity"]
    for i in range(6):
        assert got[i][i] == 1.0 and got[6 + i][i] >= 0.8
    assert got[2][8] == 1.0  # a repeated item is reported under both ids
    assert all(i not in got for i in range(12, 34)) and got[34][3] == 1.0
    kept = dc.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(12, 34))


def test_empty_and_null(spark, make_docs, monkeypatch):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight")], "item_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = make_docs(["one two three four five six seven eight", "other"], ids=[None, 2])
    assert [(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, bench).collect()] == [(None, 1)]
    assert [r["doc_id"] for r in dc.drop_contaminated(docs, bench).collect()] == [2]  # by its own text, not by its id
    assert dc.drop_contaminated(docs, none).count() == 2
    assert dc.contaminated(docs, none).count() == 0 and dc.contaminated(make_docs([]), bench).count() == 0
    many = spark.createDataFrame([(i, f"a{i} b{i} c{i} d{i} e{i} f{i}") for i in range(40)], "item_id bigint, text string")
    texts = [f"x y a{i} b{i} c{i} d{i} e{i} f{i} z" for i in range(40)]
    monkeypatch.setattr(dc, "ITEM_BYTES", 200)  # several passes find the same
    assert {(r["doc_id"], r["item_id"]) for r in dc.contaminated(make_docs(texts), many).collect()} == {(i, i) for i in range(40)}


def edited(rng, words, kind):
    """A copy of an item with about as many edits as a similarity of 0.8 allows."""
    w = list(words)
    for _ in range(max(1, len(w) // 50)):
        at = {"middle": len(w) // 2, "ends": rng.choice([0, len(w) - 1])}.get(kind, rng.randrange(len(w)))
        if kind == "drop":
            del w[at]
        elif kind == "insert":
            w.insert(at, prose(rng, 1))
        else:
            w[at] = prose(rng, 1)
    return w


def test_recall_of_edited_copies():
    """Against brute force: exact copies are all found, edited ones at 0.8 or
    more nearly all, nothing else is, and similarities are exact."""
    rng = random.Random(11)
    items = [prose(rng, n).split() for n in [*range(15, 60, 2), 59, 59, 90, 140]]
    items += [(prose(rng, 6).split() * 8)[:n] for n in (20, 45)]  # shingles that repeat
    index = dc.Items([(i, " ".join(w).encode()) for i, w in enumerate(items)])
    table, copies, caught, at_limit = dc.WordHashes(), 0, 0, 0
    for kind in ("middle", "ends", "anywhere", "drop", "insert"):
        for i, w in enumerate(items):
            for pad in (0, 40):
                text = " ".join([prose(rng, pad), *edited(rng, w, kind), prose(rng, pad)])
                want = best_similarity(text, " ".join(w))
                got = {m: v[2] for m, v in index.matches([text.encode()], table)[0].items()}
                assert set(got) <= {i} and (not got or (want >= 0.8 and got[i] == pytest.approx(want)))
                copies += want >= 0.8
                caught += bool(got)
                at_limit += 0.8 <= want < 0.9
    assert at_limit > 60 and caught >= 0.95 * copies, (caught, copies)


def test_rows_of_one_id_are_judged_apart(spark, make_docs):
    item = "one two three four five six seven eight"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = make_docs([item, "clean text", None, item], ids=[5, 5, 5, None])
    assert sorted(str(r["text"]) for r in dc.drop_contaminated(docs, bench).collect()) == ["None", "clean text"]
