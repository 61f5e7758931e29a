import hashlib
import random

import numpy as np
import pytest

from winnow.llm import densified_minhash as dm

SF = "/root/testdata/sf0.001"


def low(text):
    return dm.low_bits(dm.shingle_hashes(dm.word_hashes(text.encode(), dm.WordHashes())))


def jaccard(a, b):
    def sh(t):
        w = t.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    a, b = sh(a), sh(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_estimate_is_close_to_jaccard():
    rng = random.Random(1)
    errors = []
    for _ in range(120):
        n = rng.choice([8, 30, 120, 700, 3000])
        a = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        b = list(a)
        for _ in range(int(n * rng.choice([0, 0.02, 0.1, 0.3]))):
            b[rng.randrange(n)] = f"v{rng.randrange(10**6)}"
        a, b = " ".join(a), " ".join(b)
        errors.append(dm.likeness(low(a), low(b)) - jaccard(a, b))
    assert np.abs(errors).mean() < 0.03 and abs(np.mean(errors)) < 0.015 and np.abs(errors).max() < 0.2


def test_densification_fills_every_bin_from_a_full_one():
    raw = dm.minima(np.array([5, 2**63 + 9], np.uint64), 64)
    out = dm.densify(raw)
    assert set(out.tolist()) == {5, 2**63 + 9} and (out[raw != dm.EMPTY] == raw[raw != dm.EMPTY]).all()


@pytest.mark.parametrize("text", ["", "one", "a b c d e f g", "x " * 5000])
def test_packed_round_trip(text):
    fp = dm.packed(low(text))
    assert dm.likeness_of(fp, fp) == 1.0
    assert len(fp) == (0 if not text else dm.BINS * dm.BITS // 4)
    assert dm.likeness_of(fp, dm.packed(low("completely other words in here"))) < 0.15


def test_likeness_of_packed_equals_likeness():
    a, b = "a b c d e f g h i j " * 3, "a b c d e f g x i j " * 3
    assert dm.likeness_of(dm.packed(low(a)), dm.packed(low(b))) == dm.likeness(low(a), low(b))


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), dm.packed(low(t)), dm.packed(low(e)),
                    dm.likeness(low(t), low(e)), dm.likeness(low(t), low(nxt))))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *r[1:])


def test_query_matches_brute_force(spark):
    from winnow.llm.queries import op4_densified_minhash
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r) for r in op4_densified_minhash(spark, SF).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("rows", [
    [], [(1, "alone in here")], [(2, None), (1, ""), (3, "x y z")], [(1, "a b"), (1, "a b"), (1, "c d"), (2, "e f")],
    [(None, "p q r"), (None, "s t"), (5, "u v w x y z"), (-7, "éé ñ")], [(i, f"w{i} " * 50) for i in range(60)],
    [(1, "long text " * 30000), (2, "b")]])
def test_edge_cases(spark, make_docs, rows):
    docs = make_docs([t for _, t in rows], ids=[d for d, _ in rows], bucket=["x"] * len(rows), extra=["y"] * len(rows)) if rows else make_docs([])
    got = [tuple(r) for r in dm.compare_neighbours(docs).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert sorted((r["doc_id"] or 0, r["fingerprint"]) for r in dm.fingerprint(docs).collect()) == sorted((r[0] or 0, r[3]) for r in got)
