import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from winnow.llm import period_runs as pr

SF = "/root/testdata/sf0.001"


def brute(words):
    """(start, end, period) of all runs, period by period."""
    ids, n, out = {}, len(words), {}
    a = np.array([ids.setdefault(w, len(ids)) for w in words], int)
    for q in range(1, n // 4 + 1):
        eq = np.r_[False, a[:-q] == a[q:], False]
        edge = np.flatnonzero(eq[1:] != eq[:-1])
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e + q - s >= max(6, 4 * q):
                out.setdefault((s, e + q), q)
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def document(rng):
    n, k = rng.choice((0, 1, 5, 8, 20, 60, 200)), rng.choice((1, 2, 3, 8, 50))
    w = [b"%d" % rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a = rng.randrange(n)
        p, b = 1 + rng.randrange(max(1, (n - a) // 3 + 1)), rng.randint(a, n)
        w = [w[a + (i - a) % p] if a <= i < b else w[i] for i in range(n)]
    return w


def test_runs_match_brute_force():
    rng = random.Random(12)
    for _ in range(400):
        docs = [document(rng) for _ in range(rng.randint(1, 6))]
        got = [[tuple(r) for r in rows.tolist()] for rows in pr.document_runs(docs)]
        assert got == [brute(d) for d in docs], docs


@pytest.mark.parametrize("period", [1, 2, 63, 64, 65, 700])
def test_long_runs_behind_the_strided_periods(period):
    rng = random.Random(period)
    body = [b"%d" % rng.randrange(40) for _ in range(period)]
    words = [b"a", b"b"] * 20 + body * 7 + body[:period // 2] + [b"z"] + [b"%d" % rng.randrange(40) for _ in range(500)]
    got = [tuple(r) for r in pr.document_runs([words])[0].tolist()]
    assert got == brute(words) and any(q == period for _, _, q in got)


def test_grammar_extensions():
    rng = random.Random(3)
    for _ in range(200):
        s = np.array([rng.randrange(rng.choice((1, 2, 4))) for _ in range(rng.randint(1, 120))])
        g, n = pr.Grammar(s), len(s)
        at = np.sort(np.array([[rng.randrange(n + 1), rng.randrange(n + 1)] for _ in range(30)]), axis=1)
        x, y = at[at[:, 0] < at[:, 1]].T
        for i, j, r, left in zip(x.tolist(), y.tolist(), g.extend(x, y).tolist(), g.extend(x, y, back=True).tolist()):
            k = 0
            while j + k < n and s[i + k] == s[j + k]:
                k += 1
            m = 0
            while i - m > 0 and s[i - m - 1] == s[j - m - 1]:
                m += 1
            assert (r, left) == (k, m)


def test_a_long_repeat_needs_few_levels():
    """Blocks are one rule whatever their length, so a text of one word is two levels."""
    assert len(pr.Grammar(np.zeros(100_000, int)).sym) <= 3
    rng = random.Random(4)
    assert len(pr.Grammar(np.array([rng.randrange(1000) for _ in range(20_000)])).sym) < 80


def test_query(spark):
    from winnow.llm.queries import op12_recompression_runs
    want = {}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = re.findall(rb"[^\x20\x09-\x0D]+", (r["text"] or "").encode())
        n, h = len(w), zlib.crc32(str(r["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute(w)
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        best = min(runs, key=lambda x: (-(x[1] - x[0]) / x[2], x[0], x[2]), default=None)
        want[r["doc_id"]] = (
            len(runs), *((best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{e - s},{q}\n" for s, e, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest())
    rows = op12_recompression_runs(spark, SF).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)
    assert sum(v[0] > 0 for v in want.values()) > 5


def test_edge_cases(spark, make_docs):
    texts = [None, "", " \n\t", "a " * 6, "a a a a a", "x y " * 6, "a b " * 4 + "\x0b\x0c a", "la " * 300_000, "a " * 6]
    docs = make_docs(texts, ids=[1, 2, 3, 4, 5, 6, None, 8, 4], runs=["r"] * 9, start=["s"] * 9, collapsed=["c"] * 9)
    rows = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in pr.find(docs).collect()]
    assert sorted(rows, key=repr) == sorted([
        (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 6, [(0, 6, 1)], "a"), (4, 6, [(0, 6, 1)], "a"), (5, 5, [], "a a a a a"),
        (6, 6, [(0, 6, 1)], "x y"), (None, 9, [(0, 9, 2)], "a b"), (8, 300_000, [(0, 300_000, 1)], "la")], key=repr)
    assert pr.find(make_docs([])).count() == 0
    assert pr.with_cycles(make_docs([None, "", "x"], ids=[None, 0, 1])).count() == 3


def test_strongest_compares_exactly():
    rows = np.array([[0, 9, 2], [20, 29, 2], [40, 53, 3]])
    assert pr.strongest(rows) == (0, 9, 2)
    assert pr.strongest(rows[:0]) is None
