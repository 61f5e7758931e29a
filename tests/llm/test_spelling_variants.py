import random
import re
import zlib
from collections import Counter

import pytest

from winnow.llm import spelling_variants as sv

SF = "/root/testdata/sf0.001"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(words, ratio=5):
    """word -> (n, n_near, form, form_n, root) by comparing all pairs."""
    out = {}
    for w, n in words.items():
        others = [(-k, x) for x, k in words.items() if near(w, x)]
        best = min(others) if others else (0, None)
        has = others and -best[0] >= ratio * n
        out[w] = [n, len(others), best[1] if has else None, -best[0] if has else None, w]
    for w in out:
        while out[out[w][4]][2]:
            out[w][4] = out[out[w][4]][2]
    return {w: tuple(v) for w, v in out.items()}


def vocabulary(rng, letters, sizes, many):
    words = set()
    for _ in range(many):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(*sizes)))
        words.add(w)
        for _ in range(rng.randint(0, 3)):
            i, op = rng.randrange(len(w)), rng.randrange(3)
            words.add(w[:i] + ("", rng.choice(letters), rng.choice(letters))[op] + w[i + (op < 2):])
    return sorted(w for w in words if len(w) >= sizes[0])


@pytest.mark.parametrize("letters,sizes", [("a", (6, 20)), ("ab", (6, 9)), ("abc", (2, 5)), ("abcdeéÿ", (6, 14)), ("ab", (30, 80))])
def test_index_finds_exactly_the_near_words(letters, sizes):
    rng = random.Random(len(letters) * 100 + sizes[0])
    for _ in range(25):
        words = vocabulary(rng, letters, sizes, rng.randint(1, 40))
        rng.shuffle(words)
        searches = [(w, s) for w in words for s in ("left", "right")]
        got = sorted((searches[i][0], words[j]) for i, j in sv.near_words(words, searches))
        assert got == sorted((a, b) for a in words for b in words if a != b and near(a, b))


def test_the_two_directions_stay_in_step():
    """An interval extended to either side holds as many places as the pattern has."""
    import numpy as np
    words = ["banana", "bandana", "ananas", "cabana"]
    index = sv.Index(words)
    text = "$" + "$".join(words) + "$"
    for a in {w[i:j] for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1)}:
        for order in (range(len(a) - 1, -1, -1), range(len(a))):
            one, two = (index.left, index.right) if order.step < 0 else (index.right, index.left)
            lo, far, size = np.array([0]), np.array([0]), np.array([index.size])
            for k in order:
                c = np.array([index.code[a[k]]])
                far = far + one.smaller(c, lo + size) - one.smaller(c, lo)
                lo, size = one.step(c, lo, size)
            places = {m.start() for m in re.finditer(f"(?={a})", text)}
            left, right = (lo, far) if order.step < 0 else (far, lo)
            assert set(index.left.suffix[left[0]:left[0] + size[0]].tolist()) == places
            n = len(text)
            assert {n - p - len(a) for p in index.right.suffix[right[0]:right[0] + size[0]].tolist()} == places


@pytest.mark.parametrize("shard_letters", [1 << 18, 300, 40])
def test_groups_match_all_pairs_in_any_sharding(spark, shard_letters):
    rng = random.Random(5)
    words = {w: rng.choice((5, 6, 30, 200, 200, 1500)) for w in vocabulary(rng, "abcdefgh", (6, 9), 60)}
    words |= {"stress" + a + b: 7 for a in "abcdefghij" for b in "klmnopqrst"}  # one half that very many share
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sv.group_variants(df, shard_letters=shard_letters).collect()
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == grouped(words)
    assert len(got) == len(words)


def test_query_against_all_pairs(spark):
    from winnow.llm.queries import op11_fm_variants
    count = Counter()
    low = str.maketrans(sv.UPPER, sv.LOWER)
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for run in re.findall("[a-zÀ-ÿ]+", (r["text"] or "").translate(low)):
            h = zlib.crc32(f"{r['doc_id']}:{run}".encode())
            count[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    rows = op11_fm_variants(spark, SF).collect()
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows} == grouped(words)


def test_edge_cases(spark, make_docs):
    texts = [None, "", "12 !", "x" * 100_000, "Straße " * 5, "STRAßE strasse Strasse", "Àbcdefg àbcdefg " * 5, "Straße", "Straße"]
    docs = make_docs(texts, ids=[1, 2, 3, 4, 5, None, None, 7, 7], word=["w"] * 9, n=["1"] * 9, shard=["s"] * 9)
    got = {r["word"]: (r["n"], r["n_near"], r["form"]) for r in sv.spelling_variants(docs).collect()}
    assert got == {"straße": (8, 0, None), "Àbcdefg".translate(str.maketrans(sv.UPPER, sv.LOWER)): (5, 1, None), "àbcdefg": (5, 1, None)}
    assert sv.spelling_variants(make_docs([])).count() == 0
    long = {"x" * 3000: 5, "x" * 2999: 50, "x" * 3001: 50}
    rows = sv.group_variants(spark.createDataFrame(list(long.items()), "word string, n long")).collect()
    assert {r["word"]: (r["n_near"], r["form"]) for r in rows} == {"x" * 3000: (2, "x" * 2999), "x" * 2999: (1, None), "x" * 3001: (1, None)}
