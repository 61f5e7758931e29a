import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from test_decontaminate import best_similarity, prose

import corpus_pipeline as cp
from winnow.llm import common
from winnow.llm.pii_transducer import masked
from winnow.llm.tokenizing import vocabulary


def rows(df):
    return sorted(((r["doc_id"], r["text"], r["lang"]) for r in df.collect()), key=repr)


def test_language_id_judges_each_row_by_its_own_text(spark, make_docs):
    texts = ["der hund und die katze " * 20, "the dog and the cat " * 20] * 30 + ["the dog and the cat", None, "12 !", "", "the dog and the cat"]
    langs = ["de", "en"] * 30 + ["en", "en", "en", None, None]
    docs = make_docs(texts, ids=[*range(60), 60, 60, 61, 62, None], lang=langs)
    got = rows(cp.language_id(spark, docs, ""))
    want = [(i if i < 61 else None, t, la or "en") for i, (t, la) in zip([*range(60), 60, 60, 61, 62, 99], zip(texts, langs))
            if t and re.search("[a-z]", t)]
    assert got == sorted(want, key=repr) and len(got) == 62


def test_language_id_without_labels_keeps_lettered_rows(spark, make_docs):
    docs = make_docs(["one two", None, "12", "", "drei", "drei"], ids=[1, 1, 2, 3, None, None], lang=[None] * 6)
    assert rows(cp.language_id(spark, docs, "")) == sorted([(1, "one two", None), (None, "drei", None), (None, "drei", None)], key=repr)
    assert cp.language_id(spark, docs, "").columns == docs.columns


# ------------------------------------------------------------------ the whole pipeline against plain Python

def fingerprint(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode())
    sh = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def plain_stages(rows, items):
    """Rows (doc_id, text, lang) kept and changed by the four filtering stages, by brute force."""
    kept = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    out = [kept]
    fps = [fingerprint(r[1]) for r in kept]
    group = list(range(len(kept)))
    for i in range(len(kept)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3 and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {}
    for g, r in zip(group, kept):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    gone = {r[0] for g, r in zip(group, kept) if r[0] is not None and r[0] > least[g]}
    out.append([r for r in kept if r[0] is None or r[0] not in gone])
    out.append([r for r in out[-1] if all(best_similarity(r[1], q) < 0.8 for q in items)])
    out.append([(d, masked(t), la) for d, t, la in out[-1]])
    return out


def test_run_and_every_stage_against_plain_python(spark, tmp_path):
    rng = random.Random(21)
    item = prose(rng, 30)
    base = [prose(rng, rng.randint(20, 90)) for _ in range(25)]
    rows = [(i, t, "en") for i, t in enumerate(base)]
    rows += [(100, base[3], "en"), (101, base[3] + " ", "en"), (102, base[4].upper(), None), (3, base[3], "en")]   # copies, a repeated row
    rows += [(110, f"{base[5][:40]} {item} {base[6]}", "en"), (111, item, None), (None, f"{prose(rng, 40)} {item}", "en")]  # benchmark text
    rows += [(120, f"{prose(rng, 20)} write to jane.doe@example.com or +49 151 2345 6789 now", "de"), (None, prose(rng, 15), None)]
    rows += [(130, None, "en"), (131, "", "en"), (132, "12 !", None), (133, "12 !", "en"), (134, "x", None), (135, prose(rng, 3000), "en")]
    docs = spark.createDataFrame([(d, t, la, "src", None if t is None else len(t)) for d, t, la in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    want = plain_stages(rows, [item])
    cur = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for (name, stage), expected in zip(cp.STAGES[:-1], want):
        nxt = stage(spark, cur, str(tmp_path))
        assert nxt.columns == docs.columns, name
        got = nxt.collect()
        key = lambda r: (str(r[0]), r[1])
        assert sorted([(r["doc_id"], r["text"]) for r in got], key=key) == sorted([(d, t) for d, t, _ in expected], key=key), name
        assert all(r["lang"] for r in got) and all(r["n_chars"] == len(r["text"]) for r in got if name == "pii"), name
        cur = common.materialize(nxt, f"test-{name}")
    assert len(want[0]) < len(rows) and len(want[1]) < len(want[0]) and len(want[2]) < len(want[1]) and want[3] != want[2]

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    texts = Counter()
    for d, t, _ in want[-1]:
        texts[d, tuple(tok.encode(t, add_special_tokens=False).ids + [2])] += 1
    pieces = cp.run(spark, str(tmp_path)).collect()
    # every document's tokens, cut only where longer than a sequence, the first piece taking the remainder
    expected = Counter()
    for (d, ids), n in texts.items():
        lo = 0
        for k in range(-(-len(ids) // 1024)):
            hi = lo + (len(ids) - lo - 1) % 1024 + 1
            expected[d, k, lo, hi - lo, zlib.crc32(np.array(ids[lo:hi], "<u4").tobytes())] += n
            lo = hi
    assert Counter((p.doc_id, p.piece, p.start, p.length, p.ids_crc32) for p in pieces) == expected
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in by.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(n for _, n in spans) <= 1024
    total = sum(p.length for p in pieces)
    assert len(by) <= -(-total // 1024) + 3


def test_empty_documents_run_through(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_language_of_the_text_decides_labels_and_sequences(spark, make_docs):
    texts = ["der hund und die katze " * 20, "the dog and the cat " * 20] * 30 + ["the dog and the cat " * 20]
    docs = make_docs(texts, lang=["de", "en"] * 30 + ["de"])  # the last label is wrong
    told = cp.language_id(spark, docs, "")
    by = {r["doc_id"]: r["lang"] for r in told.collect()}
    assert by == {i: ("de", "en")[i % 2] for i in range(60)} | {60: "en"}
    seqs = {}
    for p in cp.packing(spark, told, "").collect():
        seqs.setdefault(p.sequence_id, []).append(p)
    assert all(len({by[p.doc_id] for p in s}) == 1 for s in seqs.values()) and {p.doc_id for s in seqs.values() for p in s} == set(by)
    for s in seqs.values():
        s.sort(key=lambda p: p.offset)
        assert [p.offset for p in s] == [sum(q.length for q in s[:i]) for i in range(len(s))] and sum(p.length for p in s) <= 1024
