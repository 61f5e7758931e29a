import zlib
from array import array

import numpy as np
import pytest
from tokenizers import Tokenizer

from winnow.llm import best_fit, token_files
from winnow.llm.tokenizing import Encoder, vocabulary

SF = "/root/testdata/sf0.001"
TRICKY = ["", " ", "a", "  two  spaces ", "tab\tand\nnew\n\nlines \n x", "don't WE'LL it's 's", "naïve Café ÉÑÜß", "1234 5.6 7",
          "x y z", "a b", "ʼn ǅ İstanbul ΑΣ ς", "é combining", "日本語 テスト", "emoji 🙂 end", "<|endoftext|> hi",
          "a<|startoftext|>b", "trailing\n\n", "\n\n\nlead", "dots... end?! (paren)", "A.B,C;D:E", "\x1c odd \x85 x", "ﬁ ª º", "a\x00b"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_chunked_ids_equal_the_library(spark, name, monkeypatch):
    tok, enc = Tokenizer.from_file(vocabulary(name)), Encoder(vocabulary(name))
    texts = TRICKY + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for t in texts:
        assert enc.encode(t) == array("I", tok.encode(t, add_special_tokens=False).ids).tobytes(), t[:80]
    monkeypatch.setattr("winnow.llm.tokenizing.SLICE", 7)
    for table in (enc.words, enc.chunks, enc.after_blank):
        table.limit = 50
    for t in texts[:60]:
        assert enc.encode(t) == array("I", tok.encode(t, add_special_tokens=False).ids).tobytes(), t[:80]


def ids_of(name, text):
    return Tokenizer.from_file(vocabulary(name)).encode(text or "", add_special_tokens=False).ids + [2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_query_equals_plain_encoding(spark):
    from winnow.llm.queries import op8_token_files
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    tok, start, want = Tokenizer.from_file(vocabulary("word_bpe_49k.json")), 0, {}
    for d, t in docs:
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        want[d] = (start, len(ids), crc(ids))
        start += len(ids)
    got = op8_token_files(spark, SF).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)


def test_token_files_edge_cases(spark, make_docs, tmp_path):
    texts = [None, "", "same", "same", "b " * 60000, "z"]
    docs = make_docs(texts, ids=[4, 9, 7, 7, None, -3], start=["x"] * 6, bucket=["y"] * 6)
    got = sorted(token_files.token_files(docs, vocabulary("word_bpe_49k.json"), 2, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, -3, 4, 7, 7, 9]
    assert [r["n_tokens"] for r in got] == [60001, 2, 1, 2, 2, 1]
    assert [r["start"] for r in got] == [0, 60001, 60003, 60004, 60006, 60008]
    assert token_files.token_files(make_docs([]), vocabulary("word_bpe_49k.json"), 2, str(tmp_path / "e")).count() == 0


def test_ids_beyond_two_bytes_are_kept(spark, make_docs, tmp_path):
    from tokenizers import models
    v = vocabulary("word_bpe_49k.json")
    ids = ids_of("word_bpe_49k.json", "some words")[:-1]
    docs = make_docs(["some words", None])
    got = sorted(token_files.token_files(docs, v, 70000, str(tmp_path / "t")).collect(), key=lambda r: r["start"])
    assert [r["ids_crc32"] for r in got] == [crc([*ids, 70000]), crc([70000])]
    large = str(tmp_path / "large.json")
    Tokenizer(models.WordLevel({f"w{i}": i for i in range(65537)}, "w0")).save(large)
    assert [token_files.id_width(*x) for x in ((v, 2), (v, 65535), (v, 65536), (large, 2))] == [2, 2, 4, 4]
    for end_id, width in ((65536, 2), (1 << 32, None), (-1, None)):
        with pytest.raises(ValueError):
            token_files.write_token_files(docs, str(tmp_path / "n"), v, end_id, width)


def check_packing(rows, texts, size=1024):
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for d, t in texts.items():
        ids, at = ids_of("byte_bpe_50k.json", t), 0
        own = sorted(pieces[d], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // size) and all(r["length"] == size for r in own[1:])
        for r in own:
            assert r["start"] == at and r["ids_crc32"] == crc(ids[at:at + r["length"]])
            at += r["length"]
        assert at == len(ids)
    for places in bins.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= size
    return len(bins)


def test_packing_query(spark):
    from winnow.llm.queries import op9_best_fit
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_best_fit(spark, SF).collect()
    used = check_packing(rows, texts)
    assert used <= 1.03 * sum(r["length"] for r in rows) / 1024 + 1


def test_packing_many_small_splits_are_merged(spark, make_docs):
    texts = [f"w{i} " * (1 + i % 90) for i in range(400)]
    docs = make_docs(texts, sequence_id=["x"] * 400).repartition(40)
    rows = best_fit.pack(docs, vocabulary("byte_bpe_50k.json"), 2).collect()
    used = check_packing(rows, dict(enumerate(texts)))
    assert used <= 1.05 * sum(r["length"] for r in rows) / 1024 + 1


def test_packing_edge_cases(spark, make_docs):
    v = vocabulary("byte_bpe_50k.json")
    docs = make_docs([None, "", "a b c", "word " * 5000], ids=[1, 2, 3, 4])
    rows = best_fit.pack(docs, v, 2).collect()
    check_packing(rows, {1: None, 2: "", 3: "a b c", 4: "word " * 5000})
    assert best_fit.pack(make_docs([]), v, 2).count() == 0
    null_id = best_fit.pack(make_docs(["a", "a"], ids=[None, None]), v, 2).collect()
    assert len(null_id) == 2 and null_id[0]["doc_id"] is None
    with_ids = best_fit.pack(docs, v, 2, with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in with_ids)


def test_packer_is_best_fit_with_bounded_space():
    rng = np.random.default_rng(3)
    items = rng.integers(1, 101, 3000).tolist()
    p, frees, limit = best_fit.Packer(100, 20), {}, 20
    for n in items:
        b, at = p.put(n)
        fit = [f for f in frees.values() if f >= n]
        if fit:
            assert frees[b] == min(fit) and at == 100 - frees[b]
            frees[b] -= n
        else:
            assert b not in frees and at == 0
            frees[b] = 100 - n
        if not frees[b]:
            del frees[b]
        if len(frees) > limit:  # the fullest closes; ties are alike, take the packer's
            low = min(frees.values())
            still = dict(p.rests())
            gone = [x for x, f in frees.items() if x not in still]
            assert len(gone) == 1 and frees[gone[0]] == low
            del frees[gone[0]]
    assert {b: 100 - u for b, u in p.rests()} == frees
