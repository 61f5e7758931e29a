import numpy as np

from winnow.llm import gru_langid as gl


def test_gradients_match_differences(monkeypatch):
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in gl.init(3).items()}
    x = rng.integers(97, 120, (7, 5)).astype(np.intp)
    y, w = rng.integers(0, 3, 5), np.ones(5)
    f32 = {k: v.astype(np.float32) for k, v in p.items()}
    _, g = gl.gradients(f32, x, y, w)
    for k in p:
        flat = np.abs(g[k]).ravel()
        i = np.unravel_index(int(flat.argmax()), g[k].shape)
        eps = 1e-2
        up, down = ({n: v.copy() for n, v in f32.items()} for _ in range(2))
        up[k][i] += eps
        down[k][i] -= eps
        num = (gl.gradients(up, x, y, w)[0] - gl.gradients(down, x, y, w)[0]) / (2 * eps)
        assert abs(num - g[k][i]) < 0.05 * abs(num) + 2e-3, (k, num, g[k][i])


def test_prediction_reads_every_byte_and_pools_by_position():
    p = gl.init(2)
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 123, n).astype(np.uint8)) for n in (1, 127, 128, 129, 1000)]
    prob = gl.predict(p, texts)
    assert np.allclose(prob.sum(axis=1), 1, atol=1e-4)
    one = np.concatenate([gl.predict(p, [t]) for t in texts])
    assert np.allclose(prob, one, atol=1e-5)
    changed = gl.predict(p, [texts[4][:-1] + b"\xff"])
    assert not np.allclose(changed, prob[4])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    from winnow.llm.queries import op3_gru_langid
    import zlib
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op3_gru_langid(spark, sf).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"] and r["lang_pred"] != "und"]
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_edge_cases(spark, make_docs):
    texts = ["der hund und die katze " * 20, "the dog and the cat " * 20] * 30 + [None, "", "123 !?", "ein sehr langer text " * 5000]
    docs = make_docs(texts, lang=["de", "en"] * 30 + [None, "de", "en", None], score=["x"] * 64, held_out=["y"] * 64)
    got = {r["doc_id"]: r for r in gl.identify(docs).collect()}
    assert len(got) == 64
    assert [got[i]["lang_pred"] for i in (60, 61, 62)] == ["und"] * 3 and got[60]["score"] == 0
    assert got[63]["lang_pred"] == "de"
    assert all(got[i]["lang_pred"] == ("en" if i % 2 else "de") for i in range(60))
    unlabelled = make_docs(["hello there"] * 3, lang=[None] * 3)
    assert {r["lang_pred"] for r in gl.identify(unlabelled).collect()} == {"und"}
    assert gl.identify(make_docs([], lang=[]) if False else make_docs(["a"], lang=["en"]).where("false")).count() == 0
    null_id = make_docs(["hello there", "hello there"], ids=[None, None], lang=["en", "en"])
    assert [r["held_out"] for r in gl.identify(null_id).collect()] == [False, False]


def test_every_label_is_learned_from_a_bounded_sample(spark, make_docs, monkeypatch):
    n, each = 140, 12
    docs = make_docs([f"words of tongue {i} " * 20 for i in range(n)] * each, lang=[f"l{i:03d}" for i in range(n)] * each)
    seen = []
    monkeypatch.setattr(gl, "train", lambda windows, labels, langs: seen.append(labels) or {})
    assert gl.fit(docs)[0] == [f"l{i:03d}" for i in range(n)]
    assert set(seen[0].tolist()) == set(range(n))
    big = make_docs(["one two three"] * 3000, lang=["a", "b", "c"] * 1000)
    monkeypatch.setattr(gl, "WINDOWS", 300)
    assert gl.fit(big)[0] == ["a", "b", "c"]
    assert (np.bincount(seen[1]) > 50).all() and len(seen[1]) < 450
