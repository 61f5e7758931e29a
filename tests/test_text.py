"""Literal fixtures for the text functions (FIXTURES.md A4/A5)."""

from pyspark.sql import functions as F

from winnow.functions import scoring
from winnow.functions import text as tx


def one(spark, expr, value, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first().x


def test_word_ngrams_quirk(spark):
    g = one(spark, tx.word_ngrams("t", 3), "바다 위로 달이 저녁입니다")
    assert len(g) == 3
    assert g[0] == "바다 위로 달이"
    assert g[1] == "위로 달이 저녁입니다"


def test_word_ngrams_short_text(spark):
    assert one(spark, tx.word_ngrams("t", 5), "달이 뜬다") == ["달이 뜬다"]
    assert one(spark, tx.word_ngrams("t", 5), "") == [""]


def test_word_ngrams_lower_and_windows(spark):
    g = one(spark, tx.word_ngrams("t", 2), "A b  C\nd")
    assert g == ["a b", "b c", "c d"]


def test_jamo_ngrams(spark):
    g = one(spark, tx.jamo_ngrams("t", 3), "가나다")
    assert len(g) == 4 and g[0] == "가ᄂ"
    assert one(spark, tx.jamo_ngrams("t", 3), "각") == ["각"]
    assert len(one(spark, tx.jamo_ngrams("t", 3), "한a 글")) == 6
    # non-Hangul characters are kept as they are (no lower-casing)
    assert one(spark, tx.jamo_ngrams("t", 3), "AbC") == ["AbC"]


def test_collapse_ws_matches_python(spark):
    s = "  a b　c\x1cd\n\te  "
    assert one(spark, tx.collapse_ws("t"), s) == " ".join(s.split())


def test_nfkc(spark):
    import unicodedata
    s = "ｈｅｌｌｏ ① ció"
    assert one(spark, tx.preprocess("t"), s) == " ".join(unicodedata.normalize("NFKC", s).split())


def test_contains_korean(spark):
    df = spark.createDataFrame([("abc",), ("한글",), ("ㄱ",), (None,)], "t string")
    assert [r.x for r in df.select(tx.contains_korean("t").alias("x")).collect()] == [False, True, True, False]


def plain_quality(text, source, filled):
    """The rule, restated in Python."""
    import re
    weight = next((w for n, w in [("wikipedia", 0.9), ("news", 0.8), ("forum", 0.2)] if n in source), 0.1)
    score = min(len(text) / 1000, 1) * 0.3 + weight * 0.2
    mean = len(text) / max(len(re.findall("[.!?]", text)), 1)
    score += 0.2 if 20 <= mean <= 100 else 0.1 if 10 <= mean <= 150 else 0
    score += len(re.findall("[가-힯]", text)) / max(len(text), 1) * 0.2
    words = text.split()
    score += len(set(words)) / len(words) * 0.1 if len(words) > 10 else 0
    return score + filled / 4 * 0.1


def test_quality_scores(spark):
    rows = [("등대 불빛이 바다를 비춘다. 배는 천천히 항구로 들어온다.", "ko.wikipedia", "coast", "ko"),
            ("고양이가 지붕 위에서 하품을 한다", "local news", None, None),
            ("one two three four five six seven eight nine ten ten ten", "a forum", None, "en"), ("", "news", None, None)]
    df = spark.createDataFrame(rows, "text string, source string, domain string, lang string")
    s = [r.s for r in df.select(scoring.quality_score(df.dtypes).alias("s")).collect()]
    want = [plain_quality(t, src, sum(x is not None for x in (src, d, la))) for t, src, d, la in rows[:3]] + [0.16 + 0.025]
    assert [round(x, 9) for x in s] == [round(x, 9) for x in want]


def test_parse_timestamp(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02T03:04:05",), ("2024-01-02",), ("2024-1-2 3:4:5",), ("2024-1-2",), ("junk",), (None,)], "t string")
    got = [r.x for r in df.select(scoring.parse_timestamp(F.col("t")).alias("x")).collect()]
    assert [g.isoformat() if g else None for g in got] == [
        "2024-01-02T03:04:05", "2024-01-02T03:04:05", "2024-01-02T00:00:00", "2024-01-02T03:04:05", "2024-01-02T00:00:00", None, None]


def test_jamo_batch_works_in_bounded_slices():
    """Rows of any size, nulls among them: slices stay small and the result is
    that of every row alone."""
    import pyarrow as pa
    texts = pa.array(["각a", None, "", "가" * 700_000, "plain"] + ["한글 text"] * 200_000)
    assert max(len(s) for s in tx.text_slices(texts)) < 120_000 and sum(len(s) for s in tx.text_slices(texts)) == len(texts)
    got = tx._jamo_batch(texts)
    assert len(got) == len(texts) and got[:3].to_pylist() == tx._jamo_batch(texts[:3]).to_pylist() == ["각a", None, ""]
    assert got[3].as_py() == "가" * 700_000 and got[5].as_py() == got[-1].as_py() == tx._jamo_batch(pa.array(["한글 text"]))[0].as_py()
    assert len(tx._jamo_batch(pa.array([], pa.string()))) == 0


def test_strip_takes_the_white_space_of_python_off_both_ends(spark):
    """Every white-space character and none of its neighbours, without a scan of the text by a pattern."""
    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    near = [chr(ord(c) + d) for c in spaces for d in (-1, 1) if not chr(ord(c) + d).isspace() and ord(c) + d > 0]
    rows = [f"{c}a {c} b{c}{c}" for c in spaces + near] + ["", "".join(spaces), "\u3000x\n", "\u200b x", None]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, s string").select("i", tx.strip_ws("s").alias("s"))
    assert {r.i: r.s for r in df.collect()} == {i: None if s is None else s.strip() for i, s in enumerate(rows)}
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()
