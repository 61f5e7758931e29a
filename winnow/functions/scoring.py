"""Document scoring expressions: quality score, timestamp parsing, lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, VariantType

from winnow.functions import text as tx

# Source-name weights, tested as substrings in this order;
# the first match counts, no match scores the default.
SOURCE_WEIGHTS = [
    ("wikipedia", 0.9),
    ("news", 0.8),
    ("book", 0.8),
    ("academic", 0.9),
    ("government", 0.7),
    ("social", 0.3),
    ("web", 0.4),
    ("forum", 0.2),
]
DEFAULT_SOURCE_SCORE = 0.1
# Metadata fields whose presence adds to the score.
METADATA_FIELDS = ["source", "domain", "lang", "tokens"]
# Accepted timestamp layouts (strings), tried in this order.
# One-letter fields take padded and unpadded numbers.
TIMESTAMP_FORMATS = ["yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d"]
HANGUL_SCORE_CLASS = "[가-힯]"


def _truthy(name: str, cols: dict) -> Column:
    if name not in cols:
        return F.lit(False)
    c = F.col(name)
    t = cols[name]
    if t.startswith("array"):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if t == "string":
        return F.coalesce(c != "", F.lit(False))
    if t == "boolean":
        return F.coalesce(c, F.lit(False))
    return F.coalesce(c != 0, F.lit(False))


def quality_score(columns, text_col: str = "text", source_col: str = "source") -> Column:
    """Heuristic quality in [0, 1.0]: length, source weight, sentence length,
    Hangul share, word diversity and metadata completeness.

    ``columns`` is the frame's ``dtypes`` list or a list of column names
    (then every metadata column is treated as a string)."""
    if columns and isinstance(columns[0], tuple):
        cols = dict(columns)
    else:
        cols = {c: "string" for c in columns}
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = F.length(text)
    score = F.least(n / 1000.0, F.lit(1.0)) * 0.3

    src = F.lower(F.coalesce(F.col(source_col), F.lit(""))) if source_col in cols else F.lit("")
    w = F.lit(DEFAULT_SOURCE_SCORE)
    for name, weight in reversed(SOURCE_WEIGHTS):
        w = F.when(F.instr(src, name) > 0, F.lit(weight * 0.2)).otherwise(w)
    score = score + w

    endings = F.regexp_count(text, F.lit(r"[.!?]"))
    avg_sent = n / F.greatest(endings, F.lit(1))
    sent = (F.when(avg_sent.between(20, 100), F.lit(0.2))
            .when(avg_sent.between(10, 150), F.lit(0.1))
            .otherwise(F.lit(0.0)))
    korean = F.regexp_count(text, F.lit(HANGUL_SCORE_CLASS))
    k_ratio = korean / F.greatest(n, F.lit(1)) * 0.2
    words = F.split(tx.collapse_ws(text), " ")
    nw = F.when(tx.collapse_ws(text) == "", F.lit(0)).otherwise(F.size(words))
    div = F.when(nw > 10, F.size(F.array_distinct(words)) / nw * 0.1).otherwise(F.lit(0.0))
    score = score + F.when(n > 0, sent + k_ratio + div).otherwise(F.lit(0.0))

    filled = sum((_truthy(f, cols).cast("int") for f in METADATA_FIELDS), F.lit(0))
    return score + filled / float(len(METADATA_FIELDS)) * 0.1


def parse_timestamp(c: Column, numeric: bool = False) -> Column:
    """Strings in one of three layouts; numbers are epoch seconds shown in
    the session time zone; anything else is null."""
    if numeric:
        return F.timestamp_seconds(c).cast("timestamp_ntz")  # wall clock in the session time zone
    s = c.cast("string")
    # wall-clock values (TIMESTAMP_NTZ): independent of session/client zones
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in TIMESTAMP_FORMATS]).cast("timestamp_ntz")


def parse_timestamp_variant(v: Column) -> Column:
    """A parsed JSON value: numbers are epoch seconds, strings are read by
    layout, anything else is null."""
    number = F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return F.when(number, parse_timestamp(F.try_variant_get(v, "$", "double"), numeric=True)) \
            .otherwise(parse_timestamp(F.try_variant_get(v, "$", "string")))


def parse_timestamp_col(df, name: str) -> Column:
    t = df.schema[name].dataType
    if isinstance(t, VariantType):
        return parse_timestamp_variant(F.col(name))
    return parse_timestamp(F.col(name), numeric=isinstance(t, NumericType))
