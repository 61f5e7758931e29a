"""JSONL parsing, validation and cleaning as column expressions.

Parsing uses ``try_parse_json`` (VARIANT): a NULL result marks a malformed
line.  Documented deviation: lines with duplicate keys or NaN literals are
treated as malformed (Python's parser accepts them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.functions import text as tx

# Required fields and types of the document schema.
REQUIRED_FIELDS = ["text", "source", "lang", "domain"]
DOC_SCHEMA = [("text", "string"), ("tokens", "list[string]"), ("source", "string"),
              ("lang", "string"), ("domain", "categorical")]


def parse(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``_v`` (VARIANT or NULL), ``_blank`` and ``_obj`` flags."""
    v = F.col(value_col)
    parsed = F.try_parse_json(tx.strip_ws(v))
    return lines.select("*",
                        (tx.strip_ws(v) == "").alias("_blank"),
                        parsed.alias("_v")).select(
        "*", F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)).alias("_obj"))


def field(name: str, typ: str = "string") -> Column:
    return F.try_variant_get(F.col("_v"), f"$.{name}", typ)


def has_key(name: str) -> Column:
    """key present (even with a null value) in the parsed object: an absent key
    is SQL NULL, a JSON null is a variant null."""
    return F.try_variant_get(F.col("_v"), f"$.{name}", "variant").isNotNull()


def _is_empty(name: str) -> Column:
    """None, "" or [] (the row validator's notion of empty)."""
    raw = F.try_variant_get(F.col("_v"), f"$.{name}", "variant")
    s = F.try_variant_get(F.col("_v"), f"$.{name}", "string")
    arr_empty = F.coalesce(F.schema_of_variant(raw).startswith("ARRAY") & (F.to_json(raw) == "[]"), F.lit(False))
    is_str = F.coalesce(F.schema_of_variant(raw) == "STRING", F.lit(False))
    return raw.isNull() | F.is_variant_null(raw) | (is_str & (s == "")) | arr_empty


def row_validity(required=REQUIRED_FIELDS) -> tuple[Column, Column]:
    """(ok, reason): not an object -> 'Not a JSON object'; else the first
    required field that is missing or empty."""
    reason = F.lit("")
    for f in reversed(required):
        reason = F.when(_is_empty(f), F.lit(f"Missing or empty field: {f}")).otherwise(reason)
    reason = F.when(~F.col("_obj"), F.lit("Not a JSON object")).otherwise(reason)
    return (reason == ""), reason


def schema_missing(required=REQUIRED_FIELDS) -> Column:
    """All missing fields ('f') and present-but-null/empty-string ('f (empty)'),
    joined by ','; [] counts as present."""
    items = []
    for f in required:
        raw = F.try_variant_get(F.col("_v"), f"$.{f}", "variant")
        s = F.try_variant_get(F.col("_v"), f"$.{f}", "string")
        empty = F.is_variant_null(raw) | (F.coalesce(F.schema_of_variant(raw) == "STRING", F.lit(False)) & (s == ""))
        items.append(F.when(~has_key(f), F.lit(f)).when(empty, F.lit(f"{f} (empty)")))
    return F.array_join(F.array_compact(F.array(*items)), ",")


SAMPLES = 5         # sample documents of a report
LISTED_ERRORS = 100  # line numbers a report lists; ``jsonl_errors`` has all
LISTED_NAMES = 1000  # field names a report lists; ``jsonl_field_names`` has all


def jsonl_errors(lines: DataFrame, value_col: str = "value", order_col: str = "line_no") -> DataFrame:
    """(line number, value, error) of every line that is not JSON."""
    p = parse(lines, value_col)
    return p.where(F.col("_v").isNull() & ~F.col("_blank")).select(
        order_col, value_col, F.lit("JSON parsing failed").alias("error"))


def jsonl_samples(lines: DataFrame, n: int = SAMPLES, value_col: str = "value", order_col: str = "line_no") -> DataFrame:
    """The first ``n`` parseable lines (line number, value)."""
    p = parse(lines, value_col)
    return p.where(F.col("_v").isNotNull() & ~F.col("_blank")).orderBy(order_col).limit(n).select(order_col, value_col)


def jsonl_field_names(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(name, n) of every key of the JSON objects, with the lines that have it."""
    p = parse(lines, value_col)
    keys = F.when(p["_v"].isNotNull() & ~p["_blank"] & p["_obj"], F.json_object_keys(F.to_json(p["_v"])))
    return p.select(F.explode(keys).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def jsonl_report(lines: DataFrame, max_lines: int | None = 100, value_col: str = "value",
                 order_col: str = "line_no") -> DataFrame:
    """One-row format report over the first ``max_lines`` lines of the
    whitespace-stripped content (all lines with ``max_lines=None``).  Error and
    sample lists are the window's first LISTED_ERRORS and SAMPLES lines."""
    from winnow.session import checkpoint_dir
    blank = tx.strip_ws(F.col(value_col)) == ""
    # one pass over the lines, without parsing them, bounds the content
    ends = lines.where(~blank).agg(F.min(order_col).alias("a"), F.max(order_col).alias("b")).first()
    first, last = ends["a"], ends["b"]
    total = last - first + 1 if last is not None else 1
    checked = total if max_lines is None else min(max_lines, total)
    start = first or 0
    win = parse(lines.where((F.col(order_col) >= start) & (F.col(order_col) < start + checked)), value_col)
    if max_lines is not None:  # at most max_lines rows, read by the aggregates below
        checkpoint_dir(lines.sparkSession)
        win = win.checkpoint(eager=True)
    valid = F.col("_v").isNotNull() & ~F.col("_blank")
    bad = F.col("_v").isNull() & ~F.col("_blank")
    rel = (F.col(order_col) - start + 1).alias("_rel")
    keys = F.when(valid & F.col("_obj"), F.json_object_keys(F.to_json(F.col("_v"))))
    text = F.when(valid & F.col("_obj"), F.try_variant_get(F.col("_v"), "$.text", "string"))
    agg = win.agg(
        F.count_if(valid).alias("valid_lines"), F.count_if(bad).alias("invalid_lines"),
        F.count_if(F.col("_blank")).alias("empty_lines"),
        F.coalesce(F.max(tx.contains_korean(F.coalesce(text, F.lit("")))), F.lit(False)).alias("is_korean_content"))

    def listed(df: DataFrame, col: str, n: int):
        """The first n values in order, joined: a bounded top-n, then one row."""
        top = df.orderBy(col).limit(n)
        return F.coalesce(top.agg(F.array_join(F.sort_array(F.collect_list(col)), ",")).scalar(), F.lit(""))

    # names of at most LISTED_NAMES keys: documents may use ids as keys
    names = listed(win.select(F.explode(keys).alias("k")).distinct(), "k", LISTED_NAMES)
    rate = F.col("invalid_lines") / max(checked, 1)
    return agg.select(F.lit(total).cast("bigint").alias("total_lines"), F.lit(checked).cast("bigint").alias("checked_lines"),
                      "valid_lines", "invalid_lines", "empty_lines",
                      F.round(rate, 6).alias("invalid_rate"), (rate < 0.01).alias("is_valid"),
                      names.alias("schema_fields"), "is_korean_content",
                      listed(win.where(bad).select(rel), "_rel", LISTED_ERRORS).alias("error_lines"),
                      listed(win.where(valid).select(rel), "_rel", SAMPLES).alias("sample_lines"))


def clean_to_schema(parsed: DataFrame, schema=DOC_SCHEMA) -> DataFrame:
    """Rows missing a schema key are dropped; only schema columns are kept;
    null -> '' or []; non-strings -> their JSON text; a scalar string in a list
    column -> [string], any other non-list -> []; rows with blank text dropped."""
    ok = F.col("_obj")
    for name, _ in schema:
        ok = ok & has_key(name)
    out = []
    for name, typ in schema:
        raw = F.try_variant_get(F.col("_v"), f"$.{name}", "variant")
        kind = F.schema_of_variant(raw)
        if typ == "list[string]":
            arr = F.try_variant_get(F.col("_v"), f"$.{name}", "array<string>")
            scalar = F.try_variant_get(F.col("_v"), f"$.{name}", "string")
            c = (F.when(F.is_variant_null(raw) | raw.isNull(), F.array().cast("array<string>"))
                 .when(kind.startswith("ARRAY"), arr)
                 .when(kind == "STRING", F.array(scalar))
                 .otherwise(F.array().cast("array<string>")))
        else:
            c = (F.when(F.is_variant_null(raw) | raw.isNull(), F.lit(""))
                 .otherwise(F.try_variant_get(F.col("_v"), f"$.{name}", "string")))
        out.append(c.alias(name))
    keep = [c for c in parsed.columns if not c.startswith("_") and c not in dict(schema) and c != "value"]
    res = parsed.where(ok).select(*keep, *out)
    return res.where(tx.strip_ws(F.col("text")) != "")
