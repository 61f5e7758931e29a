"""DuckDB oracle SQL pieces.

The oracle side is a brute-force restatement: it materialises candidate
pairs (fine at the check scale) and runs the greedy seed rounds over pairs,
while the Spark side never builds pairs.  Shared CTE builders keep the
per-query SQL short.
"""

from __future__ import annotations

from winnow.functions import minhash as mh
from winnow.functions.text import HANGUL_FIRST

P = mh.MERSENNE_P


def norm_text(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '\\s+', ' ', 'g'))"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


def jamo_text(expr: str) -> str:
    code = "unicode(c)"
    idx = f"({code} - {HANGUL_FIRST})"
    dec = (f"chr(4352 + {idx} // 588) || chr(4449 + ({idx} % 588) // 28) || "
           f"CASE WHEN {idx} % 28 > 0 THEN chr(4519 + {idx} % 28) ELSE '' END")
    per_char = f"list_transform(string_split({expr}, ''), lambda c: CASE WHEN {code} BETWEEN 44032 AND 55203 THEN {dec} ELSE c END)"
    return f"CASE WHEN regexp_matches({expr}, '[가-힣]') THEN array_to_string({per_char}, '') ELSE {expr} END"


def quirk_tokens(expr: str) -> str:
    """lower-cased tokens of a whitespace-collapsed text, with the
    four-token repeat rule applied."""
    t = f"string_split(lower({expr}), ' ')"
    return f"CASE WHEN len({t}) = 4 AND suffix({t}[4], '입니다') THEN list_append({t}, {t}[4]) ELSE {t} END"


def word_grams(tq: str, n: int = 5) -> str:
    """n-grams over a token list column."""
    return (f"CASE WHEN len({tq}) < {n} THEN [array_to_string({tq}, ' ')] "
            f"ELSE list_transform(range(1, len({tq}) - {n - 2}), lambda i: array_to_string({tq}[i:i + {n - 1}], ' ')) END")


def char_grams(cs: str, n: int = 3) -> str:
    """n-grams over a character list column."""
    joined = " || ".join(f"{cs}[i + {k}]" for k in range(n))
    return (f"CASE WHEN len({cs}) < {n} THEN [array_to_string({cs}, '')] "
            f"ELSE list_transform(range(1, len({cs}) - {n - 2}), lambda i: {joined}) END")


def docs_cte(where: str = "text IS NOT NULL AND text <> ''") -> str:
    """normalized documents (flagship input)."""
    return (f"docs AS (SELECT doc_id, {norm_text('text')} AS text, {strip('lang')} AS lang, "
            f"{strip('source')} AS source, n_chars FROM documents WHERE {where})")


def signature_ctes(src: str = "docs", text: str = "text", scope: str | None = None,
                   bands: int = mh.DEFAULT_BANDS, rows: int = mh.DEFAULT_ROWS) -> str:
    """From CTE ``src`` (doc_id, text[, scope]) with preprocessed text build:
    sh(doc_id, s), sig(doc_id, i, v), bands(doc_id, band, key)."""
    sc = f", {scope}" if scope else ""
    return f""",
idx AS (SELECT doc_id{sc}, {text} AS t FROM {src} WHERE length({text}) >= 10),
tok AS (SELECT doc_id{sc}, {quirk_tokens('t')} AS tq, string_split({jamo_text('t')}, '') AS cs FROM idx),
grams AS (SELECT doc_id{sc}, {word_grams('tq')} AS wg, {char_grams('cs')} AS cg FROM tok),
sh AS (SELECT DISTINCT doc_id{sc}, unnest(list_concat(wg, cg)) AS s FROM grams WHERE len(wg) + len(cg) >= 5),
hs AS (SELECT DISTINCT doc_id{sc}, ('0x' || substr(md5(s), 1, 8))::BIGINT % {P} AS h FROM sh),
perm(i, a, b) AS (VALUES {mh.perm_values_sql()}),
sig AS (SELECT doc_id{sc}, i, min((a * h + b) % {P}) AS v FROM hs, perm GROUP BY ALL),
bands AS (SELECT doc_id{sc}, i // {rows} AS band, string_agg(v::VARCHAR, ',' ORDER BY i) AS key
          FROM sig WHERE i < {bands * rows} GROUP BY ALL)"""


def pair_ctes(scope: str | None = None) -> str:
    on = f" AND a.{scope} = b.{scope}" if scope else ""
    return f""",
pairs AS (SELECT DISTINCT a.doc_id AS x, b.doc_id AS y FROM bands a JOIN bands b
          ON a.band = b.band AND a.key = b.key AND a.doc_id <> b.doc_id{on})"""


def seed_ctes(rounds: int = 40) -> str:
    parts = [",\ns0 AS MATERIALIZED (SELECT DISTINCT x AS doc_id, 0 AS st FROM pairs)"]
    for k in range(1, rounds + 1):
        prev = f"s{k - 1}"
        parts.append(f""",
s{k} AS MATERIALIZED (SELECT d.doc_id,
    CASE WHEN d.st <> 0 THEN d.st
         WHEN bool_or(o.st = 1) THEN 2
         WHEN bool_and(NOT (p.y < d.doc_id AND o.st <> 2)) THEN 1
         ELSE 0 END AS st
  FROM {prev} d JOIN pairs p ON p.x = d.doc_id JOIN {prev} o ON o.doc_id = p.y
  GROUP BY d.doc_id, d.st)""")
    parts.append(f""",
seeds AS (SELECT CASE WHEN st = 0 THEN error('undecided after {rounds} rounds')::BIGINT ELSE doc_id END AS doc_id FROM s{rounds} WHERE st <> 2),
clusters AS (SELECT doc_id AS cid, doc_id AS m FROM seeds
             UNION SELECT s.doc_id, p.y FROM seeds s JOIN pairs p ON p.x = s.doc_id)""")
    return "".join(parts)


def reps_cte(len_expr: str = "length(d.text)", src: str = "docs") -> str:
    return f""",
reps AS (SELECT cid, m AS rep FROM (
  SELECT c.cid, c.m, row_number() OVER (PARTITION BY c.cid ORDER BY {len_expr} DESC, c.m) AS rn
  FROM clusters c JOIN {src} d ON d.doc_id = c.m) WHERE rn = 1),
dropped AS (SELECT DISTINCT m AS doc_id FROM clusters WHERE m NOT IN (SELECT rep FROM reps))"""


def dedup_chain(rounds: int = 40) -> str:
    return "WITH " + docs_cte() + signature_ctes() + pair_ctes() + seed_ctes(rounds) + reps_cte()
