"""Personal data behind disguises, found at its place in the source text.

Base spans come from fixed patterns on the text as it is.  For the disguises a
text is rewritten by a transducer: homoglyphs, full-width forms and foreign
digits become ASCII, invisible characters vanish, spelled digits become digits,
at/dot/plus disguises become their signs.  The rewriting keeps an alignment
(copied and edited stretches), so a match in the normalised text maps back to
the exact source characters.  A match that touches no edit is a base span
already; one inside base spans adds nothing.  One that reaches beyond the base
spans it overlaps (a base pattern often matches a fragment of a disguised
identifier) is added beside them; base spans stay as they are.

One narrow pass, no shuffle; work is linear in the text.

Defined results: null text counts as empty; repeated rows each get their row;
an empty table gives no rows; other columns are untouched by ``redact`` and
ignored by ``find``.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm.common import id_text, lean, map_rows, replaced

KINDS = ("email", "ip", "card", "phone")

# -------------------------------------------------------------- base patterns
# The patterns of the four kinds.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match begins and ends with a whole run of digits, so no run is tried from its inside
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Local part, @, dotted domain.  A local part is the whole run of its
    characters before the @, so each @ is looked at once and time is linear."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > last and text[lo - 1] in LOCAL:
            lo -= 1
        m = DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append((lo, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all four kinds, by start, then kind."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if 12 <= m.end() - m.start():
            d = _digits(m.group())
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return [(KINDS[k], s, e) for s, k, e in sorted(out)]


# ---------------------------------------------------------------- transducer
# Letters of other scripts that look like Latin ones.
LOOKALIKES = dict(zip("АВЕЅІЈКМНОРСТУХасеіјѕорхуԁһԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧνοραι",
                      "ABESIJKMHOPCTYXaceijsopxydhqw" "ABEZHIKMNOPTYXvopai"))
# Digits as words in the four languages of the corpus.
SPELLED = {
    "0": "zero null zéro cero", "1": "one eins un une uno", "2": "two zwei zwo deux dos", "3": "three drei trois tres",
    "4": "four vier quatre cuatro", "5": "five fünf cinq cinco", "6": "six sechs seis", "7": "seven sieben sept siete",
    "8": "eight acht huit ocho", "9": "nine neun neuf nueve"}
DIGIT_OF = {w: d for d, words in SPELLED.items() for w in words.split()}
INVISIBLE = frozenset(map(chr, (0xAD, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0xFEFF)))
DASHES = frozenset(map(chr, (*range(0x2010, 0x2016), 0x2212)))
ASCII_OUT = frozenset("@.+-()_% ") | LOCAL

# everything beyond the accented Latin letters, with the no-break space and soft hyphen
ODD = f"[{chr(0xA0)}{chr(0xAD)}{chr(0x2B0)}-{chr(0x10FFFF)}]"
_words = "|".join(sorted(DIGIT_OF, key=len, reverse=True))
# Top-level domains that end a host whose signs are all words, after whatever label.
TOP_LEVEL = "com|org|net|edu|gov|info|biz|io|eu|de|fr|es|uk|ch|us|it|nl|ru"
_label = r"[A-Za-z0-9-]+"
_host = rf"{_label}(?:(?:\s+dot\s+|\.){_label})*\s+dot\s+"
# Words before which "dot" is a noun of the sentence, not a sign.
DETERMINERS = "the|a|an|this|that|these|those|each|every|any|some|no|one|another|my|your|his|her|its|our|their|which|what"


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" for c in word)


def _spelled() -> str:
    """The spelled digits as whole words; one set of first letters stands in
    front, so that a search passes over all other characters at once."""
    firsts = sorted({w[0] for w in DIGIT_OF})
    rest = ["(?<=" + _any_case(c) + ")(?:" + "|".join(_any_case(w[1:]) for w in sorted(DIGIT_OF, key=len, reverse=True) if w[0] == c) + ")"
            for c in firsts]
    return f"[{''.join(c + c.upper() for c in firsts)}](?<!\\w.)(?:{'|'.join(rest)})(?!\\w)"


# The rewritten places, most wanted first where two begin at one character.  Every pattern begins with a set of
# characters and looks through a run of blanks once.
DIGIT = re.compile(_spelled())
BRACKET = re.compile(r"[\[({<]\s*+(?:(?P<at>at|@|arroba|arobase)|(?P<dot>dot|punkt|punto|point|\.)|(?P<plus>plus|\+))\s*+[\])}>]\s*", re.IGNORECASE)
PLUS = re.compile(rf"[pP](?<!\w.)[lL][uU][sS]\s+(?=(?i:{_words}|[0-9])\b)")
# a bare "at" counts only between a name and a host that spells its last dot and ends in letters; a host that
# begins like a noun phrase must end in a listed top-level domain
BARE_AT = re.compile(rf"\s(?<=[A-Za-z0-9]\s)\s*at\s+(?={_host}(?:{TOP_LEVEL})\b|(?!(?:{DETERMINERS})\s){_host}[A-Za-z]{{2,}}\b)", re.IGNORECASE)
BARE_DOT = re.compile(r"\s(?<=[A-Za-z0-9]\s)\s*dot\s+(?=[A-Za-z0-9])", re.IGNORECASE)
ODD_RUN = re.compile(ODD)
WORDED = ((DIGIT, "digit"), (BRACKET, None), (PLUS, "plus"), (BARE_AT, "at"), (BARE_DOT, "dot"))
SIGN = {"at": "@", "dot": ".", "plus": "+"}


def sites(text: str):
    """(start, end, kind) of the places to rewrite, from left to right without
    overlap.  Blanks before a bracketed at or dot belong to it."""
    pos, never = 0, len(text) + 1
    heads = [(-1, 0, None)] * len(WORDED)  # each pattern's next place, found again once it lies behind
    odd = ODD_RUN.search(text)
    while True:
        for k, (pattern, kind) in enumerate(WORDED):
            if heads[k][0] < pos:
                m = pattern.search(text, pos)
                s = m.start() if m else never
                if m and kind is None and m.lastgroup != "plus":
                    while s > pos and text[s - 1].isspace():
                        s -= 1
                heads[k] = (s, m.end(), kind or m.lastgroup) if m else (never, never, None)
        s, e, kind = min(heads, key=lambda h: h[0])  # of equals the first
        while odd and odd.start() < s:
            if odd.start() >= pos:
                yield odd.start(), odd.end(), "odd"
                pos = odd.end()
            odd = ODD_RUN.search(text, max(pos, odd.end()))
        if s == never:
            return
        if s < pos:  # blanks of a bracket that an odd character before has taken
            s = pos
        yield s, e, kind
        pos = e
        if odd and odd.start() < pos:
            odd = ODD_RUN.search(text, pos)


GAP = re.compile(r"[\s-]+")


@lru_cache(maxsize=1 << 14)
def plain(c: str) -> str:
    """ASCII stand-in of one non-Latin character, or the character itself."""
    if c in INVISIBLE:
        return ""
    if c in DASHES:
        return "-"
    if c in LOOKALIKES:
        return LOOKALIKES[c]
    if (d := unicodedata.decimal(c, None)) is not None:
        return str(d)
    if unicodedata.category(c) == "Zs":
        return " "
    n = "." if c == "\u3002" else unicodedata.normalize("NFKC", c)
    return n if len(n) == 1 and n in ASCII_OUT else c


class Aligned:
    """A normalised text with its way back: stretches (norm start, source
    start, source end, edited)."""

    def __init__(self, text: str):
        self.parts: list[str] = []
        self.norm: list[int] = []
        self.src: list[tuple[int, int, bool]] = []
        self.size = 0
        pos, digit_end = 0, -1
        for s, e, kind in sites(text):
            out = plain(text[s:e]) if kind == "odd" else SIGN.get(kind) or DIGIT_OF[text[s:e].lower()]
            if out == text[s:e]:
                continue
            if s > pos:
                gap = text[pos:s]
                if kind == "digit" and pos == digit_end and GAP.fullmatch(gap):
                    self._add("", pos, s, True)  # blanks between spelled digits vanish
                else:
                    self._add(gap, pos, s, False)
            self._add(out, s, e, True)
            pos = e
            digit_end = e if kind == "digit" else -1
        if self.src and pos < len(text):
            self._add(text[pos:], pos, len(text), False)
        self.text = "".join(self.parts)

    def _add(self, out: str, s: int, e: int, edited: bool) -> None:
        if out:
            self.norm.append(self.size)
            self.src.append((s, e, edited))
        self.parts.append(out)
        self.size += len(out)

    def back(self, a: int, b: int) -> tuple[int, int, bool]:
        """Source span of normalised [a, b), and whether an edit is in it."""
        i, j = bisect_right(self.norm, a) - 1, bisect_right(self.norm, b - 1) - 1
        s = self.src[i][0] if self.src[i][2] else self.src[i][0] + a - self.norm[i]
        e = self.src[j][1] if self.src[j][2] else self.src[j][0] + b - self.norm[j]
        # neighbours in the text but with removed characters between them count as edited
        edited = any(x[2] for x in self.src[i:j + 1]) or e - s != b - a
        return s, e, edited


def find_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans) in code points, by start, then kind."""
    base = detect(text)
    found = Aligned(text)
    if not found.src:
        return base, base
    extra, starts, ends = [], [], []  # stretches that base spans cover together
    for s, e in sorted((s, e) for _, s, e in base):
        if ends and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for kind, a, b in detect(found.text):
        s, e, edited = found.back(a, b)
        i = bisect_right(starts, s) - 1
        if edited and (i < 0 or ends[i] < e):
            extra.append((kind, s, e))
    return base, sorted([*base, *extra], key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# ------------------------------------------------------------------ operators

def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_spans, spans): counts are
    of all spans, spans are ``kind:start:end`` joined by commas."""
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_spans", "spans"]

    def run(batches):
        for b in batches:
            rows = []
            for t in b.column("text").to_pylist():
                base, spans = find_spans(t or "")
                rows.append((*(sum(s[0] == k for s in spans) for k in KINDS), written(base), written(spans)))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:4]), *(pa.array(c, pa.string()) for c in cols[4:])],
                names=names)

    return id_text(docs, id_col, text_col).mapInArrow(
        lean(run), "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_spans string, spans string")


def masked(text: str) -> str:
    """The text with every span replaced by its kind; of overlapping spans the
    first names the stretch they cover together."""
    out, pos = [], 0
    for kind, s, e in find_spans(text)[1]:
        if s >= pos:
            out += [text[pos:s], f"[{kind.upper()}]"]
        pos = max(pos, e)
    return "".join([*out, text[pos:]])


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked; a length column, if there is one,
    follows the new text.  Null text stays null."""
    def mask(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [None if t is None else masked(t) for t in batch.column(text_col).to_pylist()]
        if length_col in batch.schema.names:
            batch = replaced(batch, length_col, pa.array([None if t is None else len(t) for t in texts], pa.int64()))
        return replaced(batch, text_col, pa.array(texts, pa.string()))

    return map_rows(docs.withColumn(text_col, F.col(text_col).cast("string")), mask)
