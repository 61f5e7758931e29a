"""Token ids from the tokenizers library, one white-space-delimited chunk once.

Both public vocabularies start a new pre-token wherever white space follows
other text, so a text's ids are its chunks' ids in a row.  A worker process
remembers the ids of chunks and of single words it has met (bounded, in two
generations); only unknown ones go through the library.  A text with white space
beyond space, tab, CR and LF, or with one of the vocabulary's special strings,
is encoded whole by the library.
"""

from __future__ import annotations

import re
from array import array
from operator import attrgetter

from winnow.llm.common import process_cache

CHUNKS = 250_000   # remembered chunks of a process, a generation
WORDS = 200_000    # remembered words of a process, a generation
SLICE = 1 << 22    # characters split at once
ODD_SPACE = re.compile("[\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
CUT = re.compile(r"(?<=[^ \t\r\n])(?=[ \t\r\n])")
GLUED = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")  # a chunk with the white space before it
BLANK_RUN = re.compile(r"[ \t\r\n] ")  # a blank behind other white space
PLAIN_END = frozenset(".,;:!?")
LINE_END = re.compile(r"[^ \t\r\n]+\n[^ \t\r\n]+")  # one line end between two words
ID = attrgetter("id")
LATIN_END = chr(0x200)  # precomposed Latin letters lie below


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the code points from 256 on, in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


LETTERS = _byte_letters()
BLANK = LETTERS[32]


class Remembered(dict):
    """A filled-on-demand table of bounded size: when ``limit`` entries are new,
    the older generation is dropped and the new one becomes the older."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        got = self.older.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = got
        return got


class Encoder:
    """Ids of texts as little-endian uint32 bytes (add_special_tokens=False)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.keeps_space = self.tok.normalizer is None
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        tokenize = self.tok.model.tokenize
        self.ids = lambda w: array("I", map(ID, tokenize(w))).tobytes()
        self.words = Remembered(self.ids, WORDS)
        self.chunks = Remembered(self.chunk, CHUNKS)
        self.after_blank = Remembered(lambda c: self.chunk(" " + c), CHUNKS)

    def chunk(self, chunk: str) -> bytes:
        """Ids of one chunk.  Plain Latin words, with or without one sign behind
        or a line end between two, are pre-tokenized here, all else by the
        library."""
        spaced = self.keeps_space and chunk[0] == " "
        body = chunk[1:] if spaced else chunk
        stem, end = (body[:-1], body[-1]) if body[-1:] in PLAIN_END else (body, "")
        if stem.isascii():
            if stem.isalpha():
                low = stem if self.keeps_space else stem.lower()
                if spaced:
                    low = BLANK + low
                return self.words[low] + self.words[end] if end else self.ids(low)  # a bare word is remembered as a chunk
        elif stem.isalpha() and max(stem) < LATIN_END:
            low = stem if self.keeps_space else stem.lower()
            if low.isalpha():
                letters = low.encode().decode("latin-1").translate(LETTERS)
                if spaced:
                    letters = BLANK + letters
                return self.words[letters] + self.words[end] if end else self.ids(letters)
        if self.keeps_space and LINE_END.fullmatch(body):
            left, right = body.split("\n")
            return (self.after_blank if spaced else self.chunks)[left] + self.words[LETTERS[10]] + self.chunks[right]
        text = chunk if self.keeps_space else self.tok.normalizer.normalize_str(chunk)
        return b"".join([self.words[p] for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(text)])

    def _part(self, text: str) -> bytes:
        if not self.keeps_space:
            return b"".join(map(self.chunks.__getitem__, text.split()))
        if BLANK_RUN.search(text):
            return b"".join(map(self.chunks.__getitem__, GLUED.findall(text)))
        # every blank follows other text, so a chunk starts at each
        first, *rest = text.split(" ")
        return b"".join([self.chunks[first] if first else b"", *map(self.after_blank.__getitem__, rest)])

    def encode(self, text: str) -> bytes:
        if ODD_SPACE.search(text) or any(s in text for s in self.special):
            return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()
        if len(text) <= SLICE:
            return self._part(text) if text else b""
        out, lo = [], 0
        while lo < len(text):
            cut = CUT.search(text, lo + SLICE)
            hi = cut.start() if cut else len(text)
            out.append(self._part(text[lo:hi]))
            lo = hi
        return b"".join(out)


def encoder(path: str) -> Encoder:
    """The process's encoder for a vocabulary file."""
    cache = process_cache("tokenizers")
    if path not in cache:
        cache[path] = Encoder(path)
    return cache[path]


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers
    return public_tokenizers.path(name)
