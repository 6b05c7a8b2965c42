"""Token ids of whole texts.

Texts of plain characters are merged as a whole by the ranks of the vocabulary (``Ranks``). Others are
built from separately encoded chunks that are remembered within bounds: such a text is cut only where the tokenizer itself always ends a pre-token: before a space that begins a
run of white space (``kept``), or at spaces and line ends where white space is dropped (``dropped``).
So the ids of the chunks, in order, are the ids the library gives for the whole text.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import tiktoken
from pyspark import Broadcast
from tokenizers import Tokenizer

#: chunks remembered per worker (two generations of this many) and the longest one remembered
REMEMBERED = 200_000
LONGEST = 64
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
ASCII_PAIRS = tuple(c + " " for c in SPACES if c.isascii())
OTHER_PAIRS = tuple(c + " " for c in SPACES if not c.isascii())
RUN_START = re.compile(r"(?<=\S)(?= )")


class Memo(dict):
    """``make(key)`` remembered; when a generation is full it becomes the old one and a new one starts."""

    def __init__(self, make: Callable, limit: int = REMEMBERED, longest: int = LONGEST):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def needs_care(text: str) -> bool:
    """True where a space follows other white space, so that cutting at every space is not safe."""
    return any(p in text for p in ASCII_PAIRS) or (not text.isascii() and any(p in text for p in OTHER_PAIRS))


class Chunks:
    """A function of text pieces (``make``), applied to all pieces of a text and remembered.

    ``word`` is a quicker way for chunks of ASCII letters that follow white space: one pre-token each.
    """

    def __init__(self, make: Callable[[str], object], word: Callable[[str], object], white_space: str = "kept"):
        if white_space not in ("kept", "dropped"):
            raise ValueError("white_space is kept or dropped")
        self.dropped = white_space == "dropped"
        lead = "" if self.dropped else " "
        self.whole = Memo(make)
        self.after_space = Memo(lambda chunk: word(chunk) if chunk.isascii() and chunk.isalpha() else make(lead + chunk))

    def pieces(self, text: str) -> list:
        """The values of the pieces of ``text``, in order."""
        if self.dropped:
            return list(map(self.after_space.__getitem__, text.replace("\n", " ").split(" ")))
        if needs_care(text):
            return [self.whole[c] for c in RUN_START.split(text)]
        chunks = text.split(" ")
        return [self.whole[chunks[0]], *map(self.after_space.__getitem__, chunks[1:])]


def loaded(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    if any(c.isspace() for t in tokenizer.get_added_tokens_decoder().values() for c in t.content):
        raise ValueError("a special token holds white space; chunks would cut it")
    return tokenizer


#: below this code point the classes of the patterns are stable over all Unicode versions and normal forms
STABLE = 0x250
PLAIN = re.compile("[\\t\\n\\r -~\xa0-\u024f]*").fullmatch


def _class(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(STABLE) if unicodedata.category(chr(c))[0] == kind)


LETTERS, NUMBERS = _class("L"), _class("N")
# --- fixed values: the pre-token patterns of the two kinds of tokenizers, for code points below STABLE ---
PRE_TOKEN = {
    "kept": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\s{LETTERS}{NUMBERS}]+|\s+(?!\S)|\s+"),
    "dropped": re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+"),
}


def byte_alphabet() -> dict[int, str]:
    """The letter for each byte: printable bytes stand for themselves, the others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(b for b in range(256) if b not in own)}


class Merger:
    """Values of pieces from their pre-tokens; ``of_ids`` turns the ids of a pre-token into a value.

    Pieces of plain characters are cut by the pattern here and merged by the library's model, each
    different pre-token once while remembered. Other pieces go through the library whole.
    """

    def __init__(self, path: str, white_space: str, of_ids: Callable[[list[int]], object], known: Callable[[str], object] | None = None):
        self.tokenizer = loaded(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pattern, self.lower, self.of_ids = PRE_TOKEN[white_space], white_space == "dropped", of_ids
        letters, self.model, self.known = byte_alphabet(), self.tokenizer.model, known
        # the letters of a space before a word, and a word as it stands
        self.lead, self.mark = ("", "") if self.lower else (" ", letters[ord(" ")])

        def merged(token: str):
            value = known(token) if known else None
            return of_ids([t.id for t in self.model.tokenize(token.encode().decode("latin-1").translate(letters))]) if value is None else value

        self.memo = Memo(merged, REMEMBERED // 4)

    def word(self, chunk: str):
        """The value of a chunk of ASCII letters after white space; the caller remembers it."""
        chunk = chunk.lower() if self.lower else chunk
        value = self.known(self.lead + chunk) if self.known else None
        return self.of_ids([t.id for t in self.model.tokenize(self.mark + chunk)]) if value is None else value

    def values(self, piece: str) -> list:
        if PLAIN(piece) and not any(s in piece for s in self.special):
            lowered = piece.lower() if self.lower else piece
            if PLAIN(lowered):
                return [self.memo[t] for t in self.pattern.findall(lowered)]
        return [self.of_ids(self.tokenizer.encode(piece, add_special_tokens=False).ids)]


#: runs longer than this go through the chunks: merging by ranks takes the square of a pre-token
RUN = 1000
_MARKS = "!-~\xa0-\u024f"
#: plain characters in runs, and white space between them, of up to RUN each
SHORT_RUNS = re.compile(rf"[\t\n\r ]{{0,{RUN}}}+(?:[{_MARKS}]{{1,{RUN}}}+(?:[\t\n\r ]{{1,{RUN}}}+|\Z))*+").fullmatch
#: ends a word where the vocabulary tells the ends of words apart; no plain character
WORD_END = "\x01"


@dataclass(frozen=True)
class Ranks:
    """The merges of a vocabulary as ranks of byte strings, and the id of each rank; bounded by the vocabulary."""

    tokens: dict[bytes, int]
    ids: np.ndarray


def ranks_of(path: str) -> Ranks:
    """Ranks that merge as the model's list of merges does.

    Merging by ranks joins any neighbours whose whole is a token, merging by the list only the pairs on
    it. Both give the same where every token, taken alone, is merged to itself: neighbours that make up
    such a token are then always a pair of the list. Tokens that are not so reached never come up, and
    are left out.
    """
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
    pairs = {(a, b): i for i, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"])}
    byte_of = {letter: byte for byte, letter in byte_alphabet().items()}

    def raw(token: str) -> bytes:
        last = bool(end) and token.endswith(end)
        return bytes(byte_of[c] for c in (token[: -len(end)] if last else token)) + (WORD_END.encode() if last else b"")

    def alone(token: str) -> bool:
        parts = list(token[: -len(end)] if end and token.endswith(end) else token)
        if end and token.endswith(end):
            parts[-1] += end
        while len(parts) > 1:
            rank, at = min((pairs.get(p, len(pairs)), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == len(pairs):
                return False
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return True

    tokens, ids = {}, []
    for byte, letter in sorted(byte_alphabet().items()):
        tokens[bytes([byte])] = len(ids)
        ids.append(vocab[letter])
    for _, letter in sorted(byte_alphabet().items()) if end else ():
        tokens[raw(letter + end)] = len(ids)
        ids.append(vocab[letter + end])
    for a, b in pairs:
        if alone(a + b):
            tokens.setdefault(raw(a + b), len(ids))
            ids.append(vocab[a + b])
    return Ranks(tokens, np.array(ids, "<u4"))


class IdEncoder:
    """Ids of texts as little-endian unsigned 32-bit integers, without added special tokens."""

    def __init__(self, path: str, white_space: str = "kept", ranks: Ranks | None = None):
        merger = Merger(path, white_space, lambda ids: struct.pack(f"<{len(ids)}I", *ids))
        self.chunks = Chunks(lambda piece: b"".join(merger.values(piece)), merger.word, white_space)
        self.special, self.ids = merger.special, None
        if ranks is not None:
            self.ids, self.cut = ranks.ids, merger.pattern.findall if merger.lower else None
            # words come cut and marked where white space is dropped, else the pattern of the vocabulary cuts
            pattern = f"[^{WORD_END}]*{WORD_END}" if merger.lower else PRE_TOKEN["kept"].pattern
            self.merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.tokens, special_tokens={}).encode_ordinary

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.ids is not None and not any(s in text for s in self.special):
            plain = text.lower() if self.cut else text
            if SHORT_RUNS(plain):
                if self.cut:
                    plain = WORD_END.join([*self.cut(plain), ""])
                return self.ids[self.merge(plain)].tobytes()
        return b"".join(self.chunks.pieces(text))


def kept_by_worker(cache: Broadcast, make: Callable):
    """What ``make`` gives, made once per worker process: a broadcast dict outlives the worker's tasks."""
    if "made" not in cache.value:
        cache.value["made"] = make()
    return cache.value["made"]
