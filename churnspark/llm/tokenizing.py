"""Token ids of texts by public tokenizers, piece by piece, with a memory that a Python worker keeps between tasks."""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa

REMEMBERED = 200_000  # pieces in a generation of a memory
TOGETHER = {"most": 4 << 20, "rows": 2048}  # bytes and number of texts that are encoded together
_DOUBLE = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?= \S)")
IDS = np.dtype("<u4")
LATIN = "\u0250"  # letters below it are letters to every library

# How byte-level vocabularies write a byte: printable ones as themselves, the others from U+0100 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
SIGNS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + k) for k, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}

_SIGN_CODES = np.array([ord(SIGNS[b]) for b in range(256)], "<u2")

LETTER, DIGIT, SIGN, SPACE, WHITE, OTHER = range(6)
KINDS = np.full(256, OTHER, np.uint8)  # of a byte in UTF-8; letters of two bytes are those up to LATIN
KINDS[33:127] = SIGN
KINDS[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = LETTER
KINDS[48:58] = DIGIT
KINDS[9:14] = WHITE
KINDS[32] = SPACE


def kept(key: tuple, make: Callable[[], Any]) -> Any:
    """The object made for ``key`` in this Python process, made once."""
    store = sys.modules.setdefault("_churnspark_kept", types.ModuleType("_churnspark_kept"))
    if key not in store.__dict__:
        store.__dict__[key] = make()
    return store.__dict__[key]


class Memory(dict):
    """Values computed once for each key, as long as the key stays in use: of two generations the older is dropped."""

    def __init__(self, compute: Callable[[str], Any], most: int = REMEMBERED):
        self.compute, self.most, self.older = compute, most, {}

    def make_room(self) -> None:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()

    def __missing__(self, key: str) -> Any:
        self.make_room()
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


def pieces(text: str) -> list[str]:
    """The text cut before every single space between two other characters; all pieces but the first lack that space."""
    if not _DOUBLE.search(text):
        return text.split(" ")
    return [p[i > 0 :] for i, p in enumerate(_CUT.split(text))]


def common(texts: list[bytes]) -> np.ndarray:
    """Which texts have only bytes that KINDS knows, and no sign of two bytes."""
    data = np.frombuffer(b"".join(texts) + b" ", np.uint8)
    bad = KINDS[data] == OTHER
    if data.max() >= 128:
        lead, after = data[:-1], data[1:]
        bad[:-1] |= (lead == 0xC3) & ((after == 0x97) | (after == 0xB7)) | (lead == 0xC9) & (after >= 0x90)
    upto = np.cumsum([0, *map(len, texts)])
    at = np.searchsorted(np.flatnonzero(bad), upto)
    return at[1:] == at[:-1]


def stretch_starts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of common texts, one after the other, and which of them begin a stretch of a byte-level tokenizer.

    A stretch is a contraction, or letters, digits or signs with a single space before them, or white space; of a run
    of white space before something else the last character is apart.
    """
    data = np.frombuffer(b"".join(texts) + bytes(3), np.uint8)
    n = len(data) - 3
    new = np.zeros(n + 4, bool)  # texts
    new[np.cumsum([0, *map(len, texts)])] = True
    kind = KINDS[data]
    white = (kind == SPACE) | (kind == WHITE)
    start = np.empty(n + 3, bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start[1:] &= kind[:-1] != SPACE  # something after a space
    follows = white[1:-1] & white[:-2]
    start[1:-1] = np.where(follows, ~white[2:] & ~new[2:-1], start[1:-1] | white[1:-1])
    start |= new[:-1]
    quote = np.flatnonzero((data[:n] == 39) & start[:n])
    quote = quote[~new[quote + 1]]
    one, two = data[quote + 1], data[quote + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
    long &= ~new[quote + 2]
    start[quote[short | long] + 1] = False
    after = np.concatenate([quote[short] + 2, quote[long] + 3])
    start[after] |= kind[after] == LETTER
    return data[:n], start[:n]


class ByteTokenizer:
    """The ids of a byte-level tokenizer, as packed unsigned 32-bit integers.

    Such a tokenizer starts a new stretch at every single space between two other characters, so the pieces of a
    text are encoded apart, and frequent ones once. With ``plain`` the strings of special tokens are ordinary
    text; else a text that holds one is encoded whole.
    """

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        # The same tokenizer for stretches already cut and written as in the vocabulary, with a space between them.
        self.apart = Tokenizer.from_file(path)
        self.apart.encode_special_tokens = True
        self.apart.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        entries = (self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size()))
        self.opens = np.array([e.startswith(SIGNS[32]) for e in entries])
        self.specials = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special_bytes = [x.encode() for x in self.specials]
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = self.tokenizer.model.tokenize
        self.words = Memory(lambda word: array("I", [t.id for t in self.merge(word)]).tobytes())
        self.spaced = Memory(self.after_space)

    def whole(self, text: str) -> bytes:
        return b"".join([self.words[word] for word, _ in self.split(text)])

    def after_space(self, piece: str) -> bytes:
        if piece.isalpha() and max(piece) < LATIN:  # one stretch
            word = (" " + piece).encode().decode("latin-1").translate(SIGNS)
            return array("I", [t.id for t in self.merge(word)]).tobytes()
        return self.whole(" " + piece)

    def encode(self, text: str) -> bytes:
        if any(map(text.__contains__, self.specials)):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = pieces(text)
        return (self.whole(first) if first else b"") + b"".join(map(self.spaced.__getitem__, rest))

    def looked_up(self, words: list[str]) -> list[bytes]:
        """The ids of different words; new ones that begin with a space are encoded in one go, and all are remembered."""
        self.words.make_room()
        known, older, space = self.words, self.words.older, SIGNS[32]
        found = [known.get(w) or older.get(w) for w in words]
        new = [i for i, f in enumerate(found) if f is None]
        after = [i for i in new if len(words[i]) > 1 and words[i].rfind(space) == 0]
        if after:
            ids = np.array(self.apart.encode_batch_fast([" ".join([words[i] for i in after])], add_special_tokens=False)[0].ids, IDS)
            at = (4 * np.flatnonzero(self.opens[ids])).tolist()
            data = ids.tobytes()
            for i, a, b in zip(after, at, [*at[1:], len(data)], strict=True):
                known[words[i]] = found[i] = data[a:b]
        for i in new:
            if found[i] is None:
                found[i] = known[words[i]]
        return found

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many texts, one after the other, and how many each has; each different stretch is looked up once."""
        plain = [p and not any(map(t.__contains__, self.special_bytes)) for t, p in zip(texts, common(texts).tolist(), strict=True)]
        data, start = stretch_starts([t for t, p in zip(texts, plain, strict=True) if p])
        at = np.flatnonzero(start)
        offsets = pa.py_buffer(np.append(at, len(data)))
        found = pa.Array.from_buffers(pa.large_binary(), len(at), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        ends = np.frombuffer(found.dictionary.buffers()[1], np.int64)[: len(found.dictionary) + 1].tolist()
        signs = _SIGN_CODES[np.frombuffer(found.dictionary.buffers()[2] or b"", np.uint8)[: ends[-1]]].tobytes().decode("utf-16-le")
        words = [signs[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        table = self.looked_up(words)
        size = np.fromiter(map(len, table), np.int64, len(table)) // 4
        code = found.indices.to_numpy()
        held = size[code]
        upto = np.cumsum(held)
        ids = np.frombuffer(b"".join(table), IDS)
        ids = ids[np.repeat((np.cumsum(size) - size)[code] - upto + held, held) + np.arange(held.sum())]
        # How many ids lie before each byte gives how many each text has.
        first = np.cumsum([0, *(len(t) for t, p in zip(texts, plain, strict=True) if p)])
        before = np.append(0, upto)[np.searchsorted(at, first)]
        if all(plain):
            return ids, np.diff(before)
        mine = iter(np.split(ids, before[1:-1]))
        parts = [next(mine) if p else np.frombuffer(self.encode(t.decode()), IDS) for t, p in zip(texts, plain, strict=True)]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def entry_bytes(self) -> list[bytes]:
        """The bytes of every id."""
        back = {sign: byte for byte, sign in SIGNS.items()}
        n = self.tokenizer.get_vocab_size()
        entries = (self.tokenizer.id_to_token(i) or "" for i in range(n))
        return [bytes(back[c] for c in e) if all(c in back for c in e) else e.encode() for e in entries]


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of many texts with ``end_id`` after each, and the sizes with it."""
    sizes = sizes + 1
    out = np.empty(len(ids) + len(sizes), IDS)
    last = np.cumsum(sizes) - 1
    inner = np.ones(len(out), bool)
    inner[last] = False
    out[inner], out[last] = ids, end_id
    return out, sizes


def byte_tokenizer(path: str, plain: bool = False) -> ByteTokenizer:
    return kept(("bytes", path, plain), lambda: ByteTokenizer(path, plain))


class PieceTokenizer:
    """The ids of a sentence-piece model, as packed unsigned 32-bit integers.

    Where no entry of the model holds a space after another character, words are encoded apart.
    """

    SPACE = "▁"

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(self.SPACE, " ").encode() for i, p in enumerate(names)
        ]
        self.apart = not any(self.SPACE in p.lstrip(self.SPACE) for p in names)
        # The model puts a space before each text, so a piece is encoded without the space it had.
        self.alone = array("I", [self.model.piece_to_id(self.SPACE)]).tobytes()
        self.spaced = Memory(self.after_space)

    def after_space(self, piece: str) -> bytes:
        return array("I", self.model.encode(piece)).tobytes() if piece else self.alone

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.apart or self.SPACE in text:
            return array("I", self.model.encode(text)).tobytes()
        first, *rest = pieces(" " + text)
        return (self.after_space(first[1:]) if first else b"") + b"".join(map(self.spaced.__getitem__, rest))


def piece_tokenizer(path: str) -> PieceTokenizer:
    return kept(("pieces", path), lambda: PieceTokenizer(path))
