"""Tokenizers for executors: loaded once a Python worker, from a path that is a parameter."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np

_loaded: dict = {}


def vocabulary(name: str) -> str:
    """Place of one of the public vocabulary files."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer(path: str, plain: bool = False):
    """plain: strings of special tokens in a text are ordinary text."""
    if (path, plain) not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _loaded[path, plain] = Tokenizer.from_file(path)
        _loaded[path, plain].encode_special_tokens = plain
    return _loaded[path, plain]


#: ASCII punctuation at a word's end, behind a letter: a token run of its own.
_TAIL = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])([!-/:-@\[-`{-~]+)\Z")
#: Words of lower-case Latin letters, which no normaliser changes and no pre-tokenizer cuts.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: The character that stands for each byte in a byte-level vocabulary, where it isn't the byte's own.
_BYTE_CHARS = {byte: 256 + i for i, byte in enumerate([*range(33), *range(127, 161), 173])}


class WordEncoder(dict):
    """Whole-text ids of a tokenizer that drops white space and the case of letters, built from the ids of its words.

    Such a tokenizer never looks across ASCII white space, so each distinct word is encoded once and its ids are kept as
    little-endian bytes. Punctuation at a word's end is encoded apart; what is letters alone goes to the model at once, past
    normaliser and pre-tokenizer. The memory kept is bounded, within a text too: over MOST_WORDS (about 200 bytes each) the store
    becomes the old one, from which words that come again are taken over, and the old one goes; words over LONGEST bytes are
    encoded each time.
    Only for tokenizers that wordwise() accepts.
    """

    MOST_WORDS, LONGEST = 250_000, 64

    def __init__(self, path: str):
        self.encode, self.old = tokenizer(path).encode, {}
        self.model = tokenizer(path).model.tokenize if _bytewise(path) else None

    def __missing__(self, word: bytes) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self._encoded(word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.MOST_WORDS:
                self.old = dict(self)
                self.clear()
            self[word] = found
        return found

    def _encoded(self, word: bytes) -> bytes:
        if self.model and _PLAIN.fullmatch(word):
            return array("I", [t.id for t in self.model(word.decode("latin-1").translate(_BYTE_CHARS))]).tobytes()
        tail = None if b"<|" in word else _TAIL.search(word)
        if tail:
            return self[word[: tail.start(1)]] + self[tail[1]]
        return array("I", self.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def ids(self, text: str) -> np.ndarray:
        raw = text.encode("utf-8", "replace")
        if b"<|" not in raw:  # special tokens are matched before case is dropped
            raw = raw.lower()
        return np.frombuffer(b"".join(map(self.__getitem__, raw.split())), "<u4")  # bytes.split: space and the controls 9 to 13


class TextEncoder:
    """Ids of a whole text, for tokenizers of any other kind."""

    def __init__(self, path: str):
        self.encode = tokenizer(path).encode

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids, "<u4")


def wordwise(path: str) -> bool:
    """Whether a tokenizer drops case and everything between words, so that a text's ids are those of its words."""
    kind = json.loads(tokenizer(path).to_str())
    steps = lambda part: (kind[part] or {}).get("normalizers" if part == "normalizer" else "pretokenizers") or [kind[part] or {}]
    split = any(s.get("type") == "Split" and s.get("behavior") == "Removed" and s.get("invert") and "\\s" in str(s.get("pattern")) for s in steps("pre_tokenizer"))
    return split and any(s.get("type") == "Lowercase" for s in steps("normalizer"))


def _bytewise(path: str) -> bool:
    """Whether a word of lower-case Latin letters goes to a byte-level BPE model as it is, in one piece."""
    kind = json.loads(tokenizer(path).to_str())
    normal, pre = ((kind[part] or {}).get(steps) or [] for part, steps in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers")))
    plain = all(n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"} for n in normal)
    cut = [p["type"] for p in pre] == ["Split", "ByteLevel"] and "|[\\p{L}]+|" in str(pre[0]["pattern"].get("Regex")) and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"]
    return plain and cut and kind["model"]["type"] == "BPE" and not kind["model"].get("dropout") and not any(t["content"].isalpha() for t in kind["added_tokens"])


def text_encoder(path: str):
    """One for each Python worker, kept over its tasks."""
    if (path, "ids") not in _loaded:
        _loaded[path, "ids"] = (WordEncoder if wordwise(path) else TextEncoder)(path)
    return _loaded[path, "ids"]


def batches(texts: list[str], most_chars: int = 4_000_000):
    """Index ranges of consecutive texts of at most so many characters together, a longer text alone."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most_chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


# ---- word hashes --------------------------------------------------------------------------------------------------------

#: White space between words: the space and the controls 9 to 13.
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True
_BASE = 0x9E3779B97F4A7C13  # odd, 3 modulo 8: its powers differ in a low bit
_powers: dict = {}
_letters: dict = {}


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverses modulo 2 ** 64, for i < n. Kept up to 2 ** 21, which serves all but very long texts."""
    found = _powers.get(base)
    if found is None or len(found[0]) < n:
        size = max(n, 1 << 18)
        up, down = np.full(size, np.uint64(base), np.uint64), np.full(size, np.uint64(pow(base, -1, 1 << 64)), np.uint64)
        up[0] = down[0] = 1
        found = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if size <= 1 << 21:
            _powers[base] = found
    return found


def _letter(seed: int, fold: bool) -> np.ndarray:
    """A random number for each byte; fold: A-Z have those of a-z."""
    if (seed, fold) not in _letters:
        table = np.random.RandomState(1000 + seed).randint(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if fold:
            table[65:91] = table[97:123]
        _letters[seed, fold] = table
    return _letters[seed, fold]


def word_places(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of texts, one after another behind line ends; first byte and end of each word there; each text's number of words."""
    raw = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8)
    gap = _GAP[raw]
    first, stop = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1, np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    ends = np.cumsum([len(p) + 1 for p in parts]) + 1 if parts else np.zeros(0, np.int64)
    return raw, first, stop, np.diff(np.searchsorted(first, ends), prepend=0)


def hashes_at(raw: np.ndarray, first: np.ndarray, stop: np.ndarray, seed: int = 0, fold: bool = False, piece: int = 1 << 18) -> np.ndarray:
    """The hashes of words by their places. Bytes are taken in pieces of whole words, so memory is bounded by the longest word."""
    out, i = np.zeros(len(first), np.uint64), 0
    while i < len(first):
        at = first[i]
        j = max(i + 1, int(np.searchsorted(stop, at + piece, "right")))
        own, a, b = raw[at : stop[j - 1]], first[i:j] - at, stop[i:j] - at
        up, down = powers(_BASE, len(own) + 1)
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(_letter(seed, fold)[own] * up[: len(own)], out=total[1:])
        out[i:j] = mixed((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
        i = j
    return out


def hashed_words(texts: list[str], seeds=(0,), fold: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """For each seed the 64-bit hashes of all words of all texts, one text after another, and each text's number of words.

    A hash is the sum of a random number for each byte, drawn by the seed, times a power for its place in the word: prefix sums
    over the bytes give all words' at once."""
    raw, first, stop, counts = word_places([t.encode("utf-8", "surrogatepass") for t in texts])
    return [hashes_at(raw, first, stop, seed, fold) for seed in seeds], counts
