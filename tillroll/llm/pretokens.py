"""Ids of whole texts by a tokenizers file, with each distinct word and pre-token merged once per worker.

The library itself takes over a microsecond per byte on prose.  White space bounds every pre-token of the two layouts
below, so words (white space and what follows it) can be encoded by themselves and looked up.  The library's own
model merges each distinct pre-token; a text with characters outside a set whose classes and case are the same in
every Unicode version, or with a special token's string, goes to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space, printable ASCII, Latin, Cyrillic, kana, Han and Hangul syllables: letters, digits and signs that need no
#: normalization and whose lower case is one code point.
SAFE = "\t\n\r -~¡-¬®-Įı-ɏЀ-џぁ-ゖァ-ヺ一-龥가-힣"
#: Entries of a cache's newer half; what is not asked for while that fills is forgotten.
CACHE = 80_000

_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_BYTES_ONLY = _BYTE_LEVEL | {"use_regex": False}
#: The pattern of a byte-level pre-tokenizer with ``use_regex``.
_BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOWER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}

#: Byte-level models read one printable character per byte: the others are shifted past Latin-1 in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SHOWN = dict.fromkeys(_PRINTABLE) | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTABLE)))}
_SHOWN = {b: b if c is None else c for b, c in _SHOWN.items()}

_SHOWN_SPACE = chr(_SHOWN[32])
_ENDS = (",", ".", ";", ":", "!", "?")


def mapped(piece: str) -> str:
    """A pre-token as byte-level models see it: one character per byte."""
    if piece.isascii() and piece.isprintable():
        return piece.replace(" ", _SHOWN_SPACE)
    return piece.encode().decode("latin-1").translate(_SHOWN)

#: White space after white space, or any other than space and newline, among the safe characters.
_SPACES = ("  ", " \n", "\n ", "\n\n", "\t", "\r")
_ID = attrgetter("id")
#: Characters of the texts that are split together.
TOGETHER = 1 << 23


def _double_space(text: str) -> bool:
    return any(map(text.__contains__, _SPACES))


class _Filled(dict):
    """A dict that computes what it lacks, and keeps what it was asked for lately."""

    def __init__(self, make: Callable[[str], bytes]):
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def age(self) -> None:
        """Called between texts: once full, only what is asked for again will stay."""
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()


class PreTokens:
    """A tokenizers file, seen as pre-tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        os.environ["RAYON_NUM_THREADS"] = "1"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        layout = json.loads(self.library.to_str())
        self.specials = [t["content"] for t in layout["added_tokens"]]
        self.vocab_size = self.library.get_vocab_size()
        before = layout["pre_tokenizer"] or {}
        parts = before.get("pretokenizers", [])
        self.lower = layout["normalizer"] == _LOWER
        pattern = None
        if layout["normalizer"] is None and before == _BYTE_LEVEL:
            pattern = _BYTE_LEVEL_PATTERN
            self._words = re.compile(r"\s*\S+|\s+").findall
        elif (
            self.lower
            and len(parts) == 2
            and parts[0]["type"] == "Split"
            and (parts[0]["behavior"], parts[0]["invert"]) == ("Removed", True)
            and parts[1] == _BYTES_ONLY
        ):
            pattern = parts[0]["pattern"]["Regex"]
            self._words = str.split
        post = layout["post_processor"] is None and layout["truncation"] is None
        self.known = pattern is not None and post and layout["model"]["type"] == "BPE"
        self._pieces = regex.compile(pattern).findall if self.known else None
        self._odd = re.compile(f"[^{SAFE}]").search
        # Without specials the pattern matches nothing.
        self._special_parts = re.compile("(" + ("|".join(map(re.escape, self.specials)) or "(?!)") + ")").split
        self._of_word = _Filled(self._word)
        self._of_spaced = _Filled(lambda word: self._word(" " + word))
        self._of_piece = _Filled(self._piece)
        self._of_unit = _Filled(self._unit)
        self._tokenize = self.library.model.tokenize

    def plain(self, text: str) -> bool:
        """Whether the text is made of safe characters and holds no special string."""
        return self.known and self._odd(text) is None and not any(s in text for s in self.specials)

    def _piece(self, piece: str) -> bytes:
        return array("I", map(_ID, self._tokenize(mapped(piece)))).tobytes()

    def _word(self, word: str) -> bytes:
        letters = word[1:] if word[:1] == " " else word
        if letters.isalpha():
            return self._piece(word)
        # Most others are a word and the sign that ends a clause.
        if letters[-1:] in _ENDS and letters[:-1].isalpha():
            return self._of_piece[word[:-1]] + self._of_piece[word[-1]]
        return b"".join(map(self._of_piece.__getitem__, self._pieces(word)))

    def encode(self, text: str) -> np.ndarray:
        """Ids as ``encode(text, add_special_tokens=False)`` of the library gives them."""
        if not self.plain(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        for cache in (self._of_word, self._of_spaced, self._of_piece):
            cache.age()
        if self.lower or _double_space(text):
            return np.frombuffer(b"".join(map(self._of_word.__getitem__, self.words(text))), dtype=np.uint32)
        # Single spaces and newlines only: a space belongs to the word after it, a newline stands by itself.
        parts: list[bytes] = []
        for line in text.split("\n"):
            first, *words = line.split(" ")
            parts += (self._of_word["\n"], self._of_word[first])
            parts += map(self._of_spaced.__getitem__, words)
        return np.frombuffer(b"".join(parts[1:]), dtype=np.uint32)

    def _unit(self, unit: str) -> bytes:
        """Ids of a word after a space, of a newline with the word after it, or of a text's first word behind a return."""
        if unit.isalpha():
            if unit.isascii():
                return array("I", map(_ID, self._tokenize(_SHOWN_SPACE + unit))).tobytes()
            return self._piece(" " + unit)
        if unit[:1] == "\n":
            return self._of_word["\n"] + self._of_word[unit[1:]]
        if unit[:1] == "\r":
            return self._of_word[unit[1:]]
        if unit[-1:] in _ENDS and unit[:-1].isalpha():
            return self._of_unit[unit[:-1]] + self._of_piece[unit[-1]]
        return self._word(" " + unit)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """``encode`` of every text; single-spaced ones are split and looked up together."""
        found: list[np.ndarray | None] = [None] * len(texts)
        held = 0
        together: list[int] = []
        for i, text in enumerate(texts):
            if self.lower or len(text) > TOGETHER or not self.plain(text) or _double_space(text):
                found[i] = self.encode(text)
                continue
            if held + len(text) > TOGETHER:
                self._encode_together(texts, together, found)
                together, held = [], 0
            together.append(i)
            held += len(text)
        self._encode_together(texts, together, found)
        return found

    def _encode_together(self, texts: list[str], numbers: list[int], found: list[np.ndarray | None]) -> None:
        if not numbers:
            return
        for cache in (self._of_word, self._of_unit, self._of_piece):
            cache.age()
        # A newline goes with the word after it; a return, which these texts do not have, marks the first word.
        marked = pa.array(["\r" + texts[i].replace("\n", " \n") for i in numbers], pa.large_string())
        units = pc.split_pattern(marked, " ")
        numbered = pc.dictionary_encode(units.flatten())
        words = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self._of_unit.__getitem__, words))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        firsts = np.cumsum(sizes) - sizes
        which = numbered.indices.to_numpy()
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1] if len(ends) else 0)
        places += np.repeat(firsts[which] - ends + lengths, lengths)
        flat = np.frombuffer(b"".join(ids), dtype=np.uint32)[places]
        cuts = np.concatenate([[0], ends])[units.offsets.to_numpy()]
        for i, a, b in zip(numbers, cuts[:-1].tolist(), cuts[1:].tolist()):
            found[i] = flat[a:b]

    def words(self, text: str) -> list[str]:
        """White-space bounded parts of a plain text; no pre-token crosses them."""
        return self._words(text.lower() if self.lower else text)

    def pieces_of_word(self, word: str) -> list[str]:
        """Pre-tokens of a part, as the model sees them."""
        return list(map(mapped, self._pieces(word)))

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of any text, as the model sees them, and the number of special tokens beside them."""
        found, special = [], 0
        for part in self._special_parts(text):
            if part in self.specials:
                special += 1
            elif part:
                part = self.library.normalizer.normalize_str(part) if self.library.normalizer else part
                found += [piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(part)]
        return found, special

    def count(self, piece: str) -> int:
        """Tokens of a pre-token as the model sees it."""
        return len(self.library.model.tokenize(piece))


@lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    """One copy per Python worker."""
    return PreTokens(path)
