"""Token ids of whole texts by a public byte-level BPE file and the ``tokenizers`` library.

The library splits a text into words by a fixed pattern and merges inside words only, so the
ids of a word do not depend on its surroundings. Words repeat, so a task keeps the ids of words
it has seen (a bounded number) and calls the library for new ones. Texts with characters whose
class may differ between the two pattern engines, or with the text of a special token, go to the
library whole. The result is what ``encode(text, add_special_tokens=False)`` returns.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np

from tidemark.llm.common import kept_by_worker

KNOWN_WORDS = 600_000  # words remembered by a task before it starts anew
_SAFE_BELOW = 0x250  # characters whose letter and number classes no Unicode version changed


def _char_class(*kinds: str) -> str:
    chars = [c for c in range(_SAFE_BELOW) if unicodedata.category(chr(c))[0] in kinds]
    return "".join(f"\\u{c:04x}" for c in chars)


def word_pattern() -> re.Pattern:
    """The split pattern of the byte-level family (a fixed value), with its Unicode classes
    written out for the characters below ``_SAFE_BELOW``."""
    letter, number = _char_class("L"), _char_class("N")
    space = "".join(f"\\u{c:04x}" for c in (*range(9, 14), 0x20, 0x85, 0xA0))
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary: printable Latin-1
    bytes for themselves, the others for characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordIds(dict):
    """Ids of words as little-endian 32-bit integers; a new word is encoded on first use."""

    def __init__(self, model):
        super().__init__()
        self.model = model
        self.characters = byte_characters()

    def __missing__(self, word: str) -> bytes:
        spelled = word.encode().decode("latin-1").translate(self.characters)
        found = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found
        return found


class Encoder:
    """Encodes texts to ids as bytes, four for each id."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = WordIds(self.tokenizer.model)
        self.pattern = word_pattern()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unsafe = re.compile(f"[^\\u0000-\\u{_SAFE_BELOW - 1:04x}]")

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special) or not (
            text.isascii() or not self.unsafe.search(text)
        ):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, self.pattern.findall(text)))


def encoder(path: str) -> Encoder:
    return kept_by_worker(("byte_bpe", path), lambda: Encoder(path))
