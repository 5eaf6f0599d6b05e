"""Token ids of a public tokenizer, word by word."""

from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np
import regex

#: Words whose ids a task keeps; the frequent ones come early.
KEPT_WORDS = 400_000
#: Steps of the one kind of tokenizer whose words are encoded one by one.
_STEPS = (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"])
#: Letters and signs that the first two steps leave alone.
_LATIN = re.compile(r"[\x21-\x7e\xa1-įı-ɏ]+")
#: White space to Python but not to the tokenizer.
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes a byte as itself where it is a visible Latin-1 sign, the others as U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


@cache
def task_encoder(path: str) -> Encoder:
    """The encoder of a Python worker; the tasks it runs one after the other share the kept words."""
    return Encoder(path)


class Encoder:
    """``encode(text)`` gives the ids that the tokenizer file gives without special tokens.

    Where the tokenizer drops white space and never merges across it, each word is encoded
    once and kept; other tokenizers and texts with special tokens take the library's way.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.kept, self.ids = self.tokenizer.model, kept, {}
        spec = json.loads(self.tokenizer.to_str())
        kinds = [
            [s["type"] for s in ((spec.get(part) or {}).get(many) or [])]
            for part, many in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))
        ]
        self.by_word = tuple(kinds) == _STEPS
        if self.by_word:
            split = spec["pre_tokenizer"]["pretokenizers"][0]
            self.by_word = bool(split["invert"]) and split["behavior"] == "Removed" and r"\s" in split["pattern"]["Regex"]
            self.pieces = regex.compile(split["pattern"]["Regex"])
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.plain = self.by_word and not any(s.isalpha() or s[:-1].isalpha() for s in self.special)
        self.letters = _byte_letters()

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def word_ids(self, word: str) -> list[int]:
        """The ids of a text without white space."""
        if self.plain and word.isascii():
            if word.isalpha():
                return [t.id for t in self.model.tokenize(word.lower())]
            if word[:-1].isalpha() and word[-1] in ".,!?;:":
                return [t.id for part in (word[:-1].lower(), word[-1]) for t in self.model.tokenize(part)]
        if not (self.by_word and _LATIN.fullmatch(word)) or any(s in word for s in self.special):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        ids, tokenize, letters = [], self.tokenizer.model.tokenize, self.letters
        word = word.lower()
        # letters are one piece, and so is a sign after them
        pieces = [word] if word.isalpha() else [word[:-1], word[-1]] if word[:-1].isalpha() and word[-1] in ".,!?;:" else self.pieces.findall(word)
        for piece in pieces:
            ids += [t.id for t in tokenize(piece if piece.isascii() else piece.encode().decode("latin-1").translate(letters))]
        return ids

    def _new_word(self, word: str) -> bytes:
        found = np.array(self.word_ids(word), np.uint32).tobytes()
        if len(self.ids) < self.kept and len(word) <= 64:
            self.ids[word] = found
        return found

    def encode_word(self, word: str) -> bytes:
        """The ids, as bytes, of a text without ASCII white space."""
        return self.ids.get(word) or (self._new_word(word) if self.by_word else self.whole(word).tobytes())

    def words(self, text: str) -> list[bytes] | None:
        """The ids of each word as bytes; None if the text can't be cut at its white space."""
        if not self.by_word or _ODD_SPACE.search(text) or any(s in text for s in self.special):
            return None
        kept = self.ids.get
        return [kept(w) or self._new_word(w) for w in text.split()]

    def encode(self, text: str | None) -> np.ndarray:
        found = self.words(text or "")
        return self.whole(text) if found is None else np.frombuffer(b"".join(found), np.uint32)
