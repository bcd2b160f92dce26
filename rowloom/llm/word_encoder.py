"""Texts to token ids with the tokenizers library, remembering the ids of words.

A byte-level BPE with the usual word pattern merges inside words only, so a word's ids can be remembered. That is done
where it is sure to give the library's ids: the tokenizer file asks for exactly that and nothing else, and the text has only
characters below U+0250, whose classes every Unicode version shares, and none of the special tokens. All other texts and
tokenizers go through the library as they are.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

WORDS = 400_000  # words whose ids a worker remembers; the first ones stay, and they are the frequent ones

# The byte alphabet and the word pattern of byte-level BPE, with the character classes up to U+024F.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
LETTERS, NUMBERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WORD = re.compile(
    f"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
FOREIGN = re.compile("[^\x00-ɏ]")


def alphabet() -> dict[int, str]:
    """The printed character of each byte: itself, or the next free one from U+0100 on."""
    others = [b for b in range(256) if b not in PRINTED]
    return {b: chr(b) for b in PRINTED} | {b: chr(256 + i) for i, b in enumerate(others)}


class ForeignText(Exception):
    """The text has characters whose class is left to the library."""


class WordIds(dict):
    """The ids of a word as little-endian unsigned 32-bit integers."""

    def __init__(self, model):
        super().__init__()
        self.model, self.alphabet = model, alphabet()

    def __missing__(self, word: str) -> bytes:
        if FOREIGN.search(word):
            raise ForeignText
        printed = word.encode("utf-8").decode("latin-1").translate(self.alphabet)
        value = array("I", [t.id for t in self.model.tokenize(printed)])
        if value.itemsize != 4:
            raise OSError("unsigned integers of four bytes are needed")
        found = value.tobytes()
        if len(self) < WORDS:
            self[word] = found
        return found


class Encoder:
    """Encodes texts without special tokens at the ends, as ``add_special_tokens=False`` does."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        first, model = said.get("pre_tokenizer") or {}, said["model"]
        plain = (first.get("type"), first.get("use_regex"), first.get("add_prefix_space")) == ("ByteLevel", True, False)
        plain &= model.get("type") == "BPE" and not any(said.get(k) for k in ("normalizer", "truncation", "padding"))
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback")
        plain &= not any(model.get(k) for k in (*odd, "ignore_merges"))
        self.words = WordIds(self.tokenizer.model) if plain else None
        self.special = [t["content"] for t in said.get("added_tokens", [])]

    def ids(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.words is not None and not any(s in text for s in self.special):
            try:
                return b"".join(map(self.words.__getitem__, WORD.findall(text)))
            except ForeignText:
                pass
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file; a Python worker keeps it, and its words, from task to task."""
    return Encoder(path)
