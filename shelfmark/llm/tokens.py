"""Token ids of whole texts by the tokenizers library, with a cache of the words it has seen.

The vocabulary's BPE joins nothing over white space, so a text's ids are those of its words in turn. Words
repeat, so each Python worker keeps the ids of the words that it met last and sends only new ones to the library.
A text of Latin-1 characters is taken apart further, into what the vocabulary's splitting makes of its small letters: runs of
letters and of marks, of which there are fewer different ones than words with marks and capitals.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array
from string import punctuation

import numpy as np

#: Words in either of the two generations that a worker keeps ids of.
CACHE = 250_000
#: Longer words are not kept, so that the cache is bounded in bytes too.
LONGEST = 48
_encoders: dict[str, "WordEncoder"] = {}
#: Byte-level vocabularies write printable bytes as themselves, and the others as characters from 256 on, in order.
_printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
#: Letters below this are in normal form, and become small one by one.
LATIN = "\u0250"
#: The normalisation and splitting that PIECES stands for. No character of Latin-1 is composed with another, or changes but to its small letter.
NORMAL = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
_letters, _digits, _spaces = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
#: Each with the white space before it, which is found faster than searched over; that at a text's end is taken off.
PIECES = re.compile(f"[{_spaces}]*([{_letters}]+|[{_digits}]|'(?:[stmd]|re|ve|ll)|[^{_spaces}{_letters}{_digits}]+)")
AT_END = "\t\n\v\f\r \x85\xa0"
_others = iter(range(256, 512))
BYTE_NAMES = "".join(chr(b if b in _printable else next(_others)) for b in range(256))


class WordEncoder(dict):
    """word -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, most: int = CACHE):
        self.most = most
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.older: dict[str, bytes] = {}
        normal = self.library.normalizer.__getstate__().decode() if self.library.normalizer else ""
        splits = self.library.pre_tokenizer.__getstate__().decode() if self.library.pre_tokenizer else ""
        added = self.library.get_added_tokens_decoder().values()
        self.added = [x.content for x in added]
        #: Whether words can be taken alone: white space is dropped, and added tokens don't reach over it.
        self.apart = r"[^\\s" in splits and '"behavior":"Removed"' in splits.replace(" ", "") and not any(x.lstrip or x.rstrip or " " in x.content for x in added)

        #: Whether a word of letters alone is one piece for the model, which knows bytes by names.
        self.letters = '"Lowercase"' in normal and self.apart and r"|[\\p{L}]+|" in splits and '"ByteLevel","add_prefix_space":false' in splits
        if self.letters:
            self.normalise, self.tokenize = self.library.normalizer.normalize_str, self.library.model.tokenize
        #: Whether texts of Latin-1 can be taken apart into PIECES; added tokens are looked for in texts as they are.
        self.pieces = self.letters and json.loads(normal) == NORMAL and _splitting(splits) == SPLIT and not any(x.normalized for x in added)

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._new(word)
        if len(word) > LONGEST:
            return ids
        if len(self) >= self.most:  # words that are met again come back from the older ones
            self.older = self.copy()
            self.clear()
        self[word] = ids
        return ids

    def _new(self, word: str) -> bytes:
        if self.letters and word.isalpha():
            plain = word.lower() if word.isascii() or max(word) < LATIN else self.normalise(word)
            if plain != word and (ids := self.get(plain) or self.older.get(plain)) is not None:
                return ids
            if plain.isascii():
                return array("I", [x.id for x in self.tokenize(plain)]).tobytes()
            if plain.isalpha():
                return array("I", [x.id for x in self.tokenize(codecs.charmap_decode(plain.encode(), "strict", BYTE_NAMES)[0])]).tobytes()
        elif self.letters and not self._holds_added(word):
            base = word.rstrip(punctuation)
            if base and len(base) < len(word) and self._ends_in_letter(base[-1]):
                return self[base] + self[word[len(base) :]]  # the vocabulary's splitting ends words of letters there
        return array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()

    def _holds_added(self, text: str) -> bool:
        return any(x in text for x in self.added)

    def _ends_in_letter(self, c: str) -> bool:
        """Whether a character is a letter, and what normalisation makes of it ends in one: some come apart into a letter and a
        mark, and marks go with what follows."""
        return c.isalpha() and (len(c.lower()) == 1 if c < LATIN else self.normalise(c)[-1:].isalpha())

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; none for null."""
        if not text:
            return b""
        if not self.apart:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.pieces and _latin(text) and not self._holds_added(text):
            return b"".join(map(self.__getitem__, PIECES.findall(text.lower().rstrip(AT_END))))
        return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))


def _splitting(state: str) -> dict | None:
    """The pattern of a splitting that keeps what fits it and then names its bytes; else none."""
    steps = json.loads(state).get("pretokenizers", [])
    if [x["type"] for x in steps] != ["Split", "ByteLevel"]:
        return None
    cut, named = steps
    kept = cut["behavior"] == "Removed" and cut["invert"] and not named["add_prefix_space"] and not named["use_regex"]
    return cut["pattern"] if kept else None


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def encoder(path: str, most: int = CACHE) -> WordEncoder:
    """most: words in either generation of the cache."""
    if path not in _encoders or _encoders[path].most != most:
        _encoders[path] = WordEncoder(path, most)
    return _encoders[path]
