"""SentencePiece encoding that keeps each piece's bytes in the original text, and decoding.

A text is first normalised as the model says: at each place the longest prefix that the model's compiled character
map holds (a double-array trie over UTF-8 bytes, with a table of replacements) is replaced, and anything else is
kept. Every normalised byte remembers the source byte it came from, so each piece, a run of normalised bytes,
projects to a span of the original. The spans of a text's pieces follow each other without gaps.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "doc_id long, ids binary, starts binary, ends binary, decoded string"
#: Most words that a worker keeps ids of; then it starts anew.
CACHE = 400_000
SPACE = "▁"
_encoders: dict[str, "PieceEncoder"] = {}


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""

    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (message[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if message[i - 1] < 128:
                return value, i

    i = 0
    while i < len(message):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], i)
            value, i = message[i : i + size], i + size
        yield key >> 3, value


class CharacterMap:
    """A compiled character map: the size of a double-array trie, the trie's units, and replacements ended by zeros."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = struct.unpack(f"<{size // 4}I", blob[4 : 4 + size])
        self.texts = blob[4 + size :]
        begins = [b for b in range(256) if self.units and self.units[n := self.offset(self.units[0]) ^ b] & ((1 << 31) | 255) == b and n]
        self.begins = re.compile(b"[" + re.escape(bytes(begins)) + b"]") if begins else None

    @staticmethod
    def offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def candidates(self, data: bytes) -> list[int]:
        """Places of the bytes that keys begin with."""
        return [m.start() for m in self.begins.finditer(data)] if self.begins else []

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest key that data has at this place."""
        if not self.units:
            return None
        node, found = self.offset(self.units[0]), None
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(self.units) or self.units[node] & ((1 << 31) | 255) != data[i]:
                break
            unit = self.units[node]
            node ^= self.offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & ((1 << 31) - 1)
        return found and (found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])])


class PieceEncoder(dict):
    """word -> ids as little-endian unsigned 32-bit integers, for words that follow one space."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)
        model = open(path, "rb").read()
        rules = dict(x for k, v in fields(model) if k == 3 for x in fields(v))
        self.map = CharacterMap(rules.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(rules.get(k, 1)) for k in (3, 4, 5))
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        single = [self.library.is_byte(i) for i in range(len(pieces))]
        control = [self.library.is_control(i) for i in range(len(pieces))]
        #: Normalised bytes of each piece; an unknown piece takes what its neighbours leave.
        self.sizes = np.array([0 if c else 1 if b else len(p.encode()) for p, b, c in zip(pieces, single, control, strict=True)], np.int64)
        self.unknown = self.library.unk_id()
        #: Whether words are encoded alike alone: no piece goes on after a space that follows something else.
        self.apart = not self.map.units and self.prefix and self.escape and not self.squeeze and not any(SPACE in p.lstrip(SPACE) for p in pieces)

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.library.encode(word), "<u4").tobytes()
        if len(self) >= CACHE:
            self.clear()
        self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as the library gives them."""
        if not text:
            return b""
        if not self.apart or SPACE in text or "  " in text or text[0] == " " or text[-1] == " ":
            return np.array(self.library.encode(text), "<u4").tobytes()
        return b"".join(map(self.__getitem__, text.split(" ")))

    def normalise(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The normalised text's bytes, and for each of them, and their end, the source byte where it comes from.

        The map is asked where a byte stands that some key begins with; what lies between such places is kept as it is.
        """
        data, space = text.encode(), np.frombuffer((SPACE if self.escape else " ").encode(), np.uint8)
        raw, i, emptied = np.frombuffer(data, np.uint8), 0, len(data)
        new, source = [], []
        for place in self.map.candidates(data):
            hit = self.map.longest(data, place) if place >= i else None
            if hit:
                size, text_of = hit
                own = np.arange(size) if len(text_of) == size else np.zeros(len(text_of), np.int64)
                new += [raw[i:place], np.frombuffer(text_of, np.uint8)]
                source += [np.arange(i, place), place + own]
                emptied = emptied if text_of else min(emptied, place)
                i = place + size
        out = np.concatenate([*new, raw[i:]])
        source = np.concatenate([*source, np.arange(i, len(raw))])
        blank = out == 0x20
        if self.squeeze:  # spaces at the beginning go, and runs become one
            stay = ~(blank & np.append(True, blank[:-1])[: len(blank)])
            out, source, blank = out[stay], source[stay], blank[stay]
        first = min([emptied, *source[:1]])  # where what is left of the text begins
        sizes = np.where(blank, len(space), 1)
        out, source = np.repeat(out, sizes), np.repeat(source, sizes)
        if self.escape:
            at = np.flatnonzero(np.repeat(blank, sizes)).reshape(-1, len(space))
            out[at] = space
        if self.prefix and (len(out) or emptied < len(data)):
            out, source = np.concatenate([space, out]), np.concatenate([np.full(len(space), first), source])
        end, size = len(raw), len(out)
        while self.squeeze and size >= len(space) and (out[size - len(space) : size] == space).all():  # those that the text has itself, too
            size -= len(space)
            end = source[size]
        return out[:size], np.append(source[:size], end)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last source byte (exclusive) of each id of a text."""
        normal, source = self.normalise(text)
        sizes = self.sizes[ids]
        strange = np.flatnonzero(ids == self.unknown)
        if len(strange):  # the library gives one id for a run of unknown characters
            at = 0
            for i, k in enumerate(ids):
                if k == self.unknown:
                    rest = normal[at:].tobytes()
                    sizes[i] = next((j for j in range(1, len(rest)) if i + 1 < len(ids) and ids[i + 1] != self.unknown and rest[j:].startswith(self.library.id_to_piece(int(ids[i + 1])).encode())), len(rest))
                at += sizes[i]
        ends = np.minimum(np.cumsum(sizes), len(source) - 1)
        return source[np.concatenate([[0], ends[:-1]]).astype(np.int64)] if len(ids) else ends, source[ends] if len(ids) else ends


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def encode_pieces(docs: DataFrame, model: str, begin: bool = True, end: bool = True) -> DataFrame:
    """Per document: doc_id, ids (little-endian unsigned 32-bit), starts and ends (source bytes of each id, little-endian
    signed 32-bit; begin and end ids are empty spans at the text's two ends), decoded (the library's decode of the ids).

    docs needs doc_id and text; other columns are ignored. Null and empty texts have the begin and end ids alone.
    Repeated rows are encoded each.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from shelfmark.llm.common import slices

        e = encoder(model)
        first = [e.library.bos_id()] if begin else []
        last = [e.library.eos_id()] if end else []
        for whole in batches:
            for b in slices(whole):
                rows = []
                for text in b.column(1).to_pylist():
                    ids = np.frombuffer(e.encode(text or ""), "<u4")
                    starts, ends = e.spans(text or "", ids)
                    size = len((text or "").encode())
                    all_ids = np.concatenate([first, ids, last]).astype("<u4")
                    rows.append((all_ids, *(np.concatenate([[0] * len(first), x, [size] * len(last)]).astype("<i4").tobytes() for x in (starts, ends))))
                texts = e.library.decode([x[0].tolist() for x in rows])
                columns = [pa.array([x[0].tobytes() for x in rows], pa.binary()), *(pa.array([x[i] for x in rows], pa.binary()) for i in (1, 2)), pa.array(texts, pa.string())]
                yield pa.record_batch([b.column(0), *columns], names=["doc_id", "ids", "starts", "ends", "decoded"])

    return docs.select("doc_id", "text").mapInArrow(encoded, SCHEMA)
