"""Pieces, spans and decoded texts against the library; character maps against the library with a model that has one."""

from __future__ import annotations

import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from shelfmark.llm import pieces
from tests.llm.tables import frame
from tests.llm.test_operators import corpus  # noqa: F401

PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["  two  spaces ", "\u2581 a\u2581b", "\u0000x\n\ty", "é \u6f22\u5b57 \U0001f600 x", " ", "a", "\u2581", "tail \u2581 "]


def joined(library, ids, starts, ends):
    """(ids, start, end) of each piece, byte pieces of one character together: the library gives these one span."""
    out = []
    for i, s, e in zip(ids, starts, ends, strict=True):
        if out and library.is_byte(i) and library.is_byte(out[-1][0][-1]):
            out[-1] = ((*out[-1][0], i), out[-1][1], e)
        else:
            out.append(((i,), s, e))
    return out


def said(library, text):
    found = library.encode(text, return_type="proto").pieces
    return joined(library, [p.id for p in found], [p.begin for p in found], [p.end for p in found])


def test_pieces(spark, corpus):  # noqa: F811
    library = SentencePieceProcessor(model_file=PIECES)
    rows = [*corpus, *((70 + i, t) for i, t in enumerate(ODD))]
    want, spans = Counter(), {}
    for i, t in rows:
        ids = [1, *library.encode(t or ""), 2]
        want[i, np.array(ids, "<u4").tobytes(), library.decode(ids)] += 1
        spans[np.array(ids, "<u4").tobytes(), len((t or "").encode())] = said(library, t or "")
    got = pieces.encode_pieces(frame(spark, rows), PIECES).collect()
    assert Counter((r["doc_id"], bytes(r["ids"]), r["decoded"]) for r in got) == want
    for r in got:
        ids, starts, ends = np.frombuffer(r["ids"], "<u4").tolist(), np.frombuffer(r["starts"], "<i4").tolist(), np.frombuffer(r["ends"], "<i4").tolist()
        assert starts[0] == ends[0] == 0 and starts[-1] == ends[-1]
        assert starts[2:-1] == ends[1:-2]  # no gaps
        assert joined(library, ids[1:-1], starts[1:-1], ends[1:-1]) == spans[bytes(r["ids"]), ends[-1]]
    assert pieces.encode_pieces(frame(spark, []), PIECES).isEmpty()


def compiled(rules):
    """A character map in its published format: a double-array trie, each node's children in 256 units of their own."""
    texts, places = b"", {}
    for new in rules.values():
        places.setdefault(new, len(texts))
        texts += new.encode() + b"\0"
    root: dict = {}
    for key, new in rules.items():
        node = root
        for byte in key.encode():
            node = node.setdefault(byte, {})
        node[-1] = places[new]
    units, bases = {}, 0

    def place(node, at, label):
        nonlocal bases
        bases += 256
        base = bases
        units[at] = (at ^ base) << 10 | (256 if -1 in node else 0) | label
        if -1 in node:
            units[base] = 1 << 31 | node[-1]
        for byte, child in node.items():
            if byte >= 0:
                place(child, base ^ byte, byte)

    place(root, 0, 0)
    array = [units.get(i, 0) for i in range(bases + 256)]
    return struct.pack("<I", 4 * len(array)) + struct.pack(f"<{len(array)}I", *array) + texts


def varint(n):
    return bytes([n & 127 | 128]) + varint(n >> 7) if n > 127 else bytes([n])


def message(fields):
    return b"".join(varint(k << 3 | 2) + varint(len(v)) + v if isinstance(v, bytes) else varint(k << 3) + varint(v) for k, v in fields)


RULES = {"\ufb01": "fi", "\u2460": "1", "e\u0301": "\u00e9", "\u3000": " ", "\uff21": "A", "\uff21\uff22": "ab", "\t": " ", "\u200b": "", "abc": "a", "abcd": "xyz", "\U0001f600": ":)", "\u00df": "ss"}


@pytest.mark.parametrize(("prefix", "squeeze"), [(1, 0), (1, 1), (0, 0), (0, 1)])
def test_character_maps(tmp_path, prefix, squeeze):
    model = list(pieces.fields(open(PIECES, "rb").read()))
    rules = message([(1, b"own"), (2, compiled(RULES)), (3, prefix), (4, squeeze), (5, 1)])
    path = str(tmp_path / "own.model")
    with open(path, "wb") as f:
        # scores are 32-bit floats inside pieces, which stay as they are
        f.write(message([(k, rules if k == 3 else v) for k, v in model]))
    library, own = SentencePieceProcessor(model_file=path), pieces.PieceEncoder(path)
    assert own.map.longest("\uff21\uff22x".encode(), 0) == (6, b"ab") and own.map.longest(b"abcdx", 0) == (4, b"xyz")
    assert own.map.longest(b"abx", 0) is None and own.map.longest("\u200b".encode(), 0) == (3, b"")
    texts = [*ODD, "\ufb01n \u2460 cafe\u0301", "\uff21\uff22\uff21 abcd abc ab", "\u3000lead\u3000\u3000mid\tend\u3000", "\u200b", "\u200bx\u200b y", "\U0001f600\u00df\U0001f600", "", "stra\u00dfe  \ufb01\ufb01"]
    for t in texts:
        assert own.normalise(t)[0].tobytes().decode() == library.normalize(t), t
        ids = np.frombuffer(own.encode(t), "<u4")
        assert ids.tolist() == library.encode(t)
        starts, ends = own.spans(t, ids)
        assert joined(library, ids.tolist(), starts.tolist(), ends.tolist()) == said(library, t), t
