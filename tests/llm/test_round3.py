"""What round 3 found in the operators."""

from __future__ import annotations

import time
from collections import Counter

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from shelfmark.llm import substrings
from shelfmark.llm.common import text_bytes, window_hashes, word_hashes, word_spans
from shelfmark.llm.tokens import WordEncoder
from tests.llm.tables import frame, words
from tests.llm.test_substrings import removed

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_marks_after_words_do_not_go_to_the_library():
    """op7: a word of letters and whatever marks end it is two entries of the cache; ids are the library's."""

    class Counting:
        def __init__(self, library):
            self.library, self.calls = library, []

        def encode(self, word, **how):
            self.calls.append(word)
            return self.library.encode(word, **how)

    encode, library = WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    encode.library = Counting(library)
    words = ["Thing$$$", "thing,***", "Ärger!!", "over.%%%", "x</", "it's", "'s", "a'", "thing", "THING", "b2..", "क़..", "ﬁ''"]
    text = " ".join(words)
    assert list(memoryview(encode.encode(text)).cast("I")) == library.encode(text, add_special_tokens=False).ids
    assert set(encode.library.calls) == {"$$$", ",***", "!!", ".%%%", "</", "it's", "'s", "'", "b2..", "क़..", "''"}


def ids(encode, text):
    return list(memoryview(encode.encode(text)).cast("I"))


def test_texts_of_latin_letters_are_known_by_their_pieces():
    """F1 op4: marks and capitals make no new entries of the cache, and small texts in any two characters have the library's ids."""
    encode, library = WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    assert ids(encode, "The thing, the THING! (Thing) ÄRGER, it's\n") == library.encode("The thing, the THING! (Thing) ÄRGER, it's", add_special_tokens=False).ids
    assert set(encode) == {"the", "thing", ",", "!", "(", ")", "ärger", "it", "'s"}
    every = [chr(i) for i in range(256)]
    texts = [t for a in every for b in every for t in (a + b, f"x{a}{b}s y")]
    assert [t for t, x in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True) if ids(encode, t) != x.ids] == []


def test_names_of_added_tokens_are_those_tokens():
    """F1 op4: an added token's name is one id wherever it stands, before marks and in texts of other letters too."""
    encode, library = WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    for name in ("<|endoftext|>", "<|startoftext|>"):
        for text in (name, f"a {name} b", f"{name}.", f"a{name}!!", f"क {name}, ж", f"{name.upper()}.", f"ж {name.upper()}."):
            assert ids(encode, text) == library.encode(text, add_special_tokens=False).ids, text


def test_time_of_white_space_is_linear():
    """F1 op4: no run of white space is gone over again from each of its places."""
    encode = WordEncoder(WORDS)
    for text in (" " * 1_000_000, "a" + "\t" * 1_000_000, " \n" * 500_000 + "é"):
        began = time.process_time()
        assert len(encode.encode(text)) // 4 == len(text.split())
        assert time.process_time() - began < 2


def test_frequent_anchors_are_counted_in_all_texts(spark, monkeypatch):
    """passages that stand in some of many texts are found by their counts in all of them, whatever the bytes."""
    from pyspark.sql import DataFrame

    monkeypatch.setattr(DataFrame, "sample", lambda *_, **__: 1 / 0)
    monkeypatch.setattr(substrings, "SHARE", 1 << 12)
    passage = words(7, 8, 1000)
    rows = [(i, words(1000 + i, 12, 1000) + (f" {passage}" if i % 2 else "")) for i in range(400)]
    size = sum(len(t) for _, t in rows)
    docs = frame(spark, rows)
    want = window_hashes(word_hashes(*(lambda d, o: (d, *word_spans(d, o)[:2]))(*text_bytes(pa.array([passage])))), 8)
    for parts in (1, 5):
        assert substrings._frequent(docs.select("text").coalesce(1).repartition(parts), 20, 8 * size / (1 << 12)).tolist() == want.tolist()
    got = substrings.find_repeats(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert Counter(map(tuple, got)) == Counter((i, *r) for (i, _), r in zip(rows, removed(rows, 20), strict=True))
