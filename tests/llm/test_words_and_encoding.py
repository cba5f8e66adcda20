"""Words and token ids against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import words
from basketry.llm.encoding import Encoder

TEXT = st.text(alphabet=st.sampled_from("aZ9é日 \n\t\r\x0b\x0c.!'’<|>Ï ß"), max_size=40)


def packed(texts):
    return words.text_bytes(pa.array(texts, pa.string()))


@given(st.lists(TEXT, max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_are_runs_without_ascii_white_space(texts):
    data, offsets = packed(texts)
    starts, ends, first = words.spans(data, offsets)
    raw = data.tobytes()
    found = [raw[a:b].decode() for a, b in zip(starts, ends, strict=True)]
    expected = [re.findall(r"[^\x20\x09-\x0d]+", t) for t in texts]
    assert [found[a:b] for a, b in zip(first, first[1:], strict=False)] == expected
    hashes = words.hashes(data, starts, ends).tolist()
    assert len(set(zip(found, hashes, strict=True))) == len(set(found)) == len(set(hashes))


def test_hash_of_a_word_does_not_depend_on_its_place(monkeypatch):
    data, offsets = packed(["one two three " * 50])
    starts, ends, _ = words.spans(data, offsets)
    whole = words.hashes(data, starts, ends)
    monkeypatch.setattr(words, "_SEGMENT", 16)
    assert (words.hashes(data, starts, ends) == whole).all()
    assert len(set(whole.tolist())) == 3


def test_blocks_hold_whole_texts_and_nulls():
    texts = ["a" * 10, None, "", "b" * 50, "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(words.blocks([batch], limit=12))
    found = [data[a:b].tobytes().decode() for _, data, o in parts for a, b in zip(o, o[1:])]
    assert found == [t or "" for t in texts]
    assert len(parts) > 1


@pytest.mark.parametrize("spaced", [True, False])
def test_encoding_equals_the_library(spaced, byte_tokenizer, word_tokenizer):
    # Few slots, so that words lose their place and are encoded again.
    encoder = Encoder(byte_tokenizer if spaced else word_tokenizer, spaced, slots=64)

    @given(st.lists(TEXT, min_size=1, max_size=6))
    @settings(max_examples=150, deadline=None)
    def check(texts):
        ids, places = encoder.encode(*packed(texts), end_id=3)
        for text, a, b in zip(texts, places, places[1:], strict=False):
            expected = encoder.library.encode(text, add_special_tokens=False).ids
            assert ids[a:b].tolist() == [*expected, 3]

    check()


@pytest.mark.parametrize("name", ["byte_tokenizer", "word_tokenizer"])
def test_special_strings_have_their_ids(request, name):
    path = request.getfixturevalue(name)
    encoder = Encoder(path, name == "byte_tokenizer")
    library = Tokenizer.from_file(path)
    marks = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "plain", "ends", "?"]
    rng = random.Random(4)
    texts = ["<|endoftext|>", "a <|endoftext|> b", "", "x" * 50 + "<|endoftext|>" * 3]
    texts += ["".join(rng.choice(marks) + rng.choice(["", " ", "  ", "\n"]) for _ in range(rng.randint(0, 8))) for _ in range(300)]
    ids, places = encoder.encode(*packed(texts), end_id=3)
    for text, a, b in zip(texts, places, places[1:], strict=False):
        assert ids[a:b].tolist() == [*library.encode(text, add_special_tokens=False).ids, 3], text


def test_kept_ids_start_anew(byte_tokenizer):
    encoder = Encoder(byte_tokenizer, True, kept_ids=10)
    texts = [f"word{i} and more {i}" for i in range(40)]
    for _ in range(3):
        ids, places = encoder.encode(*packed(texts), end_id=0)
    last = encoder.library.encode(texts[-1], add_special_tokens=False).ids
    assert ids[places[-2] : -1].tolist() == last
    assert isinstance(ids, np.ndarray)


def test_new_words_go_to_the_library_as_one_text(byte_tokenizer, monkeypatch):
    """So that a word costs its ids, and not a string and an encoding of its own as well; words
    with white space outside ASCII, or with special strings, still stand apart."""
    from basketry.llm import encoding

    monkeypatch.setattr(encoding, "_JOINED_BYTES", 256)
    encoder, apart = Encoder(byte_tokenizer, True), []
    whole = encoder._apart
    encoder._apart = lambda texts: apart.extend(texts) or whole(texts)
    texts = [f"new{i} 'word{i}'\nline{i}\t日{i}’s  é{i}…" for i in range(200)]
    odd = ["a b c", "   x", "\n \nq", "two  three"]
    special = ["s <|endoftext|>t"]
    for group, expected in ((texts, 0), (odd, 4), (special, 2)):
        apart.clear()
        ids, places = encoder.encode(*packed(group), end_id=3)
        for text, a, b in zip(group, places, places[1:], strict=False):
            assert ids[a:b].tolist() == [*encoder.library.encode(text, add_special_tokens=False).ids, 3]
        assert len(apart) == expected, apart
