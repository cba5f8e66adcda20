"""Substring dedup against all windows compared as text."""

import random
import re

import pytest
from conftest import ODD_ROWS
from pyspark.sql import functions as F

from basketry.llm import substrings


def plain(rows, length):
    """(doc_id, n_words, n_removed, kept text) of every row."""
    listed = [(row[0], re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")) for row in rows]
    least = {}
    for doc, w in listed:
        for i in range(len(w) - length + 1):
            if doc is not None:
                key = tuple(w[i : i + length])
                least[key] = min(least.get(key, doc), doc)
    out = []
    for doc, w in listed:
        gone = set()
        for i in range(len(w) - length + 1):
            if doc is not None and least[tuple(w[i : i + length])] < doc:
                gone.update(range(i, i + length))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def found(frame, length):
    kept = substrings.without_repeats(frame, length)
    return sorted((tuple(row)[:4] for row in kept.collect()), key=str), kept


def corpus(number, seed, letters=3, longest=60):
    """Texts over few words, so that repeats of any length and place abound, with copied parts."""
    rng = random.Random(seed)
    rows = []
    for doc in range(number):
        text = [rng.choice("abcdefgh"[:letters]) for _ in range(rng.randint(0, longest))]
        for _ in range(rng.randint(0, 3)):
            if rows:
                other = rng.choice(rows)[1].split()
                a = rng.randint(0, len(other))
                b = min(len(other), a + rng.randint(0, 40))
                at = rng.randint(0, len(text))
                text[at:at] = other[a:b]
        gaps = [rng.choice([" ", "  ", "\n", " \t"]) for _ in text]
        rows.append((rng.randint(0, 2 * number), "".join(w + g for w, g in zip(text, gaps, strict=True)), "en", "a", 0))
    return rows


@pytest.mark.parametrize(("letters", "length"), [(2, 6), (3, 8), (8, 13), (4, 13), (3, 2)])
def test_equals_all_windows(docs, letters, length):
    rows = corpus(60, seed=letters * length, letters=letters)
    assert found(docs(rows), length)[0] == plain(rows, length)


def test_odd_rows(docs):
    rows = [*ODD_ROWS, (10, "word " * 40, "en", "a", 1), (11, "x y " * 30, "en", "a", 1), (11, "x y " * 30, "en", "a", 1), (12, "x y " * 20, None, None, None)]
    frame = docs(rows)
    for name in ("version", "anchor", "covers", "hash", "place", "source"):
        frame = frame.withColumn(name, F.lit("clash"))
    assert found(frame, 13)[0] == plain(rows, 13)
    assert found(docs([]), 13)[0] == []


def test_one_id_on_several_texts(docs):
    shared = " ".join(f"w{i}" for i in range(30))
    rows = [(4, shared, None, None, 0), (4, f"a b {shared}", None, None, 0), (9, f"{shared} c", None, None, 0), (2, "a b " + shared[:60], None, None, 0)]
    assert found(docs(rows), 13)[0] == plain(rows, 13)


def test_many_copies_and_a_common_passage(docs):
    """A third of all rows are copies, and many others share a passage in different places."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(55)]
    copy = " ".join(f"c{i}" for i in range(80))
    rows = [(i, copy, "en", "a", 0) for i in range(150)]
    for i in range(150, 400):
        own = [f"o{rng.randint(0, 500)}" for _ in range(40)]
        at = rng.randint(0, 40)
        cut = passage[rng.randint(0, 20) : rng.randint(30, 55)] if i % 2 else passage
        rows.append((i, " ".join(own[:at] + cut + own[at:]), "en", "a", 0))
    rng.shuffle(rows)
    result, kept = found(docs(rows), 13)
    assert result == plain(rows, 13)
    texts = {row[0]: row[1].split() for row in rows}
    for doc, _, _, _, repeats in kept.collect():
        for start, end, source, place in repeats:
            assert source < doc and end - start >= 13
            assert texts[doc][start:end] == texts[source][place : place + end - start]


def test_a_full_sieve_changes_nothing(docs, monkeypatch):
    monkeypatch.setattr(substrings, "FILTER_BITS", 1)
    rows = corpus(40, seed=1, letters=6)
    assert found(docs(rows), 13)[0] == plain(rows, 13)
