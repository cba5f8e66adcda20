import re

import pytest

from basketry.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return [w.encode() for w in text.lower().split()]


@pytest.mark.parametrize(
    ("template", "text", "end"),
    [
        ("a b c", "a b c d", 3),
        ("a b c", "a b d", None),
        ("a <<optional>>b<<end>> c", "a c", 2),
        ("a <<optional>>b<<end>> c", "a b c", 3),
        ("a <<optional>>b <<optional>>x<<end>> y<<end>> c", "a b y c", 4),
        ("a <<optional>>b <<optional>>x<<end>> y<<end>> c", "a b x y c", 5),
        ("a <<optional>>b <<optional>>x<<end>> y<<end>> c", "a x y c", None),
        ("a <<any 2>> c", "a c", 2),
        ("a <<any 2>> c", "a q q c", 4),
        ("a <<any 2>> c", "a q q q c", None),
        ("a <<any 2>> c <<optional>>d<<end>>", "a c c d", 4),
    ],
)
def test_automaton(template, text, end):
    assert licenses.compiled("x", template).longest(tokens(text), 0) == end


@pytest.mark.parametrize("template", ["<<any 2>> a", "<<optional>>a", "<<optional>>a<<end>>"])
def test_bad_templates(template):
    with pytest.raises(ValueError, match="template of x"):
        licenses.compiled("x", template)


def scanned(docs, *texts):
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    result = licenses.summarised(licenses.scan(docs(rows), "doc_id"), "doc_id")
    return sorted(tuple(r) for r in result.collect())


def test_base_places_and_labels(docs):
    texts = [
        "Released under the MIT License. Again: UNDER-THE mit license",
        "Licensed under the Apache License, Version 2.0.",
        "CC BY-NC 4.0 and cc, by nc",
        "under the mit licenses; apache license version 20; ccby nc",
        None,
        "",
        "This work is licensed under the GNU General Public License, version 3.",
        "under theé mit license",
    ]
    found = scanned(docs, *texts)
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for (_, n_words, n_base, first, last, base, labels, score), text in zip(found, texts, strict=True):
        w = WORD.findall((text or "").translate(low))
        places = [
            (i, label)
            for label, phrase in licenses.BASE
            for i in range(len(w))
            if w[i : i + len(phrase.split())] == phrase.split()
        ]
        starts = [i for i, _ in places]
        assert (n_words, n_base) == (len(w), len(places))
        assert (first, last) == ((min(starts), max(starts)) if starts else (None, None))
        assert base == ",".join(sorted({x for _, x in places}))
        assert set(base.split(",")) <= set(labels.split(",")) | {""} and 0 <= score <= 1
    assert found[6][6] == "gpl-3" and found[3][6] == ""


def test_odd_rows(docs):
    result = licenses.summarised(licenses.scan(docs(), "doc_id"), "doc_id").collect()
    assert len(result) == docs().count()
    assert licenses.scan(docs([]), "doc_id").collect() == []
