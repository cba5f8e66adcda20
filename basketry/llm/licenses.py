"""License scans by template matching: every template is compiled into a token automaton.

A template is wording with two kinds of markup: ``<<optional>> ... <<end>>`` may be left out
(and may be nested), and ``<<any N>>`` stands for up to N words of any kind. All other words
are mandatory and must stand in the text exactly, one after another. Words are runs of
letters and digits after A-Z are lower-cased; punctuation, layout and capitals do not count.

A text is searched only if it holds the longest mandatory word of some template, and from
those places only where a template can begin; so texts without license wording cost one
search for a few words. Each template's automaton has as many states as words, and a place
is followed for at most that many words, whatever the length of the text.

Cases: a null or empty text has no words and no labels; repeated rows are scanned alike; a
place that several templates accept counts for each; an empty table gives an empty result;
further columns are ignored by the query and the scan keeps those asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm import words

#: Phrases of the base count and their labels (fixed values).
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: Labels of the method: wording of notices and of the licenses themselves (fixed values).
TEMPLATES = (
    ("mit", "<<optional>>released<<end>> under the <<optional>>terms of the<<end>> mit license"),
    ("mit", "licensed under <<optional>>the<<end>> <<optional>>terms of the<<end>> mit <<optional>>x11<<end>> license"),
    ("mit", """permission is hereby granted free of charge to any person obtaining a copy of
        <<any 12>> to deal in <<any 4>> without restriction including without limitation the
        rights to use copy modify merge publish distribute sublicense and or sell copies of
        <<any 4>> and to permit persons to whom <<any 4>> is furnished to do so"""),
    ("apache-2", """licensed under the apache license version 2 0 <<optional>>the license
        <<optional>>you may not use <<any 4>> except in compliance with the license<<end>><<end>>"""),
    ("apache-2", "apache software license <<optional>>version<<end>> 2 <<optional>>0<<end>>"),
    ("cc-by-nc", "<<optional>>licensed under<<end>> cc by nc <<optional>>4 0<<end>>"),
    ("cc-by-nc", """creative commons attribution non <<optional>>commercial<<end>>
        <<optional>>4 0 international<<end>> license"""),
    ("cc-by-nc", """creative commons attribution noncommercial
        <<optional>>4 0 international<<end>> <<optional>>public<<end>> license"""),
    ("cc-by", "licensed under <<any 2>> creative commons attribution <<any 2>> <<optional>>international<<end>> license"),
    ("cc0", "<<optional>>creative commons<<end>> cc0 1 0 <<optional>>universal<<end>>"),
    ("gpl-3", """<<optional>>this <<any 2>> is<<end>> licensed under the <<optional>>terms of
        the<<end>> gnu general public license <<optional>>as published by the free software
        foundation either<<end>> version 3"""),
    ("gpl-2", """<<optional>>this <<any 2>> is<<end>> licensed under the <<optional>>terms of
        the<<end>> gnu general public license <<optional>>as published by the free software
        foundation either<<end>> version 2"""),
    ("gpl-3", """you can redistribute it and or modify it under the terms of the gnu general
        public license as published by the free software foundation either version 3 of the
        license"""),
    ("gpl-2", """you can redistribute it and or modify it under the terms of the gnu general
        public license as published by the free software foundation either version 2 of the
        license"""),
    ("lgpl", "gnu <<optional>>lesser<<end>> <<optional>>library<<end>> lesser general public license"),
    ("bsd", """redistribution and use in source and binary forms with or without modification
        are permitted provided that the following conditions are met"""),
    ("bsd", "licensed under <<optional>>the<<end>> <<any 2>> bsd license"),
    ("mpl-2", """this source code form is subject to the terms of the mozilla public license
        v 2 0"""),
    ("isc", """permission to use copy modify and or distribute this software for any purpose
        with or without fee is hereby granted provided that the above copyright notice
        <<any 12>> appear in all copies"""),
)

#: Bytes between words once A-Z are lower-cased.
SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

_MARKUP = re.compile(r"<<optional>>|<<end>>|<<any (\d+)>>|[^\s<]+")


@dataclass(frozen=True)
class Automaton:
    """States in a row; ``words[i]`` leads from i to i + 1 (None: any word), ``skips[i]``
    lists the states reachable from i without a word. The last state accepts."""

    label: str
    words: tuple[bytes | None, ...]
    skips: tuple[tuple[int, ...], ...]
    anchor: bytes

    def closure(self, states: set[int]) -> set[int]:
        waiting = list(states)
        while waiting:
            for state in self.skips[waiting.pop()]:
                if state not in states:
                    states.add(state)
                    waiting.append(state)
        return states

    def first_words(self) -> set[bytes | None]:
        return {self.words[s] for s in self.closure({0}) if s < len(self.words)}

    def longest(self, tokens: list[bytes], start: int) -> int | None:
        """End of the longest run from ``start`` that is accepted."""
        states, end, last = self.closure({0}), None, len(self.words)
        for at in range(start, len(tokens)):
            token = tokens[at]
            states = {s + 1 for s in states if s < last and self.words[s] in (token, None)}
            if not states:
                break
            states = self.closure(states)
            if last in states:
                end = at + 1
        return end


def compiled(label: str, template: str) -> Automaton:
    """The automaton of a template; it must begin with a word or an optional region."""
    steps: list[bytes | None] = []
    skips: list[set[int]] = [set()]
    opened: list[int] = []
    mandatory: list[bytes] = []

    def step(word: bytes | None) -> None:
        steps.append(word)
        skips.append(set())

    for part in _MARKUP.finditer(template.lower()):
        if part[0] == "<<optional>>":
            opened.append(len(steps))
        elif part[0] == "<<end>>":
            skips[opened.pop()].add(len(steps))
        elif part[1]:
            begin = len(steps)
            for _ in range(int(part[1])):
                step(None)
            for state in range(begin, len(steps)):
                skips[state].add(len(steps))
        else:
            step(part[0].encode())
            if not opened:
                mandatory.append(part[0].encode())
    if opened or not mandatory:
        raise ValueError(f"template of {label}: regions must end, some words must stay")
    made = Automaton(
        label, tuple(steps), tuple(tuple(sorted(s)) for s in skips), max(mandatory, key=len)
    )
    if None in made.first_words():
        raise ValueError(f"template of {label}: it must begin with a word")
    return made


@lru_cache(maxsize=8)
def _automata(base: tuple, templates: tuple) -> tuple[list[bytes], dict]:
    """Anchors, and what can begin with each word: (is base, automaton)."""
    made = [(True, compiled(*x)) for x in base] + [(False, compiled(*x)) for x in templates]
    begins: dict[bytes, list[tuple[bool, Automaton]]] = {}
    for is_base, automaton in made:
        for word in automaton.first_words():
            begins.setdefault(word, []).append((is_base, automaton))
    return sorted({a.anchor for _, a in made}), begins


def scan(
    docs: DataFrame, *keep: str, base: tuple = BASE, templates: tuple = TEMPLATES
) -> DataFrame:
    """Columns ``keep`` with n_words and places: label, base, first word and words of each."""
    rows = docs.select(*keep, F.col("text").alias("__text"))
    place = "struct<label:string,base:boolean,first:long,words:long>"
    schema = f"{rows.drop('__text').schema.toDDL()}, n_words long, places array<{place}>"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, begins = _automata(base, templates)
        kind = pa.list_(
            pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()), ("words", pa.int64())])
        )
        for batch, data, offsets in words.blocks(batches, "__text"):
            lower = words.lower_ascii(data)
            _, _, first = words.spans(lower, offsets, SEPARATOR)
            raw, ends = lower.tobytes(), offsets.tolist()
            present = [a for a in anchors if a in raw]
            found = []
            for begin, end in zip(ends, ends[1:], strict=False):
                places = []
                if any(raw.find(a, begin, end) >= 0 for a in present):
                    tokens = _WORD.findall(raw, begin, end)
                    for at, token in enumerate(tokens):
                        for is_base, automaton in begins.get(token, ()):
                            stop = automaton.longest(tokens, at)
                            if stop is not None:
                                places.append((automaton.label, is_base, at, stop - at))
                found.append(places)
            kept = [c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "__text"]
            names = [n for n in batch.schema.names if n != "__text"]
            listed = [[dict(zip(("label", "base", "first", "words"), p, strict=True)) for p in x] for x in found]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(np.diff(first), pa.int64()), pa.array(listed, kind)],
                [*names, "n_words", "places"],
            )

    return rows.mapInArrow(search, schema)


def summarised(scanned: DataFrame, *keep: str) -> DataFrame:
    """Counts and labels per row: score is the share of words inside accepted places."""
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["first"])
    labels = lambda of: F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda p: p["label"]))), ",")
    # Places in order of their start; each adds what it has beyond the furthest end so far.
    ordered = F.array_sort(F.transform("places", lambda p: F.struct(p["first"].alias("a"), (p["first"] + p["words"]).alias("b"))))
    zero = F.lit(0).cast("long")
    inside = F.aggregate(
        ordered,
        F.struct(zero.alias("n"), zero.alias("end")),
        lambda s, p: F.struct(
            (s["n"] + F.greatest(p["b"] - F.greatest(p["a"], s["end"]), zero)).alias("n"),
            F.greatest(p["b"], s["end"]).alias("end"),
        ),
        lambda s: s["n"],
    )
    return scanned.select(
        *keep,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("places")).alias("labels"),
        (inside / F.greatest("n_words", F.lit(1))).alias("score"),
    )
