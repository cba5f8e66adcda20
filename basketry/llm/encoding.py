"""Token ids of many texts through a public tokenizer, each distinct word encoded once.

The tokenizers used here never merge across ASCII white space (the word tokenizer) or
across a space before a word (the byte tokenizer, where that space belongs to the word).
So a text's ids are those of its words put together, and ids of words seen before come
from a table. A text with other white space, or with one of the tokenizer's special strings,
is given to the library whole. The result is that of ``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache, partial

import numpy as np

from basketry.llm import words

#: Slots for words a worker keeps (a power of two), and ids kept before it starts anew.
SLOTS = 1 << 20
KEPT_IDS = 4_000_000

_U64 = np.uint64
_SPACED = _U64(0x5851F42D4C957F2D)
#: First bytes of white space other than ASCII's six, and of marks libraries treat alike.
_SUSPECT = np.zeros(256, dtype=bool)
_SUSPECT[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Bytes of new words given to the library as one text.
_JOINED_BYTES = 1 << 17
_OTHER_WHITE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -     　]")


class Encoder:
    def __init__(self, path: str, spaced: bool, slots: int = SLOTS, kept_ids: int = KEPT_IDS):
        """``spaced``: a space before a word is part of it, other white space has ids too."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        added = self.library.get_added_tokens_decoder().values()
        # In lower case: a tokenizer may look for them after its own changes to the text.
        self._special = sorted({token.content.lower().encode() for token in added if token.content})
        self.spaced = spaced
        self._opens, self._line = self._first_tokens() if spaced else (None, -1)
        self.mask = _U64(slots - 1)
        self.kept_ids = kept_ids
        self._gaps: dict[bytes, np.ndarray] = {}
        self._keys = np.zeros(slots, dtype=_U64)
        self._first = np.zeros(slots, dtype=np.int64)
        self._count = np.zeros(slots, dtype=np.int32)
        self._ids = np.zeros(1 << 16, dtype=np.uint32)  # room for more than those kept
        self._kept = 0

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _put(self, ids: np.ndarray) -> int:
        """Write ids behind those kept; returns where they end."""
        end = self._kept + len(ids)
        if end > len(self._ids):
            grown = np.zeros(max(end, len(self._ids) * 3 // 2), dtype=np.uint32)
            grown[: self._kept] = self._ids[: self._kept]
            self._ids = grown
        self._ids[self._kept : end] = ids
        return end

    def _first_tokens(self) -> tuple[np.ndarray, int]:
        """Which ids begin with a space or are a line feed, and the id of the latter, or -1."""
        vocabulary = self.library.get_vocab(with_added_tokens=False)
        line = vocabulary.get("\u010a", -1)  # how byte-level vocabularies write the two
        opens = np.zeros(max(self.library.get_vocab().values(), default=0) + 2, dtype=bool)
        opens[[i for token, i in vocabulary.items() if token[0] == "\u0120"]] = True
        opens[line] = True
        return opens, line

    def _apart(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and the number of each."""
        encoded = self.library.encode(texts, is_pretokenized=True, add_special_tokens=False)
        sizes = np.bincount(np.array(encoded.word_ids, dtype=np.int64), minlength=len(texts))
        return np.array(encoded.ids, dtype=np.uint32), sizes

    def _together(
        self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, leading: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray] | None:
        """The same from one text, in which a space or, where none is ``leading``, a line feed
        stands before each word; None if its ids don't show where every word begins."""
        sizes = ends - starts + 1
        after = np.cumsum(sizes)
        text = data[np.repeat(starts - 1 - (after - sizes), sizes) + np.arange(after[-1])]
        text[after - sizes] = np.where(leading, 0x20, 0x0A)
        raw = text.tobytes()
        if any(string in raw.lower() for string in self._special):
            return None
        text = raw.decode("utf-8", "replace")
        (encoded,) = self.library.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(encoded.ids, dtype=np.uint32)
        first = np.flatnonzero(self._opens[ids])
        if not np.array_equal(ids[first] != self._line, leading):
            return None
        sizes = np.diff(np.append(first, len(ids))) - (~leading).astype(np.int64)
        return ids[ids != self._line], sizes

    def _new_words(self, data, starts, ends, leading, word_at, chosen):
        """Ids of the ``chosen`` words, and where those of each begin and how many they are."""
        together = np.zeros(len(chosen), dtype=bool)
        if self.spaced:
            # With white space outside ASCII in it a word would not end where the next begins.
            suspect = np.zeros(len(starts) + 1, dtype=bool)
            suspect[np.searchsorted(starts, np.flatnonzero(_SUSPECT[data]), side="right") - 1] = True
            together = ~suspect[chosen]
            for k in np.flatnonzero(~together).tolist():
                together[k] = not _OTHER_WHITE.search(word_at(chosen[k]))
        plain, other = np.flatnonzero(together), np.flatnonzero(~together)
        filled = np.cumsum(ends[chosen[plain]] - starts[chosen[plain]] + 1) // _JOINED_BYTES
        groups = np.split(plain, np.flatnonzero(np.diff(filled)) + 1)
        parts, sizes = [], np.zeros(len(chosen), dtype=np.int64)
        for group in groups if len(plain) else []:
            some = chosen[group]
            found = self._together(data, starts[some], ends[some], leading[some])
            found = found or self._apart([word_at(i) for i in some.tolist()])
            parts.append(found[0])
            sizes[group] = found[1]
        if len(other):
            ids, sizes[other] = self._apart([word_at(i) for i in chosen[other].tolist()])
            parts.append(ids)
        order = np.concatenate([plain, other])
        begins = np.empty_like(sizes)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate(parts), begins, sizes

    def _units(self, keys: np.ndarray, new_words) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of ids in the table for each word.

        A word has two slots; where both are taken the second is given to the newer word,
        and a word that lost its slot is encoded again when it next comes up.
        """
        if self._kept > self.kept_ids:
            self._keys[:] = 0
            self._kept = 0
        keys = np.maximum(keys, _U64(1))
        one = (keys & self.mask).astype(np.int64)
        two = ((keys >> _U64(40)) & self.mask).astype(np.int64)
        slot = np.where(self._keys[one] == keys, one, two)
        first, count = self._first[slot], self._count[slot].astype(np.int64)
        lost = np.flatnonzero(self._keys[slot] != keys)
        if len(lost):
            new, example, inverse = np.unique(keys[lost], return_index=True, return_inverse=True)
            ids, begin, sizes = new_words(lost[example])
            begin += self._kept
            self._kept = self._put(ids)
            first[lost], count[lost] = begin[inverse], sizes[inverse]
            one, two = one[lost[example]], two[lost[example]]
            place = np.where(self._keys[one] == 0, one, two)
            self._keys[place], self._first[place], self._count[place] = new, begin, sizes
        return first, count

    def _gap(self, white: bytes, spaced: bool, last: bool) -> np.ndarray:
        """Ids of white space before a word (the space that joins the word apart)."""
        key = white + (b"" if last else b" a" if spaced else b"a")
        if key not in self._gaps:
            ids = self._whole(key.decode())
            tail = 0 if last else len(self._whole(" a" if spaced else "a"))
            if len(self._gaps) > 10_000:
                self._gaps.clear()
            self._gaps[key] = ids[: len(ids) - tail]
        return self._gaps[key]

    def encode(
        self, data: np.ndarray, offsets: np.ndarray, end_id: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row with ``end_id`` after each text, and the offsets of each text."""
        texts = len(offsets) - 1
        raw = data.tobytes()
        starts, ends, first_word = words.spans(data, offsets)
        keys = words.hashes(data, starts, ends)
        leading = np.zeros(len(starts), dtype=bool)
        if self.spaced and len(starts):
            leading = data[np.maximum(starts - 1, 0)] == 0x20
            opens = first_word[:-1][first_word[:-1] < first_word[1:]]
            leading[opens] &= ~np.isin(starts[opens], offsets)
            keys = np.where(leading, words.mix(keys ^ _SPACED), keys)

        def word_at(i: int) -> str:
            return (" " if leading[i] else "") + raw[starts[i] : ends[i]].decode("utf-8", "replace")

        new_words = partial(self._new_words, data, starts, ends, leading, word_at)
        place, count = self._units(keys, new_words) if len(keys) else (keys.astype(np.int64),) * 2
        # What is put between the words, by (text, kind): a gap before a word, one at the
        # end of a text, the end id.
        gaps: list[tuple[int, int, int, np.ndarray]] = []
        if self.spaced:
            self._gaps_between(raw, offsets, starts, ends, first_word, leading, gaps)
        at = np.concatenate([np.array([g[0] for g in gaps], dtype=np.int64), first_word[1:]])
        text = np.concatenate([np.array([g[1] for g in gaps], dtype=np.int64), np.arange(texts)])
        kind = np.concatenate([np.array([g[2] for g in gaps], dtype=np.int64), np.full(texts, 2)])
        sizes = np.array([len(g[3]) for g in gaps] + [1], dtype=np.int64)
        begins = self._kept + np.cumsum(sizes) - sizes
        self._put(np.concatenate([*(g[3] for g in gaps), np.array([end_id], np.uint32)]))
        order = np.lexsort((kind, text, at))
        put_begin = np.concatenate([begins[:-1], np.full(texts, begins[-1])])[order]
        put_size = np.concatenate([sizes[:-1], np.ones(texts, dtype=np.int64)])[order]
        begin = np.insert(place, at[order], put_begin)
        length = np.insert(count, at[order], put_size)
        total = np.cumsum(length)
        ids = self._ids[np.repeat(begin - (total - length), length) + np.arange(total[-1])]
        stands = (at[order] + np.arange(len(order)))[kind[order] == 2]
        id_offsets = np.concatenate([[0], total[stands]])
        return self._mend(raw, data, offsets, ids, id_offsets, end_id)

    def _gaps_between(self, raw, offsets, starts, ends, first_word, leading, gaps) -> None:
        """White space that is not just the one space before a word."""
        texts = len(offsets) - 1
        before = np.empty(len(starts), dtype=np.int64)
        if len(starts):
            before[1:] = ends[:-1]
            opens = first_word[:-1][first_word[:-1] < first_word[1:]]
            before[opens] = offsets[np.searchsorted(first_word, opens, side="right") - 1]
        stop = starts - leading
        found = np.flatnonzero(stop > before)
        text_of = np.searchsorted(first_word, found, side="right") - 1
        columns = (found, text_of, before[found], stop[found], leading[found])
        for i, t, begin, end, spaced in zip(*(c.tolist() for c in columns), strict=True):
            gaps.append((i, t, 0, self._gap(raw[begin:end], spaced, False)))
        has_words = np.diff(first_word) > 0
        after = offsets[:-1].copy()
        if len(ends):
            after[has_words] = ends[first_word[1:][has_words] - 1]
        for t in np.flatnonzero(after < offsets[1:]).tolist():
            ids = self._gap(raw[after[t] : offsets[t + 1]], False, True)
            gaps.append((int(first_word[t + 1]), t, 1, ids))

    def _with_special(self, raw: bytes, offsets: np.ndarray) -> set[int]:
        """Texts that hold a special string, in any case."""
        lower, found = raw.lower(), set()
        for string in self._special:
            place = lower.find(string)
            while place >= 0:
                text = int(np.searchsorted(offsets, place, side="right")) - 1
                found.add(text)
                place = lower.find(string, max(int(offsets[text + 1]), place + 1))
        return found

    def _mend(self, raw, data, offsets, ids, id_offsets, end_id):
        """Texts with white space outside ASCII or special strings, encoded whole."""
        found = np.flatnonzero(_SUSPECT[data])
        suspects = set(np.unique(np.searchsorted(offsets, found, side="right") - 1).tolist())
        special = self._with_special(raw, offsets)
        whole = {}
        for t in sorted(suspects | special):
            text = raw[offsets[t] : offsets[t + 1]].decode("utf-8", "replace")
            if t in special or _OTHER_WHITE.search(text):
                whole[t] = np.append(self._whole(text), np.uint32(end_id))
        if not whole:
            return ids, id_offsets
        parts, lengths, last = [], np.diff(id_offsets), 0
        for t, own in whole.items():
            parts += [ids[id_offsets[last] : id_offsets[t]], own]
            lengths[t], last = len(own), t + 1
        parts.append(ids[id_offsets[last] :])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum(lengths)])


@lru_cache(maxsize=4)
def encoder(path: str, spaced: bool) -> Encoder:
    """One encoder per worker, kept between tasks."""
    return Encoder(path, spaced)
