"""Encoding texts word by word, each distinct word once per Python worker.

Byte-pair tokenizers never merge across the left edge of a blank that follows a non-blank.
So a text splits there into words (each with its leading blank) that encode alone, and the
ids of a text are those of its words in order.  Words are made distinct per batch by Arrow;
only words that the worker has not met go to the tokenizer.  The table of known words is
bounded: a word that finds it full is encoded again in the next batch.

Texts with two blanks in a row, where a blank may belong to neither word, go to the
tokenizer as a whole where blanks count.
"""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_WORDS = 200_000  # known words of one worker, about 300 bytes each (two workers per executor, beside its heap)
SLICE_BYTES = 4_000_000  # text handled at a time
NEW_WORDS = 4096  # words given to the encoder at a time
KEY_CHARS = 200  # longer words are not worth remembering


class WordCache:
    """Values of texts, word by word: ids in general, or any other fixed-size numbers."""

    def __init__(
        self,
        encode_words: Callable[[Sequence[str]], list[Sequence[int]]],
        encode_text: Callable[[str], Sequence[int]],
        encode_first: Callable[[Sequence[str]], list[Sequence[int]]] | None = None,
        max_words: int = MAX_WORDS,
        prepare: Callable[[pa.Array], pa.Array] | None = None,
        whole: Callable[[pa.Array], pa.Array] = lambda texts: pc.match_substring(texts, "  "),
    ):
        """``encode_words`` takes words that a blank precedes; ``encode_first`` those at the
        start of a text, where that makes a difference; ``encode_text`` whole texts, used
        where ``whole`` is true.  ``prepare`` may put in more blanks."""
        self._words, self._text, self._first = encode_words, encode_text, encode_first
        self._max, self._prepare, self._whole = max_words, prepare, whole
        self._known: dict[str, bytes] = {}  # may be filled beforehand, see learn()
        self._known_first: dict[str, bytes] = {}

    def _values(self, words: list[str], known: dict[str, bytes], encode) -> list[bytes]:
        values = list(map(known.get, words))
        if None not in values:
            return values
        gaps = [i for i, v in enumerate(values) if v is None]
        new = list(dict.fromkeys(words[i] for i in gaps))
        fresh: dict[str, bytes] = {}
        for at in range(0, len(new), NEW_WORDS):  # what an encoder returns is many times larger than its words
            part = new[at : at + NEW_WORDS]
            fresh.update((w, array("I", ids).tobytes()) for w, ids in zip(part, encode(part)))
        for i in gaps:
            values[i] = fresh[words[i]]
        room = self._max - len(known)
        if room > 0:
            known.update(itertools.islice(fresh.items(), room))
        return values

    def learn(self, words: Sequence[str], values: list[Sequence[int]]) -> None:
        """Set the values of words beforehand."""
        self._known.update((w, array("I", v).tobytes()) for w, v in zip(words, values))

    def encode(self, texts: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ids per text) for consecutive slices of ``texts``; null is an empty text."""
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            base = sizes[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, base + slice_bytes, "right")))
            yield self._slice(texts.slice(at, end - at))
            at = end

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        odd = self._whole(texts).to_numpy(zero_copy_only=False)
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        whole = {int(i): self._text(texts[i].as_py()) for i in np.flatnonzero(odd)}
        if whole:
            texts = pc.if_else(pa.array(odd), "", texts)
        if self._prepare is not None:
            texts = self._prepare(texts)
        words = pc.split_pattern(texts, " ")
        first = words.offsets.to_numpy()
        first = (first - first[0])[:-1]
        distinct = words.flatten().dictionary_encode()
        which = distinct.indices.to_numpy()
        vocabulary = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()
        values = np.empty(len(vocabulary), object)
        values[:] = self._values(vocabulary, self._known, self._words)
        sizes = np.fromiter(map(len, values), np.int64, len(values))[which] // 4
        values = values[which]
        if self._first is not None:
            heads = self._values([vocabulary[which[i]] for i in first], self._known_first, self._first)
            values[first] = np.array([*heads, None], object)[:-1]
            sizes[first] = [len(v) // 4 for v in heads]
        for i in np.flatnonzero(empty | odd):  # the one empty word of such a text
            ids = array("I", whole.get(int(i), ()))
            values[first[i]], sizes[first[i]] = ids.tobytes(), len(ids)
        ids = np.frombuffer(b"".join(values.tolist()), np.uint32)
        return ids, np.add.reduceat(sizes, first)
