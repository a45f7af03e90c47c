"""Byte-pair encoding and decoding with a ``tokenizers`` file, merging by a segment tree.

Over the symbols of a word stands a segment tree whose leaves are the ranks of adjacent
pairs.  Its root yields the lowest rank and, among equals, the leftmost place.  That pair is
merged, the leaves of its two neighbours and of the symbol that went are set anew, and so on
until the root holds no rank: one merge costs the logarithm of the word's length.

A file's normalizer and pre-tokenizer decide what a word is; both are run by the library for
words that are not plain ASCII.  Texts are split at white space into chunks, distinct ones
are encoded once per Python worker (``wordcache``), and special strings are found first, as
they stand.  Null and empty texts have no ids.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenizers_files import _byte_letters
from .wordcache import WordCache

PLACES = 32  # bits of a leaf that hold the place, below the rank
PLACE = (1 << PLACES) - 1
NO_PAIR = 1 << 58
#: The one pattern of words whose files are read: matches are words, the rest is dropped.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
BLANKS = re.compile(r"[\t-\r ]+")


class UnknownFile(ValueError):
    """A tokenizer file with parts that this codec does not build."""


class BytePairCodec:
    """``encode`` and ``decode`` of one file, as the library does without added specials."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        _check(parts)
        library = Tokenizer.from_file(path)
        self._normalizer, self._pre_tokenizer = library.normalizer, library.pre_tokenizer
        model = parts["model"]
        vocabulary = model["vocab"]
        self._suffix = model.get("end_of_word_suffix") or ""
        self._pairs: dict[int, int] = {}  # two ids -> rank, shifted to its bits of a leaf
        self._merged = []  # by rank
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self._pairs[(vocabulary[left] << 32) + vocabulary[right]] = rank << PLACES
            self._merged.append(vocabulary[left + right])
        letters = _byte_letters()
        self._inner = [vocabulary.get(chr(letters[b])) for b in range(256)]
        self._last = [vocabulary.get(chr(letters[b]) + self._suffix) for b in range(256)]
        if None in self._inner or None in self._last:
            raise UnknownFile(f"{path}: not every byte has a symbol")
        names = {i: name for name, i in vocabulary.items()}
        self._special = {}
        for added in parts["added_tokens"]:
            self._special[added["content"]] = added["id"]
            names[added["id"]] = added["content"]
        self._names = np.array([names.get(i, "") for i in range(max(names) + 1)], object)
        strings = sorted(self._special, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, strings)) + ")") if strings else None
        heads = "|".join(re.escape(s) for s in strings) or "$^"
        self._cache = WordCache(
            lambda words: [self.encode_chunk(w) for w in words],
            self._encode_text,
            prepare=_spaced,
            whole=lambda texts: pc.match_substring_regex(texts, heads),
        )

    def encode(self, texts: pa.Array):
        """(ids, ids per text) for consecutive slices of ``texts``."""
        return self._cache.encode(texts)

    def decode(self, ids: np.ndarray) -> str:
        """The symbols of one sequence of ids, joined by a space; specials are kept."""
        return " ".join(self._names[ids].tolist())

    def _encode_text(self, text: str) -> list[int]:
        """Ids of a text with special strings in it."""
        ids: list[int] = []
        for part in self._cut.split(text) if self._cut else [text]:
            if part in self._special:
                ids.append(self._special[part])
            else:
                ids += [i for chunk in BLANKS.split(part) for i in self.encode_chunk(chunk)]
        return ids

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a text without special strings."""
        if chunk.isascii():
            words = [w.encode() for w in ASCII_WORDS.findall(chunk.lower())]
        else:
            whole = self._normalizer.normalize_str(chunk)
            words = [whole[a:b].encode() for _, (a, b) in self._pre_tokenizer.pre_tokenize_str(whole)]
        return [i for word in words for i in self.merge(word)]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: merges by a segment tree over its adjacent pairs."""
        symbols = [self._inner[b] for b in word]
        symbols[-1:] = [self._last[b] for b in word[-1:]]
        n = len(symbols)
        if n < 2:
            return symbols
        rank_of, merged = self._pairs.get, self._merged
        width = 1 << (n - 2).bit_length()  # leaves, one per pair that starts at a symbol
        leaves = [rank_of((a << 32) + b, NO_PAIR) + i for i, (a, b) in enumerate(zip(symbols, symbols[1:]))]
        tree = [NO_PAIR] * width + leaves + [NO_PAIR] * (width - n + 1)
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n))
        while tree[1] < NO_PAIR:
            rank, i = tree[1] >> PLACES, tree[1] & PLACE
            left, gone = before[i], after[i]
            right = after[gone]
            symbols[i], symbols[gone] = merged[rank], -1
            after[i], before[right] = right, i
            changed = [(i, rank_of((symbols[i] << 32) + symbols[right], NO_PAIR) + i if right < n else NO_PAIR)]
            if right < n:
                changed.append((gone, NO_PAIR))
            if left >= 0:
                changed.append((left, rank_of((symbols[left] << 32) + symbols[i], NO_PAIR) + left))
            for place, leaf in changed:
                k = width + place
                tree[k] = leaf
                while k > 1:
                    k >>= 1
                    least, other = tree[2 * k], tree[2 * k + 1]
                    if other < least:
                        least = other
                    if tree[k] == least:
                        break
                    tree[k] = least
        return [s for s in symbols if s >= 0]


def _check(parts: dict) -> None:
    """Raise ``UnknownFile`` for a file with steps that are not built here."""
    model = parts["model"]
    steps = (parts["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    split = steps[0]
    normalizers = [n.get("type") for n in (parts["normalizer"] or {}).get("normalizers", [])]
    fits = {
        "model": model.get("type") == "BPE",
        "model options": not any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        ),
        "normalizer": normalizers == ["NFC", "Replace", "Lowercase"],
        "pre-tokenizer": [s.get("type") for s in steps] == ["Split", "ByteLevel"]
        and split.get("pattern") == {"Regex": WORDS}
        and (split.get("behavior"), split.get("invert")) == ("Removed", True)
        and not (steps[1].get("add_prefix_space") or steps[1].get("use_regex")),
        "decoder": parts.get("decoder") is None,
        "special tokens": not any(
            a[k] for a in parts["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")
        ),
    }
    wrong = [name for name, good in fits.items() if not good]
    if wrong:
        raise UnknownFile(f"unknown {', '.join(wrong)}")


def _spaced(texts: pa.Array) -> pa.Array:
    """Lower case, blanks for other ASCII white space, and blanks between a letter and a full
    stop or comma, where a word ends in any case."""
    texts = pc.replace_substring_regex(pc.ascii_lower(texts), r"[\t-\r]", " ")
    return pc.replace_substring_regex(texts, r"([a-z])([.,])", r"\1 \2")


@lru_cache(maxsize=2)
def byte_pair_codec(path: str) -> BytePairCodec:
    """One codec per worker and file."""
    return BytePairCodec(path)


def encode_texts(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array of int) of the column ``text``; null and empty texts have none.

    A column of that name is replaced; all others stay as they are, each row for itself.
    """
    return _with_result(docs, text, ids, "array<int>", path, _ids_of)


def decode_texts(rows: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add ``text``, the decoded column ``ids``; null or no ids give an empty text."""
    return _with_result(rows, ids, text, "string", path, _text_of)


def _ids_of(model: BytePairCodec, texts: pa.Array) -> pa.Array:
    offsets, flat, total = [np.zeros(1, np.int64)], [], 0
    for ids, sizes in model.encode(texts):
        offsets.append(total + np.cumsum(sizes))
        flat.append(ids.view(np.int32))
        total += len(ids)
    values = np.concatenate(flat) if flat else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pa.array(values))


def _text_of(model: BytePairCodec, ids: pa.Array) -> pa.Array:
    return pa.array([model.decode(np.array(i.as_py() or [], np.int64)) for i in ids], pa.string())


def _with_result(df: DataFrame, source: str, name: str, kind: str, path: str, result) -> DataFrame:
    if source == name:
        raise ValueError("the result needs a name of its own")
    rest = [f for f in df.schema if f.name != name]
    at, names = [f.name for f in rest].index(source), [f.name for f in rest] + [name]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [f"`{name}` {kind}"])

    def run(batches):
        model = byte_pair_codec(path)
        for batch in batches:
            made = result(model, batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names)

    return df.select(*[F.col(f"`{f.name}`") for f in rest]).mapInArrow(run, schema)
