"""Byte-pair encoding and decoding with a SentencePiece model, in vectorised merge rounds.

The symbols of many distinct words stand in one flat numpy array.  Each round looks up the
rank of every adjacent pair, takes the smallest rank per word (a segmented minimum), merges
its occurrences from the left and closes the gaps.  A word leaves when none of its pairs is
a piece.  Merging several occurrences at once equals merging them one by one unless a
merged piece forms a better pair with its neighbour; pieces for which the vocabulary has
such a longer, better piece are merged one at a time.  Very long words use a heap, which
takes the same merges in the same order.

Texts are split into words by ``wordcache``; null and empty texts have no ids.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .wordcache import WordCache

SPACE = "▁"  # stands for a blank in pieces
CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")
LONG_WORD = 400  # symbols
NO_PAIR = np.int64(1) << 40


#: Texts that other kinds of model split or write differently than is done here.
PROBES = (
    "", "a", " a", "a  b ", "the unbelievably long-winded 12345 words", "\ufb01 \uff21 \u00e9 e\u0301 \u00bd",
    "a\tb\nc\u00a0d\u200be", "\U0001f9ea\u2603\ue000", "aaaaaaaaaaaaaaa ABCabc", "\u4e2d\u6587 \u0440\u0443\u0441",
)


class UnknownModel(ValueError):
    """A model with steps that are not built here."""


class PieceCodec:
    """``encode`` and ``decode`` of one model file, as the sentencepiece library does it.

    Models are of the byte-pair type, with bytes for unknown characters, a blank in front and
    texts left as they are; others raise ``UnknownModel``.
    """

    def __init__(self, path: str):
        import sentencepiece

        self._library = model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        if not all(model.is_byte(model.piece_to_id(f"<0x{b:02X}>")) for b in range(256)):
            raise UnknownModel(f"{path}: not every byte has a piece")
        names = [model.id_to_piece(i) for i in range(n)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(n)]
        byte = [model.is_byte(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(names) if not special[i] and not byte[i]}
        self._unknown = n  # symbols from here on are characters without a piece
        self._bytes = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int64)
        scores = {p: model.get_score(i) for p, i in self.ids.items()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rank = {p: order[s] for p, s in scores.items()}
        pairs, one_by_one = {}, set()
        for piece, merged in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in self.ids and right in self.ids:
                    pairs[(self.ids[left] << 20) + self.ids[right]] = (rank[piece], merged)
                for part in (left, right):
                    if part in rank and rank[piece] <= rank[part]:
                        one_by_one.add(self.ids[part])
        self._pairs = pairs
        keys = np.array(sorted(pairs), np.int64)
        self._keys = np.append(keys, np.iinfo(np.int64).max)
        # rank above, merged piece below
        self._found = np.array([(pairs[k][0] << 20) + pairs[k][1] for k in keys.tolist()] + [0], np.int64)
        self._single = np.zeros(n, bool)
        self._single[list(one_by_one)] = True
        self._decimal = np.array([b"%d," % i for i in range(n)], object)
        text = [b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        for b, i in enumerate(self._bytes.tolist()):
            text[i] = bytes([b])
        self._text = np.array(text, object)
        self._special = np.array(special, bool)
        self._cache = WordCache(
            lambda words: self.merge([SPACE + w for w in words]),
            self._encode_text,
            whole=lambda texts: pc.match_substring_regex(texts, f"^ |  |{SPACE}"),
        )

        for probe in PROBES:
            ids = self._encode_text(probe)
            if ids != model.encode(probe) or self.decode(np.array(ids, np.int64)) != model.decode(ids):
                raise UnknownModel(f"{path}: not as the library on {probe!r}")

    def _encode_text(self, text: str) -> list[int]:
        words = CHUNK.findall(SPACE + text.replace(" ", SPACE))
        return [i for ids in self.merge(words) for i in ids] if text else []

    def encode(self, texts: pa.Array):
        """(ids, ids per text) for consecutive slices of ``texts``."""
        return self._cache.encode(texts)

    def decode(self, ids: np.ndarray) -> str:
        """The text of one sequence of ids."""
        if self._special[ids].any():
            return self._library.decode(ids.tolist())
        data = b"".join(self._text[ids].tolist())
        try:
            return data.decode().removeprefix(" ")
        except UnicodeDecodeError:  # ids that no encoder makes
            return self._library.decode(ids.tolist())

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by commas."""
        return b"".join(self._decimal[ids].tolist())[:-1]

    def merge(self, words: Sequence[str]) -> list[list[int]]:
        """Ids of words, each of which no merge leaves."""
        out: list = [None] * len(words)
        short = []
        for i, word in enumerate(words):
            if len(word) > LONG_WORD:
                out[i] = self._merge_long(word)
            else:
                short.append(i)
        for at in range(0, len(short), 50_000):
            part = short[at : at + 50_000]
            for i, ids in zip(part, self._rounds([words[i] for i in part])):
                out[i] = ids
        return out

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and merged piece of pairs, NO_PAIR shifted if they make no piece."""
        key = (left << 20) + right
        at = np.searchsorted(self._keys, key)
        return np.where(self._keys[at] == key, self._found[at], NO_PAIR)

    def _symbols(self, text: str) -> tuple[np.ndarray, dict[int, str]]:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        distinct, inverse = np.unique(points, return_inverse=True)
        table, strange = [], {}
        for c in map(chr, distinct.tolist()):
            table.append(self.ids.get(c, self._unknown + len(strange)))
            if c not in self.ids:
                strange[table[-1]] = c
        return np.array(table, np.int64)[inverse] if table else np.zeros(0, np.int64), strange

    def _rounds(self, words: list[str]) -> list[list[int]]:
        symbols, strange = self._symbols("".join(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        owner = np.repeat(np.arange(len(words)), sizes)  # word of each symbol
        done_symbols, done_owner = [], []

        def pair_ranks():
            ranks = np.full(len(symbols), NO_PAIR)
            inner = np.flatnonzero(owner[:-1] == owner[1:])
            ranks[inner] = self._pair(symbols[inner], symbols[inner + 1])
            return ranks

        ranks = pair_ranks()  # of the pair that begins at each symbol
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            length = np.diff(np.r_[first, len(symbols)])
            best = np.minimum.reduceat(ranks, first)
            open_words = best < NO_PAIR
            if not open_words.all():
                stays = np.repeat(open_words, length)
                done_symbols.append(symbols[~stays])
                done_owner.append(owner[~stays])
                symbols, owner, ranks = symbols[stays], owner[stays], ranks[stays]
                length, best = length[open_words], best[open_words]
                if not len(symbols):
                    break
            hits = np.flatnonzero(ranks >> 20 == np.repeat(best >> 20, length))
            # overlapping occurrences: every second one of a run, from its left
            run = np.r_[True, (hits[1:] != hits[:-1] + 1)]
            place = np.arange(len(hits))
            hits = hits[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]
            merged = ranks[hits] & ((1 << 20) - 1)
            again = np.r_[False, owner[hits[1:]] == owner[hits[:-1]]] & self._single[merged]
            hits, merged = hits[~again], merged[~again]
            symbols[hits] = merged
            stays = np.ones(len(symbols), bool)
            stays[hits + 1] = False
            at = np.cumsum(stays)[hits] - 1
            symbols, owner, ranks = symbols[stays], owner[stays], ranks[stays]
            for pair in (at, at[at > 0] - 1):  # pairs with a new part
                inner = pair[pair + 1 < len(symbols)]
                same = owner[inner] == owner[inner + 1]
                ranks[pair] = NO_PAIR
                inner = inner[same]
                ranks[inner] = self._pair(symbols[inner], symbols[inner + 1])
        done_symbols, done_owner = np.concatenate([*done_symbols, symbols]), np.concatenate([*done_owner, owner])
        order = np.argsort(done_owner, kind="stable")
        counts = np.bincount(done_owner, minlength=len(words))
        flat, ends = done_symbols[order].tolist(), np.cumsum(counts).tolist()
        parts = [flat[a:b] for a, b in zip([0, *ends], ends)]
        return [self._with_bytes(p, strange) for p in parts] if strange else parts

    def _with_bytes(self, symbols: list[int], strange: dict[int, str]) -> list[int]:
        if max(symbols, default=0) < self._unknown:
            return symbols
        out: list[int] = []
        for s in symbols:
            out += self._bytes[list(strange[s].encode())].tolist() if s in strange else [s]
        return out

    def _merge_long(self, word: str) -> list[int]:
        symbols, strange = self._symbols(word)
        symbol = symbols.tolist()
        after, before = list(range(1, len(symbol) + 1)), list(range(-1, len(symbol) - 1))
        heap: list = []

        def offer(a, b):
            if a >= 0 and b < len(symbol):
                found = self._pairs.get((symbol[a] << 20) + symbol[b])
                if found:
                    heapq.heappush(heap, (found[0], a, symbol[a], symbol[b], b, found[1]))

        for i in range(len(symbol) - 1):
            offer(i, i + 1)
        while heap:
            _, a, left, right, b, piece = heapq.heappop(heap)
            if symbol[a] != left or symbol[b] != right or after[a] != b:
                continue
            symbol[a], symbol[b], after[a] = piece, -1, after[b]
            if after[b] < len(symbol):
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return self._with_bytes([s for s in symbol if s >= 0], strange)


@lru_cache(maxsize=2)
def codec(path: str) -> PieceCodec:
    """One codec per worker and file."""
    return PieceCodec(path)


def encode_documents(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array of int) of the column ``text``; null texts have no ids.

    An existing column ``ids`` is replaced; all others stay.
    """
    return _with_result(docs, text, ids, "array<int>", path, _ids_of)


def decode_ids(rows: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add ``text``, the decoded column ``ids``; null ids give an empty text."""
    return _with_result(rows, ids, text, "string", path, _text_of)


def _ids_of(model: PieceCodec, texts: pa.Array) -> pa.Array:
    parts = [(ids, sizes) for ids, sizes in model.encode(texts)]
    flat = np.concatenate([ids for ids, _ in parts]) if parts else np.zeros(0, np.uint32)
    sizes = np.concatenate([s for _, s in parts]) if parts else np.zeros(0, np.int64)
    offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))


def _text_of(model: PieceCodec, ids: pa.Array) -> pa.Array:
    return pa.array([model.decode(np.array(i or [], np.int64)) for i in ids.to_pylist()], pa.string())


def _with_result(df: DataFrame, source: str, name: str, kind: str, path: str, result) -> DataFrame:
    df = df.drop(name) if name != source else df
    inputs = df.select("*", F.col(source).alias("__input"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{name}` {kind}"])

    def run(batches):
        model = codec(path)
        for batch in batches:
            made = result(model, batch.column(batch.num_columns - 1))
            arrays = [*batch.columns[:-1], made]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], name])

    return inputs.mapInArrow(run, schema)
