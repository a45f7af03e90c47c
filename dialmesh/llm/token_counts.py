"""Token counts of whole texts.

For a SentencePiece model, vocabulary strings that encode alone as the one token they name
are proved beforehand, by encoding each of them: a word of a text that is such a string
counts one, and only the other words are merged by the library.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import map_batches
from .tokenizers_files import json_cache
from .wordcache import WordCache

SPACE = "▁"


@lru_cache(maxsize=2)
def count_cache(path: str) -> WordCache:
    """A word cache whose values are token counts of words."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    blank = len(model.encode("a ")) - len(model.encode("a"))  # a lone blank at the end

    def count(words):
        return [[len(ids)] if w else [blank] for w, ids in zip(words, model.encode(list(words), num_threads=1))]

    cache = WordCache(
        count,
        lambda text: [len(model.encode(text))],
        whole=lambda texts: pc.match_substring_regex(texts, f"^ |  |{SPACE}"),
    )
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    names = [p for p in names if p.startswith(SPACE) and SPACE not in p[1:] and len(p) > 1]
    proved = [
        p[1:] for p, ids in zip(names, model.encode([p[1:] for p in names]))
        if ids == [model.piece_to_id(p)]
    ]
    cache.learn(proved, [[1]] * len(proved))
    return cache


def count_tokens(docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` of each row.

    ``path`` is a SentencePiece ``.model`` or a tokenizers ``.json`` file.  No begin, end or
    added tokens are counted.  A null text counts as empty, with no tokens; repeated rows are
    counted each.
    """
    kind = docs.schema[key].dataType.simpleString()
    is_model = path.endswith(".model")

    def make():
        cache = count_cache(path) if is_model else json_cache(path)

        def step(batch):
            keys, texts = batch.columns
            totals = [
                _sums(values, sizes) if is_model else sizes for values, sizes in cache.encode(texts)
            ]
            tokens = np.concatenate(totals) if totals else np.zeros(0, np.int64)
            n_bytes = pc.binary_length(texts.fill_null("")).cast(pa.int64())
            yield [keys, n_bytes, pa.array(tokens, pa.int64()), pa.array(tokens > limit)]

        return step

    schema = f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_batches(docs.select(key, text), make, schema)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.r_[0, np.cumsum(values, dtype=np.int64)]
    cuts = np.r_[0, np.cumsum(sizes)]
    return ends[cuts[1:]] - ends[cuts[:-1]]
