"""Digests of a byte-pair encoding and of what it decodes to, without carrying ids around."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe_codec import byte_pair_codec
from .common import map_batches


def byte_pair_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256``: the ids as little-endian unsigned 32-bit
    numbers, and the decoded text in UTF-8, as lower-case hex.  Null texts count as empty."""
    kind = docs.schema[key].dataType.simpleString()

    def make():
        model = byte_pair_codec(path)

        def step(batch):
            keys, texts = batch.columns
            at = 0
            for ids, sizes in model.encode(texts):
                parts = np.split(ids, np.cumsum(sizes)[:-1])
                yield [
                    keys.slice(at, len(sizes)),
                    pa.array(sizes, pa.int64()),
                    pa.array([hashlib.sha256(p.astype("<u4").tobytes()).hexdigest() for p in parts], pa.string()),
                    pa.array([hashlib.sha256(model.decode(p).encode()).hexdigest() for p in parts], pa.string()),
                ]
                at += len(sizes)

        return step

    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_batches(docs.select(key, text), make, schema)
