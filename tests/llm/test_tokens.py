"""Token operators against the libraries, round trips, and packing invariants."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dialmesh.llm import packing, piece_codec, token_counts, token_files, wordcache
from dialmesh.llm.piece_digests import piece_digests
from dialmesh.llm.tokenizers_files import json_cache, public_path

ODD = [
    "", " ", "  ", "a  b", "a   b ", " a", "a ", "\n a", "a \n b", "a\n\nb", "x.\nY,\tz", "▁a", "é́", "İstanbul ΣΑΣ",
    "a\n\xa0 b", "a\n\xa0", "a\xa0\nb", "a\n\u2028b.\n\x0b c", "<|endoftext|>", "x <|endoftext|> y", "<|ENDOFTEXT|>", "\x01", "a \x01b", "don't we'll 'S", "12 3,4 ½²", "漢字 梦 🙂",
    "the" * 300, "ab" * 900, "<s> <0x41>",
]


def texts(seed=1):
    rng = random.Random(seed)
    letters = " \n\t.,'a bZé²½İΣ漢́梦ßtheing▁🙂<|>\xa0\u2028\r\x0b\n "
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    return ODD + made + ODD[::-1]


def ids_of(pairs):
    return [part.tolist() for ids, sizes in pairs for part in np.split(ids, np.cumsum(sizes)[:-1])]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_cache_is_the_library(name):
    library, cache = Tokenizer.from_file(public_path(name)), json_cache(public_path(name))
    want = [e.ids for e in library.encode_batch(texts(), add_special_tokens=False)]
    assert ids_of(cache.encode(pa.array(texts()))) == want
    assert ids_of(cache.encode(pa.array(texts()[::-1]))) == want[::-1]
    assert ids_of(cache.encode(pa.array([None, "a"], pa.string())))[0] == []


def test_full_cache_changes_nothing():
    codec = piece_codec.PieceCodec(public_path("piece_bpe_32k.model"))
    codec._cache._max = 5
    assert ids_of(codec.encode(pa.array(texts()))) == codec._library.encode(texts())


def test_piece_codec_is_the_library():
    path = public_path("piece_bpe_32k.model")
    library, codec = sentencepiece.SentencePieceProcessor(model_file=path), piece_codec.codec(path)
    rng = random.Random(3)
    joined = ["".join(rng.choice(["t", "h", "e", "in", "g", "an", "▁", "q"]) for _ in range(rng.randint(0, 900))) for _ in range(150)]
    all_texts = texts(2) + joined
    want = library.encode(all_texts)
    assert ids_of(codec.encode(pa.array(all_texts))) == want
    assert [codec.decode(np.array(i, np.int64)) for i in want] == [library.decode(i) for i in want]
    for text in all_texts[:400]:
        word = "▁" + text.replace(" ", "▁")
        assert not text or codec._merge_long(word) == library.encode(text)
    strange = [[3, 200, 201], [1, 5000, 2], [0, 300], []]
    assert [codec.decode(np.array(i, np.int64)) for i in strange] == [library.decode(i) for i in strange]


SCHEMA = "doc_id long, text string, ids string, n_tokens int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)


def test_piece_columns_and_digests(spark):
    path = public_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(i, t) for i, t in enumerate(texts()[:200])] + [(7, None), (None, "same"), (None, "same")]
    docs = frame(spark, rows)
    encoded = piece_codec.encode_documents(docs, path)
    assert encoded.columns == ["doc_id", "text", "n_tokens", "ids"]
    back = piece_codec.decode_ids(encoded.drop("text"), path).collect()
    assert [r["ids"] for r in back] == [library.encode(t or "") for _, t in rows]
    assert [r["text"] for r in back] == [library.decode(library.encode(t or "")) for _, t in rows]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [
        (i, len(k), sha(",".join(map(str, k))), sha(library.decode(k)))
        for i, k in ((i, library.encode(t or "")) for i, t in rows)
    ]
    assert [tuple(r) for r in piece_digests(docs, path).collect()] == want
    assert piece_digests(docs.where("false"), path).count() == 0


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_token_counts(spark, name):
    path = public_path(name)
    rows = list(enumerate(texts()[:300])) + [(None, None), (4, "again"), (4, "again")]
    got = token_counts.count_tokens(frame(spark, rows), path, limit=20).collect()
    if name.endswith(".model"):
        encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
    else:
        encode = lambda t: Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids
    counts = [len(encode(t or "")) for _, t in rows]
    assert [tuple(r) for r in got] == [
        (i, len((t or "").encode()), n, n > 20) for (i, t), n in zip(rows, counts)
    ]


def test_ranked_code_round_trip():
    rng = np.random.default_rng(1)
    for ids in (
        np.zeros(0, np.uint32), np.zeros(5, np.uint32), rng.zipf(1.3, 9999).clip(0, 50000).astype(np.uint32),
        np.arange(70_001, dtype=np.uint32), rng.integers(0, 2**32, 1001, dtype=np.uint32),
    ):
        assert (token_files.decode_ranks(len(ids), *token_files.encode_ranks(ids)) == ids).all()
    _, control, data = token_files.encode_ranks(np.array([9] * 300 + [8] + list(range(1000, 1300)), np.uint32))
    assert control[0] == 0 and len(control) == -(-601 // 4) and 601 < len(data) < 2 * 601


def test_token_files(spark, tmp_path):
    library = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    rows = [(5 * i % 301, t) for i, t in enumerate(texts()[:301])] + [(1000, "tie a"), (1000, "tie b"), (1000, "tie b"), (999, None)]
    docs = frame(spark, rows).repartition(5)
    token_files.write_token_files(docs, str(tmp_path / "t"), public_path("byte_bpe_50k.json"), end_id=2)
    got = token_files.read_token_files(spark, str(tmp_path / "t")).orderBy("start").collect()
    start = 0
    for row, (key, text) in zip(got, sorted(rows, key=lambda r: (r[0], r[1] or "")), strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"], row["ids"]) == (key, start, len(ids), crc, ids)
        start += len(ids)
    token_files.write_token_files(docs.where("false"), str(tmp_path / "t"), public_path("byte_bpe_50k.json"), 2)
    assert token_files.read_token_files(spark, str(tmp_path / "t")).count() == 0


def check_packing(rows, capacity):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("n", [1, 7, 300, 5000])
def test_pack_lengths(n):
    rng = np.random.default_rng(n)
    for lengths in (
        np.minimum(4096, rng.lognormal(6.5, 1.1, n).astype(int) + 1), rng.integers(1, 2500, n),
        np.full(n, 1366), np.full(n, 4096), rng.integers(1400, 2048, n), np.ones(n, int),
    ):
        sequence, offset = packing.pack_lengths(lengths, 4096)
        rows = [dict(sequence_id=s, offset=o, length=x) for s, o, x in zip(sequence, offset, lengths)]
        used = check_packing(rows, 4096)
        large = lengths > 2048
        bound = max(-(-lengths.sum() // 4096), large.sum(), -(-(lengths > 1365).sum() // 2))
        assert used <= bound * 1.02 + 2  # none can have fewer than the bound


def test_packing_of_documents(spark):
    library = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    rows = list(enumerate(texts()[:150])) + [(500, "word " * 260), (501, None), (None, "no key"), (3, "tie"), (3, "tie")]
    docs = frame(spark, rows)
    path = public_path("word_bpe_49k.json")
    got = packing.pack(packing.token_pieces(docs, path, 1, 100), 100, shard_pieces=64).collect()
    check_packing(got, 100)
    want = []
    for key, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 100)):
            part = ids[at : at + 100]
            want.append((key, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    order = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r)[:5] for r in got), key=order) == sorted(want, key=order)
    assert packing.pack(packing.token_pieces(docs.where("false"), path, 1, 100), 100).count() == 0


@pytest.mark.parametrize("part,name,value", [
    ("normalizer_spec", "add_dummy_prefix", False), ("normalizer_spec", "remove_extra_whitespaces", True), ("trainer_spec", "model_type", 1)])
def test_other_kinds_of_piece_models_are_refused(tmp_path, part, name, value):
    protocol = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = protocol.ModelProto()
    with open(public_path("piece_bpe_32k.model"), "rb") as file:
        model.ParseFromString(file.read())
    setattr(getattr(model, part), name, value)
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(piece_codec.UnknownModel):
        piece_codec.PieceCodec(str(tmp_path / "other.model"))


def test_new_words_are_encoded_few_at_a_time():
    """What an encoder returns is many times larger than its words; all of a slice went to it at once."""
    given = []

    def encode(words):
        given.append(len(words))
        return [[len(w)] for w in words]

    texts = [" ".join(f"{'w' * (i % 7)}{i}" for i in range(a, a + 3000)) for a in range(0, 30_000, 3000)]
    cache = wordcache.WordCache(encode, lambda text: [], max_words=20_000)
    for _ in range(2):  # from the second time on some are known
        out = list(cache.encode(pa.array([*texts, None, texts[0]])))
        ids, sizes = (np.concatenate(x) for x in zip(*out))
        assert sizes.tolist() == [3000] * 10 + [0, 3000]
        assert ids.tolist() == [len(w) for t in [*texts, texts[0]] for w in t.split(" ")]
    assert max(given) <= 4096 and sum(given) == 30_001 + 10_001  # the empty word too
