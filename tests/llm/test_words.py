"""Periodic runs, spelling variants and the byte-pair codec against brute force and the library."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dialmesh.llm import queries, spelling_variants as sv
from dialmesh.llm.bpe_codec import BytePairCodec, UnknownFile, decode_texts, encode_texts
from dialmesh.llm.periodic_runs import LastPlaces, SuffixTree, collapse, find_runs, periodic_runs
from dialmesh.llm.tokenizers_files import public_path
from dialmesh.session import materialize

SF_DIR = "/root/testdata/sf0.001"
WORD_FILE = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# periodic runs


def plain_runs(words, shortest=6, exponent=4):
    n, found = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if j > i and end - start >= max(shortest, exponent * q):
                if not any(words[start : end - d] == words[start + d : end] for d in range(1, q)):
                    found.append((start, end - start, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    rng, total = random.Random(21), 0
    for _ in range(700):
        kinds = rng.choice([1, 2, 3, 6])
        words = [str(rng.randrange(kinds)) for _ in range(rng.randrange(90))]
        while rng.random() < 0.6:
            at, place = rng.randrange(len(words) + 1), rng.randrange(len(words) + 1)
            words[place:place] = words[at : at + rng.randrange(1, 25)] * rng.randrange(2, 7)
        exponent, shortest = rng.choice([2, 3, 4]), rng.choice([1, 6, 10])
        want = plain_runs(words, shortest, exponent)
        assert find_runs(words, shortest, exponent) == want
        total += len(want)
    assert total > 1000
    assert find_runs(["a"] * 20_000) == [(0, 20_000, 1)] and find_runs([str(i % 3000) for i in range(13_000)]) == [(0, 13_000, 3000)]


def test_access_gives_last_places():
    rng = random.Random(22)
    codes = [rng.randrange(3) for _ in range(120)]
    tree = SuffixTree(codes)
    last = LastPlaces(tree)
    for i, state in enumerate(tree.prefix):
        got = dict.fromkeys(range(1, i + 2), None)
        for length, before in sorted(last.access(state, i), reverse=True):
            got.update(dict.fromkeys(range(1, length + 1), before))
        for n in got:
            earlier = [j for j in range(n - 1, i) if codes[j - n + 1 : j + 1] == codes[i - n + 1 : i + 1]]
            assert got[n] == (earlier[-1] if earlier else None)


def test_runs_of_odd_rows(spark):
    rows = [(1, "a a a a a a a b", "x"), (1, "a a a a a a a b", "x"), (None, None, "y"), (2, "", None), (3, " \n\t ", "z"),
            (4, "x\x0by\x0cx y\r\nx y x y  x", None), (5, "a " * 5, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    out = periodic_runs(docs)
    assert out.columns == ["doc_id", "text", "runs", "collapsed"]
    got = sorted(((r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in out.collect()), key=str)
    assert got == sorted([(1, [(0, 7, 1)], "a b")] * 2 + [(None, [], ""), (2, [], ""), (3, [], ""),
                         (4, [], "x y x y x y x y  x"), (5, [], "a a a a a")], key=str)
    assert periodic_runs(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs, runs="text")


def test_op11_against_brute_force(spark, documents):
    want, found = {}, 0
    for key, text in documents:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        h, n = zlib.crc32(str(key).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        runs = plain_runs(words) if n < 1500 else find_runs(words)
        found += len(runs)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in runs)]
        assert kept == collapse(words, runs)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        digest = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        want[key] = (len(runs), *digest, sha(lines), sha(" ".join(kept)))
    got = {r[0]: tuple(r[1:]) for r in queries.op11_periodic_runs(spark, SF_DIR).collect()}
    assert got == want and found > 10


# spelling variants


def near_by_pattern(words):
    """Words one edit apart by deleting each place of both."""
    holes, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :], len(w)].add(w)  # replaced
            if w[:i] + w[i + 1 :] in words:  # deleted, or inserted the other way
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    return near


def plain_variants(counts):
    near, form = near_by_pattern(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], counts.get(form[w]), root)
    return out


def variants(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("least,letters", [(2, "ab"), (4, "abcé"), (32, "abcdefgh")])
def test_variants_against_brute_force(spark, monkeypatch, least, letters):
    monkeypatch.setattr(sv, "LEAST_FREQUENT", least)
    rng = random.Random(least)
    counts = {}
    for _ in range(500):
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(4, 13)))
        counts[w] = rng.randrange(1, 40)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]])
            if len(w) > 2:
                counts[w] = rng.randrange(1, 40)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    want = plain_variants(counts)
    assert variants(sv.spelling_variants(df)) == want
    assert any(v[2] for v in want.values())


def test_bound_of_affected_grams():
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(3, 11))) for _ in range(300)}
    grams = Counter()
    for w in words:
        m = f"^{w}$"
        grams.update(m[i : i + q] for q in range(2, 9) for i in range(len(m) - q + 1))
    for w in words:
        limit, rare = sv.merged_grams(w, grams, 4)
        own = sv.grams_of(w, grams, limit)
        assert sv.most_affected(w, rare) < len(rare) == 2 and all(grams[g] < limit for _, g in own)
        apart = [grams[a] + grams[b] for i, a in own for j, b in own if i + len(a) <= j]
        assert sum(grams[g] for _, g in rare) == min(apart)
        for at in range(len(w) + 1):
            edits = [w[:at] + c + w[at:] for c in "abz"] + [w[:at] + w[at + 1 :]] * (at < len(w)) + [w[:at] + "z" + w[at + 1 :]]
            for other in edits:
                left = {g for _, g in sv.grams_of(other, grams, limit)}
                assert any(g in left for _, g in rare)


def test_variants_of_odd_rows(spark):
    rows = [("colour", 9), ("color", 3), ("color", 2), (None, 4), ("", 3), ("ab", 9), ("coloure", 9), ("colou", None)]
    got = variants(sv.spelling_variants(spark.createDataFrame(rows, "word string, n long")))
    assert got["color"] == (5, 2, None, None, "color") and got["colour"] == (9, 3, None, None, "colour")
    assert set(got) == {"color", "colour", "coloure", "colou"} and got["colou"][:2] == (None, 2)
    assert sv.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0
    chain = [("aaaaa", 1), ("aaaab", 2), ("aaabb", 4), ("aabbb", 8), ("abbbb", 16), ("bbbbb", 32)]
    got = variants(sv.spelling_variants(spark.createDataFrame(chain, "word string, n long")))
    assert {w: v[4] for w, v in got.items()} == dict.fromkeys([w for w, _ in chain], "bbbbb")
    with pytest.raises(ValueError):
        sv.spelling_variants(spark.createDataFrame(rows, "word string, n long"), factor=1)


def test_variants_are_not_broadcast(spark, monkeypatch):
    """Spark sizes words by their compressed file, and lists as if each word were in one."""
    rng, plans = random.Random(8), []
    words = {"".join(rng.choice("abcdef") for _ in range(rng.randrange(3, 9))): rng.randrange(1, 40) for _ in range(300)}

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def recorded(df, *args):
        plans.append(plan(df))
        return materialize(df, *args)

    monkeypatch.setattr(sv, "materialize", recorded)
    out = sv.spelling_variants(spark.createDataFrame(list(words.items()), "word string, n long"))
    assert variants(out) == plain_variants(words)
    plans.append(plan(out))
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)


def test_op12_against_brute_force(spark, documents):
    counts = Counter()
    for key, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{key}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    assert variants(queries.op12_spelling_variants(spark, SF_DIR)) == plain_variants(counts)


# byte pairs

ODD = [
    "", None, " ", "  two  blanks\n\n", "<|endoftext|>", "a<|startoftext|>b<|ENDOFTEXT|>", "it's we'LL they're 'd 'x",
    "Ä̈ é ﬁ Σας İstanbul", "1234 12.5,6", "a b c\x85d\x1ce", "日本語 🙂🙂 \x00\x7f", "x" * 3000, "ab" * 4000, "!?" * 500, "́ a", "end.", "A.B,c",
]


def test_codec_equals_the_library(spark):
    library, codec = Tokenizer.from_file(public_path(WORD_FILE)), BytePairCodec(public_path(WORD_FILE))
    rng = random.Random(31)
    alphabet = [*"abcdeABC  \n\t.,'’!?<|>0123éÉßİΣσς̧́\xa0\x1c\x85日本語🙂", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "n't"]
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(4000)]
    texts += [f"a{chr(c)}b {chr(c)}{chr(c)}" for c in [*range(1, 0x3000), *range(0xFB00, 0xFFFE, 7), *range(0x1F300, 0x1F700, 5)]]
    parts = []
    for ids, sizes in codec.encode(pa.array(texts, pa.string())):
        parts += np.split(ids, np.cumsum(sizes)[:-1])
    assert len(parts) == len(texts)
    for text, ids in zip(texts, parts):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want
        assert codec.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_codec_columns(spark):
    library = Tokenizer.from_file(public_path(WORD_FILE))
    rows = [(i % 3, t, "kept") for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = encode_texts(docs, public_path(WORD_FILE))
    assert encoded.columns == ["doc_id", "text", "ids"]
    got = Counter((r["text"], tuple(r["ids"])) for r in encoded.collect())
    assert got == Counter((t, tuple(library.encode(t or "", add_special_tokens=False).ids)) for t in ODD)
    back = decode_texts(encoded.withColumnRenamed("text", "source"), public_path(WORD_FILE))
    assert {(r["source"], r["text"]) for r in back.collect()} == {(t, library.decode(list(i), skip_special_tokens=False)) for t, i in got}
    assert encode_texts(docs.where("false"), public_path(WORD_FILE)).count() == 0
    with pytest.raises(UnknownFile):
        BytePairCodec(public_path("byte_bpe_50k.json"))


def test_op13_against_the_library(spark, documents):
    library = Tokenizer.from_file(public_path(WORD_FILE))
    want = {}
    for key, text in documents:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[key] = (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False)))
    assert {r[0]: tuple(r[1:]) for r in queries.op13_byte_pair_codec(spark, SF_DIR).collect()} == want
