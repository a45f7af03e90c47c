"""Word caches for the public tokenizer files. A file's path is a parameter of every operator."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow.compute as pc

from .wordcache import WordCache

LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
JOINED = "\x01"  # marks a word that no blank precedes


def public_path(name: str) -> str:
    """Place of a tokenizer file of the installed ``public_tokenizers`` package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, int]:
    """Code points that stand for bytes in byte-level vocabularies: printable bytes for
    themselves, the others in order from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return dict(zip(plain, plain)) | {b: 256 + i for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def json_cache(path: str) -> WordCache:
    """Ids as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them.

    Blanks are put where both kinds of file end a pre-token anyway: between a letter and a
    full stop or comma, and around a lone line end.  Words that are Latin letters are then
    one pre-token and go straight to the file's merges, all others through the whole
    tokenizer, as do texts with a special string.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    merges = tokenizer.model.tokenize
    byte_letters = _byte_letters()
    spaced = tokenizer.normalizer is None  # a leading blank is part of the pre-token
    lead = chr(byte_letters[32]) if spaced else ""

    def whole(texts):
        return [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

    def encode(words, first=False):
        out, rest, rest_at = [], [], []
        for word in words:
            joined = word[:1] == JOINED
            bare = word[1:] if joined else word
            if bare.isascii() and bare.isalpha():
                pre = bare
            elif LATIN.fullmatch(bare):
                pre = (bare if spaced else bare.lower()).encode().decode("latin-1").translate(byte_letters)
            else:
                rest_at.append(len(out))
                rest.append(bare if joined or first else " " + bare)
                out.append(())
                continue
            out.append([t.id for t in merges(pre if joined or first else lead + pre)])
        for i, ids in zip(rest_at, whole(rest) if rest else ()):
            out[i] = ids
        return out

    def spaced_words(texts):
        texts = pc.replace_substring_regex(texts, r"([A-Za-z])([.,])", rf"\1 {JOINED}\2")
        return pc.replace_substring_regex(texts, r"([!-~À-ɏ])\n([!-~À-ɏ])", f"\\1 {JOINED}\n {JOINED}\\2")

    def bare_words(texts):
        texts = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
        return pc.replace_substring_regex(texts, r"([a-z])([.,])", r"\1 \2")

    return WordCache(
        encode,
        lambda text: whole([text])[0],
        (lambda words: encode(words, first=True)) if spaced else None,
        prepare=spaced_words if spaced else bare_words,
        whole=lambda texts: pc.match_substring_regex(texts, rf"  |<\||{JOINED}" if spaced else rf"<\||{JOINED}"),
    )
