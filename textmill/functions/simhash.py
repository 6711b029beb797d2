"""SimHash fingerprints as 64-bit words in an Arrow UDF; Hamming distance and bands as Column expressions."""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

BANDS = 4
FP = "fp array<long>, norm_len int, n_tokens int"
#: Apostrophes with a letter or digit on either side.
_INNER = re.compile(r"(?<=[^\W_])['\u2019](?=[^\W_])")
#: Shingles that are voted on at once.
TOGETHER = 200_000


@lru_cache(1)
def _blanks() -> dict[int, str]:
    """Every punctuation mark and symbol, to a space."""
    return {i: " " for i in range(sys.maxunicode + 1) if unicodedata.category(chr(i))[0] in "PS"}


def normalise(text: str) -> str:
    """NFKC and casefold; apostrophes inside words go, other punctuation and symbols become spaces."""
    folded = unicodedata.normalize("NFKC", text or "").casefold()
    return " ".join(_INNER.sub("", folded).translate(_blanks()).split())


def shingles(s: str) -> list[str]:
    words = s.split()
    if len(s) < 400:
        joined = s.replace(" ", "")
        grams = [joined[i : i + 5] for i in range(len(joined) - 4)] or [joined] * bool(joined)
        return grams + words
    return words if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]


def _voted(found: list[list[str]], bits: int) -> np.ndarray:
    """A row of packed bits for each list of shingles. Each distinct shingle is hashed once."""
    size, n_words = max(1, -(-bits // 8)), -(-bits // 64)
    number: dict[str, int] = {}
    which = np.array([number.setdefault(x, len(number)) for xs in found for x in xs], np.int64)
    digests = b"".join(hashlib.blake2b(x.encode("utf-8", "ignore"), digest_size=size).digest() for x in number)
    on = np.zeros((len(found), 64 * n_words), np.uint8)
    n = np.array([len(xs) for xs in found], np.int64)
    some = n > 0
    if some.any():
        votes = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, size), axis=1, bitorder="little")[:, :bits]
        total = np.add.reduceat(votes[which], (np.cumsum(n) - n)[some], axis=0, dtype=np.int64)
        on[some, :bits] = 2 * total > n[some, None]
    return np.packbits(on, axis=1, bitorder="little").view(np.int64)


def fingerprints_of(texts: list[str], bits: int = 64) -> list[list[int]]:
    """Words, lowest first, of the fingerprints of normalised texts; a bit is set where more shingles have it than not."""
    out, held, n = [], [], 0
    for s in texts:
        held.append(shingles(s))
        n += len(held[-1])
        if n >= TOGETHER:
            out += _voted(held, bits).tolist()
            held, n = [], 0
    return out + (_voted(held, bits).tolist() if held else [])


def fingerprint(s: str, bits: int = 64) -> list[int]:
    return fingerprints_of([s], bits)[0]


def fingerprints(bits: int = 64):
    """An Arrow UDF: struct of the fingerprint's words, length and words of the normalised text."""

    @F.pandas_udf(FP)
    def run(s: pd.Series) -> pd.DataFrame:
        norm = [normalise(x) for x in s]
        return pd.DataFrame(
            {"fp": fingerprints_of(norm, bits), "norm_len": [len(x) for x in norm], "n_tokens": [len(x.split()) for x in norm]}
        )

    return run


def hamming(a: Column, b: Column) -> Column:
    """Bits in which two fingerprints differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def part(fp: Column, start: int, size: int) -> Column:
    """Bits [start, start + size) of a fingerprint, size 63 at most."""
    word, shift = divmod(start, 64)
    low = F.shiftrightunsigned(F.element_at(fp, word + 1), shift)
    if shift + size > 64:
        low = low.bitwiseOR(F.shiftleft(F.element_at(fp, word + 2), 64 - shift))
    return low.bitwiseAND(F.lit((1 << size) - 1))


def bands(bits: int, n: int = BANDS) -> list[tuple[int, int]]:
    """First bit and size of each band; bits that are left over are in none."""
    return [(i * (bits // n), bits // n) for i in range(n)]
