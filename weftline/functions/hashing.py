"""Hashes and sketches. The portable form is a 60-bit positive number from md5, equal in any SQL engine."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Modulus and multipliers of the permutations of 28-bit hashes; products stay below 2^63.
PRIME = 2147483647


def permutation(i: int) -> tuple[int, int]:
    """Coefficients of the i-th permutation h -> (a h + b) mod PRIME, from a fixed rule."""
    d = hashlib.md5(f"permutation {i}".encode()).hexdigest()
    return int(d[:7], 16) + 1, int(d[8:15], 16)


def md5_key(*cols: Column | str) -> Column:
    """md5 of the parts joined by |, null parts as empty strings."""
    return F.md5(F.concat_ws("|", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]))


def hash60(c: Column, seed: int = 0) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), c)), 1, 15), 16, 10).cast("long")


def hash64(c: Column, seed: int = 0, mode: str = "md5_60") -> Column:
    """``md5_60``, or ``blake2b``: 8 bytes of BLAKE2b, keyed by the seed, as a signed number of the same bits (an Arrow function)."""
    if mode == "md5_60":
        return hash60(c, seed)

    @F.pandas_udf("long")
    def blake(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else int.from_bytes(hashlib.blake2b(f"{seed}|{x}".encode(), digest_size=8).digest(), "big", signed=True))

    return blake(c)


def simhash64(items: Column) -> Column:
    """64-bit SimHash over a list as 16 hexadecimal digits (repeats weigh), hashed by md5's first 16 digits; zeros for none (an Arrow function)."""

    @F.pandas_udf(T.StringType())
    def sketch(hashes: pd.Series) -> pd.Series:
        bits = np.arange(64, dtype=np.uint64)

        def one(h) -> str:
            h = np.array([int(x, 16) for x in h], dtype=np.uint64)
            count = sum((((h[i : i + 4096, None] >> bits) & np.uint64(1)).sum(axis=0, dtype=np.int64) for i in range(0, len(h), 4096)), np.zeros(64, np.int64))
            return f"{int(((2 * count > len(h)).astype(np.uint64) << bits).sum(dtype=np.uint64)):016x}"

        return hashes.map(lambda h: "0" * 16 if h is None or not len(h) else one(h))

    return sketch(F.transform(items, lambda x: F.substring(F.md5(F.concat(F.lit("0|"), x)), 1, 16)))


def small_hash(c: Column) -> Column:
    """28 bits, the input of ``minhash``."""
    return F.conv(F.substring(F.md5(c), 1, 7), 16, 10).cast("long")


@lru_cache(maxsize=8)
def _permuted(n: int):
    a, b = (np.array(x, dtype=np.int64) for x in zip(*map(permutation, range(n))))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def minima(hashes: pd.Series) -> pd.Series:
        return hashes.map(lambda h: None if h is None or not len(h) else ((np.asarray(h, dtype=np.int64)[:, None] * a + b) % PRIME).min(axis=0))

    return minima


@lru_cache(maxsize=8)
def _permuted_by(n: int) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array(x, dtype=np.int64) for x in zip(*map(permutation, range(n))))


@lru_cache(maxsize=8)
def _inverses(n: int) -> list[int]:
    return [pow(permutation(i)[0], -1, PRIME) for i in range(n)]


def unpermuted(sketch: np.ndarray) -> np.ndarray:
    """The hash that holds each position of a sketch."""
    return np.array([(int(v) - permutation(i)[1]) * a % PRIME for i, (v, a) in enumerate(zip(sketch, _inverses(len(sketch))))], dtype=np.int64)


def sketches(words: pa.ListArray, n: int = 128, held: bool = False) -> tuple[np.ndarray, ...]:
    """MinHash sketches of sets of ``small_hash`` values as rows of int32, -1 for empty and null ones.

    With ``held`` also the words, their rows and how many positions of their
    row's sketch they hold.
    """
    a, b = _permuted_by(n)
    size = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    w = pc.list_flatten(words).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(size), n), -1, np.int32)
    row, start = np.repeat(np.arange(len(size)), size), np.cumsum(size) - size
    each, at = np.unique(w, return_inverse=True)
    own = np.zeros(len(w), np.int64)
    # rows are taken in blocks, so that what is permuted at once stays small
    value = ((each[:, None] * a + b) % PRIME).astype(np.int32) if len(each) <= 1 << 16 else None
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(start, start[lo] + (1 << 14), side="right")) - 1)
        some = np.arange(lo, hi)[size[lo:hi] > 0]
        if len(some):
            x, y = start[lo], start[hi - 1] + size[hi - 1]
            v = value[at[x:y]] if value is not None else ((w[x:y, None] * a + b) % PRIME).astype(np.int32)
            out[some] = np.minimum.reduceat(v, start[some] - x, axis=0)
            if held:
                own[x:y] = (v == out[row[x:y]]).sum(axis=1)
        lo = hi
    return (out, w, row, own) if held else (out,)


def minhash(items: Column, n: int = 128) -> Column:
    """array<long> of n minima over permutations of the distinct items; null for none."""
    h = F.transform(F.array_distinct(items), small_hash)
    pairs = F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in map(permutation, range(n))])
    return F.when(F.size(items) > 0, F.transform(pairs, lambda p: F.array_min(F.transform(h, lambda x: (x * p["a"] + p["b"]) % PRIME))))


def add_minhash(df: DataFrame, items: Column, name: str, n: int = 128) -> DataFrame:
    """``df`` and the column ``minhash(items, n)``, permuted over Arrow batches in numpy.

    Nested lambdas over arrays are interpreted row by row; for sketches of
    whole tables this is several times faster.
    """
    hashed = df.withColumn("__h", F.transform(F.array_distinct(items), small_hash))
    return hashed.withColumn(name, _permuted(n)(F.col("__h"))).drop("__h")


def bands(sketch: Column, count: int, rows: int) -> Column:
    """array<struct<position, value>>: bucket keys of a sketch; position is part of the key."""
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.struct(i.alias("position"), F.md5(F.array_join(F.slice(sketch, i * rows + 1, rows), ",")).alias("value")))


def sketch_jaccard(a: Column, b: Column) -> Column:
    """Share of equal positions; 0 if either is missing or their lengths differ."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), same / F.size(a)).otherwise(0.0)


def simhash60(items: Column) -> Column:
    """60-bit SimHash over a list (repeats weigh), a bit is set if more items have it than not; 0 for none."""
    h = F.transform(items, lambda x: hash60(x))
    n = F.size(items)
    # bits are read by 15-digit halves of exact doubles: 60-bit numbers are split at 2^30
    low, high = F.transform(h, lambda x: x % (1 << 30)), F.transform(h, lambda x: F.floor(x / F.lit(1 << 30)))
    count = lambda xs, i: F.aggregate(xs, F.lit(0), lambda s, x: s + (F.floor(x / F.pow(F.lit(2.0), i)) % 2).cast("int"))
    half = lambda xs: F.aggregate(F.sequence(F.lit(0), F.lit(29)), F.lit(0).cast("long"), lambda a, i: a + F.when(2 * count(xs, i) > n, F.pow(F.lit(2.0), i).cast("long")).otherwise(F.lit(0).cast("long")))
    return F.when(n > 0, half(low) + half(high) * (1 << 30)).otherwise(F.lit(0).cast("long"))


@F.pandas_udf(T.LongType())
def _simhash(hashes: pd.Series) -> pd.Series:
    bits = np.arange(60, dtype=np.int64)

    def one(h) -> int:
        h = np.asarray(h, dtype=np.int64)
        count = sum(((h[i : i + 4096, None] >> bits) & 1).sum(axis=0) for i in range(0, len(h), 4096))
        return int(((2 * count > len(h)).astype(np.int64) << bits).sum())

    return hashes.map(lambda h: 0 if h is None or not len(h) else one(h))


def add_simhash(df: DataFrame, items: Column, name: str) -> DataFrame:
    """``df`` and the column ``simhash60(items)``, counted over Arrow batches in numpy."""
    return df.withColumn("__h", F.transform(items, lambda x: hash60(x))).withColumn(name, _simhash("__h")).drop("__h")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of every lower-case word, padded by two spaces before and one after."""
    words = F.filter(F.split(F.trim(F.regexp_replace(F.lower(c), "[^0-9a-z가-힣]+", " ")), " +"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))))


def set_similarity(a: Column, b: Column) -> Column:
    """Size of the intersection over that of the union; 0 for two empty sets."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def trigram_similarity(a: Column, b: Column) -> Column:
    return set_similarity(trigrams(a), trigrams(b))
