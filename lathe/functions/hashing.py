"""Hash-derived ordering: the single source of randomness.

``md5(concat_ws('|', key..., seed))`` gives the same hex digest in Spark
and in any SQL engine, so splits, samples and synthetic draws are
reproducible, partition-count independent and checkable by an oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

DEFAULT_SEED = 42


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_order(*keys, seed: int | str = DEFAULT_SEED) -> Column:
    """Lowercase md5 hex of the keys and the seed; sort by it to shuffle."""
    parts = [_as_col(k).cast("string") for k in keys] + [F.lit(str(seed))]
    return F.md5(F.concat_ws("|", *parts))


def hash_unit(*keys, seed: int | str = DEFAULT_SEED, salt: str | None = None) -> Column:
    """A number in [0, 1) from the first 8 hex digits of ``hash_order``."""
    ks = list(keys) + ([F.lit(salt)] if salt is not None else [])
    h = hash_order(*ks, seed=seed)
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_int(*keys, modulus: int, seed: int | str = DEFAULT_SEED,
             salt: str | None = None) -> Column:
    """An integer in [0, modulus) from the first 8 hex digits of the hash."""
    ks = list(keys) + ([F.lit(salt)] if salt is not None else [])
    h = hash_order(*ks, seed=seed)
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(modulus))


ROUNDS = 4   # of the Feistel network below
WALKS = 24   # steps back into the range; see below


def keyed_permutation(index: Column, n: int, key: str) -> Column:
    """The place of ``index`` (0 .. n-1) under a permutation of 0 .. n-1 that
    depends only on ``key``: no sort, no table.

    A Feistel network with modular sums permutes a x b >= n cells, where a is
    the rounded-up root of n, so fewer than a cells lie beyond n - 1; a place
    there is permuted again until it lies below n.  Each step leaves with
    probability above 1 - 1 / a; if ``WALKS`` steps should not do, the query
    fails rather than repeat a place."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    b = max(1, -(-n // a))

    def mixed(i, half):
        digest = F.md5(F.concat_ws("|", F.lit(key), i.cast("string"), half.cast("string")))
        return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")

    def half_round(s, i):
        odd = i % 2 == 1
        return F.struct(F.when(odd, (s["l"] + mixed(i, s["r"])) % a).otherwise(s["l"]).alias("l"),
                        F.when(odd, s["r"]).otherwise((s["r"] + mixed(i, s["l"])) % b).alias("r"))

    def step(x):
        start = F.struct(F.floor(x / b).cast("long").alias("l"), (x % b).cast("long").alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, half_round, lambda s: s["l"] * b + s["r"])

    place = F.aggregate(F.sequence(F.lit(1), F.lit(WALKS)), index.cast("long"),
                        lambda x, w: F.when((w > 1) & (x < n), x).otherwise(step(x)))
    return F.when(place < n, place).otherwise(F.raise_error(F.lit("permutation left its range")).cast("long"))
