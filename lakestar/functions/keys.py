"""Stable hashed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_64 = 2**64


def stable_key(name: Column, n_keys: int) -> Column:
    """``int(md5(str(name)).hexdigest(), 16) % n_keys + 1``; 1 when n_keys <= 0.

    The 128-bit digest is reduced by halves, each read as a signed number
    (a negative one stands for itself and 2^64); every product stays below
    2^62 for n_keys < 2^31.
    """
    if n_keys <= 0:
        return F.lit(1).cast("long")
    if n_keys >= 2**31:
        raise ValueError("stable_key supports fewer than 2^31 keys")
    digest = F.md5(name.cast("string"))
    n, wrap = F.lit(n_keys).cast("long"), F.lit(_TWO_64 % n_keys).cast("long")

    def half(begin: int) -> Column:
        signed = F.conv(F.substring(digest, begin, 16), 16, -10).cast("long")
        return F.pmod(signed, n) + F.when(signed < 0, wrap).otherwise(F.lit(0).cast("long"))

    return F.pmod(F.pmod(half(1), n) * wrap + half(17), n) + F.lit(1)
