"""Reproducible pseudo-randomness keyed by the row, not by its place in a partition.

The hashes are md5 and sha256 of a written-out text, so a split or a sample comes out the same on any
cluster size, after a lost executor, and in any other engine that has these two functions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 52
HASH_RANGE = float(2**HASH_BITS)


def hash52(key: Column, seed: int, tag: str = "") -> Column:
    """A 52-bit integer from key, seed and tag: exact in a double, so it can be cut by quantiles."""
    text = F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(tag))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def hash_unit(key: Column, seed: int, tag: str = "") -> Column:
    """The same hash as a double in [0, 1)."""
    return hash52(key, seed, tag).cast("double") / F.lit(HASH_RANGE)


def canonical_text(columns: Mapping[str, Column]) -> Column:
    """``name=value`` pairs in name order; numbers are written as decimals with ten places."""
    parts = []
    for name in sorted(columns):
        number = columns[name].cast("decimal(38,10)").cast("string")
        parts.append(F.concat(F.lit(f"{name}="), F.coalesce(number, F.lit("null"))))
    return F.concat_ws(";", *parts)


def placeholder_score(columns: Mapping[str, Column]) -> Column:
    """A deterministic stand-in probability: the first four bytes of a sha256 over the record."""
    digest = F.sha2(canonical_text(columns), 256)
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
