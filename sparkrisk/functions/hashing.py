"""Keyed pseudo-random numbers.

Everything random is a function of (seed, row key), so a lost task that is run
again, another partitioning or another engine all give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int | str, *keys: Column) -> Column:
    """32 hexadecimal digits; ordering rows by them is a keyed random shuffle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def uniform(digest: Column, start: int = 1) -> Column:
    """Number in [0, 1) from eight hexadecimal digits of a digest."""
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("double") / F.lit(4294967296.0)
