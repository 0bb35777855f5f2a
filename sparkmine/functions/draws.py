"""Seeded uniform draws that depend only on the seed and the key.

Unlike ``rand()`` they do not change when a task is retried or the data is laid out differently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEX_DIGITS = 13  # 52 bits, exact in a double


def uniform(seed: Column, key: Column) -> Column:
    """A double in [0, 1): the first 52 bits of MD5 of ``seed:key``."""
    digest = F.md5(F.concat(seed.cast("string"), F.lit(":"), key.cast("string")))
    bits = F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint")
    return bits / F.lit(float(1 << (4 * HEX_DIGITS)))
