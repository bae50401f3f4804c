"""Repeatable pseudo-random numbers.

They depend on the row key alone, so a retried task or another partitioning
gives the same result; ``rand`` and ``randn`` do not promise that.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60


def hash60(key: Column, salt: str = "") -> Column:
    """A uniform integer in [0, 2^60): the first 15 hex digits of an MD5."""
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def uniform(key: Column, salt: str = "") -> Column:
    """A uniform double strictly between 0 and 1."""
    return (hash60(key, salt) + F.lit(0.5)) / F.lit(float(1 << HASH_BITS))


def gaussian_pair(key: Column, salt: str = "") -> tuple[Column, Column]:
    """Two independent standard normal values (Box-Muller)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(key, salt + "r")))
    angle = F.lit(2.0) * F.pi() * uniform(key, salt + "a")
    return radius * F.cos(angle), radius * F.sin(angle)
