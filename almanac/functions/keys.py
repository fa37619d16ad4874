"""Seeded hashes of row keys: random-looking values any engine can recompute.

A value depends only on the seed and the key, never on the partition a row is
in or on how often a task is retried.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Size of the surrogate key range and length of a token.
SURROGATE_RANGE = 123456789
TOKEN_LENGTH = 10


def keyed_hash(seed: int, *keys: Column | str) -> Column:
    """32 hex digits from ``seed:key[:key...]``."""
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hex_number(digits: Column, length: int) -> Column:
    """The first ``length`` hex digits as a BIGINT."""
    return F.conv(F.substring(digits, 1, length), 16, 10).cast("bigint")


def surrogate_key(key: Column | str) -> Column:
    """Repeatable integer key below ``SURROGATE_RANGE``."""
    digest = F.md5(_text(key))
    return (hex_number(digest, 8) % SURROGATE_RANGE).cast("int")


def user_token(key: Column | str) -> Column:
    """Repeatable token of ``TOKEN_LENGTH`` hex characters."""
    return F.substring(F.md5(_text(key)), 1, TOKEN_LENGTH)


def random_surrogate_key() -> Column:
    """Integer key from a random UUID; differs from run to run."""
    return (hex_number(F.replace(F.expr("uuid()"), F.lit("-"), F.lit("")), 8) % SURROGATE_RANGE).cast("int")


def random_user_token() -> Column:
    """Token from a random UUID; differs from run to run."""
    return F.substring(F.replace(F.expr("uuid()"), F.lit("-"), F.lit("")), 1, TOKEN_LENGTH)


def _text(key: Column | str) -> Column:
    return (F.col(key) if isinstance(key, str) else key).cast("string")
