"""Layout-independent row hashes.

A 32-bit unsigned value from the first eight hex digits of
``md5(seed ':' key)``. It depends only on the key and the seed, never on how
rows are split into partitions or tasks, and is reproducible in any SQL
engine with ``md5`` (e.g. DuckDB: ``('0x' || substr(md5(..),1,8))::BIGINT``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = 1 << 32


def key_string(*cols: str | Column) -> Column:
    """Canonical string form of a (possibly composite) key: parts joined by '|'."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    if len(parts) == 1:
        return parts[0]
    return F.concat_ws("|", *parts)


def hash32(*cols: str | Column, seed: int = 42) -> Column:
    """Unsigned 32-bit hash of the key columns, as bigint in [0, 2^32)."""
    salted = F.concat(F.lit(f"{seed}:"), key_string(*cols))
    return F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("bigint")


def hash_bucket(h: Column, n_buckets: int) -> Column:
    """Equal-width bucket of a hash32 value, floor(h * n / 2^32), exact in
    integer arithmetic. Balanced whatever the skew of the key itself."""
    if not 0 < n_buckets < (1 << 31):
        raise ValueError("n_buckets must be in [1, 2^31)")
    return F.shiftright(h * F.lit(n_buckets).cast("bigint"), 32).cast("int")
