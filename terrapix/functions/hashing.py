"""Key-hash uniform numbers: reproducible sampling independent of partitioning.

``u(key, salt) = int(first 8 hex digits of md5(k1 | k2 | ... | salt), 16) / 2**32``

The same number is computable in any SQL engine with md5, so samples and
splits can be checked against an oracle, and they do not move when the data
is repartitioned (unlike ``DataFrame.sample(seed)``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def hash_key(*parts, salt) -> Column:
    cols = []
    for p in parts:
        cols.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    cols.append(F.lit(str(salt)))
    return F.concat_ws("|", *cols)


def uniform(*parts, salt) -> Column:
    """Deterministic number in [0, 1) from the key columns and a salt."""
    h = F.substring(F.md5(hash_key(*parts, salt=salt)), 1, 8)
    return F.conv(h, 16, 10).cast("bigint") / F.lit(TWO_32)


def sample_salt(seed: int) -> str:
    return str(seed)


def split_salt(seed: int) -> str:
    # independent of the sampling salt, so a split after a sample is unbiased
    return f"split{seed}"
