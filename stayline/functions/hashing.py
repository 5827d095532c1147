"""Deterministic pseudo-randomness (F33, §8.4).

Values depend only on (key, seed), never on partition layout, so reruns after
executor loss or repartitioning give the same draws.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Hexadecimal digits of the md5 that make a draw: 52 bits.
DIGITS = 13


def uniform(seed: int, *keys) -> Column:
    """Uniform [0, 1): the first 52 bits of the md5 of ``seed|key|...`` (keys as text)."""
    cols = [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(str(int(seed))), *cols).cast("binary"))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint").cast("double") / F.lit(float(16 ** DIGITS))


def uniform_sql(seed: int, *keys: str) -> str:
    """The same draw in DuckDB SQL."""
    text = " || '|' || ".join([f"'{int(seed)}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"(CAST(CAST('0x' || substr(md5({text}), 1, {DIGITS}) AS BIGINT) AS DOUBLE) / {float(16 ** DIGITS)!r})"


def bucket(n: int, seed: int, *keys) -> Column:
    """Integer bucket 0..n-1 from the same hash."""
    return F.floor(uniform(seed, *keys) * F.lit(n)).cast("int")
