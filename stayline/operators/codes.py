"""Ordered code lists per stay (D07: J22, A05)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_codes(diag: DataFrame, keys: list[str], code: str, seq: str,
                  tiebreak: list[str] | None = None, name: str = "icd9_codes") -> DataFrame:
    """``array_agg(code ORDER BY seq)`` per key; rows with NULL ``seq`` are
    dropped first, NULL codes are kept (A05).  The array is sorted on
    (seq, *tiebreak) structs after a partial collect — bounded by the codes
    of one stay."""
    tiebreak = tiebreak or []
    d = diag.filter(F.col(seq).isNotNull())
    st = F.struct(F.col(seq).alias("s"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(tiebreak)],
                  F.col(code).cast("string").alias("c"))
    g = d.groupBy(*keys).agg(F.array_sort(F.collect_list(st)).alias("__l"))
    return g.select(*keys, F.transform("__l", lambda x: x.getField("c")).alias(name))
