"""Dimension-table helpers.

No join is forced to broadcast: a parameter table is made of literals, whose
size the optimizer knows and broadcasts by itself; larger or derived tables
are left to its size estimates and to adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Parts that every key's rows are spread over by ``salted_join``.
SALTS = 16


def local_dim(spark, rows: list, schema: str) -> DataFrame:
    """A parameter table of a few local rows, as literals of the plan.

    ``createDataFrame`` would make an RDD, whose size the optimizer takes to be
    endless: a join to it shuffles both sides by the few values of its key."""
    fields = StructType.fromDDL(schema).fields
    if not rows:
        return spark.createDataFrame(rows, schema)
    made = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, fields, strict=True)]) for r in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*made)))


def salted_join(rows: DataFrame, dim: DataFrame, key: str, spread: list[str], how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """``rows`` joined to ``dim`` (one row per key) with each key's rows spread
    over ``salts`` tasks by a hash of ``spread``.

    The rows come out partitioned by (key, salt), so an aggregation by the key
    that follows first sums up each part and then shuffles those partial
    results: one hot key is never one task's whole work."""
    part = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    copies = dim.withColumn("__salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return rows.withColumn("__salt", part).join(copies, [key, "__salt"], how).drop("__salt")
