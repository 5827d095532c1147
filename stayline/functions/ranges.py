"""Range cleaning (D06) as one CASE expression over a broadcast range table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RANGE_COLS = ["OUTLIER_LOW", "VALID_LOW", "IMPUTE", "VALID_HIGH", "OUTLIER_HIGH"]


def cleaned_value(v: Column) -> Column:
    """Clip/NULL ``v`` using the range columns already joined onto the row.

    The source assigns in the order outlier → NULL, then valid-low, then
    valid-high, so a later assignment wins; the CASE lists them in reverse."""
    out_low = v < F.col("OUTLIER_LOW")
    out_high = v > F.col("OUTLIER_HIGH")
    valid_low = ~F.coalesce(out_low, F.lit(False)) & (v < F.col("VALID_LOW"))
    valid_high = ~F.coalesce(out_high, F.lit(False)) & (v > F.col("VALID_HIGH"))
    return (F.when(valid_high, F.col("VALID_HIGH"))
            .when(valid_low, F.col("VALID_LOW"))
            .when(out_low | out_high, F.lit(None).cast("double"))
            .otherwise(v))


def range_flags(v: Column) -> dict[str, Column]:
    """Per-row indicators used by the cleaning report."""
    out_low = v < F.col("OUTLIER_LOW")
    out_high = v > F.col("OUTLIER_HIGH")
    valid_low = ~F.coalesce(out_low, F.lit(False)) & (v < F.col("VALID_LOW"))
    valid_high = ~F.coalesce(out_high, F.lit(False)) & (v > F.col("VALID_HIGH"))
    return {
        "is_outlier": F.coalesce(out_low | out_high, F.lit(False)),
        "is_valid_low": F.coalesce(valid_low, F.lit(False)),
        "is_valid_high": F.coalesce(valid_high, F.lit(False)),
    }


def join_ranges(df: DataFrame, ranges: DataFrame, var_col: str) -> DataFrame:
    """Left-join the range row of each variable (case-insensitive name)."""
    r = ranges.select(F.lower(F.col("VARIABLE")).alias("__rvar"),
                      *[F.col(c).cast("double").alias(c) for c in RANGE_COLS])
    return df.join(r, F.lower(F.col(var_col)) == F.col("__rvar"), "left").drop("__rvar")


def apply_variable_limits(df: DataFrame, ranges: DataFrame, var_col: str = "LEVEL2",
                          value_col: str = "value") -> DataFrame:
    """Clean ``value_col``; variables without a range row pass through."""
    cols = [c for c in df.columns if c != value_col]
    d = join_ranges(df, ranges, var_col)
    v = F.col(value_col)
    return d.select(*cols, F.when(v.isNull(), v).otherwise(cleaned_value(v)).alias(value_col))


def cleaning_report(df: DataFrame, ranges: DataFrame, var_col: str = "LEVEL2",
                    value_col: str = "value") -> DataFrame:
    """Per variable: rows changed, strict outliers, clipped low/high, of non-null rows."""
    d = join_ranges(df.filter(F.col(value_col).isNotNull()), ranges, var_col)
    d = d.filter(F.col("OUTLIER_LOW").isNotNull() | F.col("OUTLIER_HIGH").isNotNull()
                 | F.col("VALID_LOW").isNotNull() | F.col("VALID_HIGH").isNotNull())
    fl = range_flags(F.col(value_col))
    rep = d.groupBy(F.col(var_col).alias("variable")).agg(
        F.count_if(fl["is_outlier"]).alias("n_outlier"),
        F.count_if(fl["is_valid_low"]).alias("n_valid_low"),
        F.count_if(fl["is_valid_high"]).alias("n_valid_high"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return rep.withColumn("n_cleaned", F.col("n_outlier") + F.col("n_valid_low") + F.col("n_valid_high"))
