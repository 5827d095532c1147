"""Declared table schemas (S05-S08): JSON data-package specs → StructType,
conforming a DataFrame to a spec, and CSV read/write with that schema."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Data-package field types and their Spark types.
TYPE_MAP = {"integer": T.LongType(), "number": T.DoubleType(), "datetime": T.TimestampNTZType(),
            "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType()}


def load_spec(path: str, resource_id: int = 0) -> dict:
    """Read a JSON spec; a data package's ``resources[i].schema`` or a bare schema."""
    with open(path) as fh:
        spec = json.load(fh)
    if "resources" in spec:
        spec = spec["resources"][resource_id]["schema"]
    return spec


def schema_from_spec(spec: dict) -> T.StructType:
    """Fields → StructType; ``constraints.required`` → non-nullable."""
    return T.StructType([
        T.StructField(f["name"], TYPE_MAP.get(f.get("type", "string"), T.StringType()),
                      not f.get("constraints", {}).get("required", False))
        for f in spec["fields"]])


def required_fields(spec: dict) -> list[str]:
    return [f["name"] for f in spec["fields"] if f.get("constraints", {}).get("required", False)]


def conform(df: DataFrame, schema: T.StructType, primary_key: list[str] | None = None,
            missing: str = "fill_zero") -> DataFrame:
    """S07 ``sanitize_df``: keep only schema fields, in schema order, cast to
    the declared types; a missing numeric field becomes 0 / 0.0.  A missing
    field of another type is an error, as in the source.  Rows are sorted by
    the primary key within partitions only (a global sort belongs to the sink)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif missing == "fill_zero" and isinstance(f.dataType, (T.LongType, T.DoubleType, T.IntegerType)):
            cols.append(F.lit(0).cast(f.dataType).alias(f.name))
        else:
            raise ValueError(f"column {f.name!r} missing and cannot be filled")
    out = df.select(*cols)
    if primary_key:
        out = out.sortWithinPartitions(*primary_key)
    return out


def check_constraints(df: DataFrame, spec: dict) -> DataFrame:
    """Declared-but-unenforced constraints as a report: NULLs in required
    fields and duplicated primary keys (one aggregation + one grouped count)."""
    req = required_fields(spec)
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in req]) if req else None
    pk = spec.get("primaryKey") or []
    dups = df.groupBy(*pk).count().filter(F.col("count") > 1).count() if pk else 0
    nulls = row.first().asDict() if row is not None else {}
    return {"null_required": nulls, "duplicate_keys": dups}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a declared schema (no inference), header row."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, schema: T.StructType | None = None, mode: str = "overwrite") -> None:
    """Conform (if a schema is given) and write CSV with a header."""
    out = conform(df, schema) if schema is not None else df
    out.write.mode(mode).option("header", True).csv(path)
