"""SQL text as a source.

``run_sql`` takes exactly one of a query string or a query file, merges
template parameters and runs it with Spark's named parameter markers
(``:name``) — values are bound, never spliced into the text.  Table names
go through ``IDENTIFIER(:table)`` or are resolved from a name → DataFrame map
registered as temp views.  Restricting later queries to an extracted cohort
is a semi join, not a quoted IN list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def run_sql(spark: SparkSession, query: str | None = None, query_file: str | None = None,
            params: dict | None = None, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    if (query is None) == (query_file is None):
        raise ValueError("give exactly one of query and query_file")
    if query_file is not None:
        with open(query_file) as fh:
            query = fh.read()
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(query, args=params or {})


def restrict_to_cohort(df: DataFrame, cohort: DataFrame, keys: list[str]) -> DataFrame:
    """S04 ``add_exclusion_criteria_from_df``: keep rows whose keys are in the cohort."""
    return df.join(cohort.select(*keys).distinct(), keys, "left_semi")
