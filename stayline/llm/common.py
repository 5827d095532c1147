"""Shared column expressions and small helpers of the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.sources.tables import table

#: A word is a maximal run of characters other than ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def text_of(col: str | Column = "text") -> Column:
    """The text, a null one counting as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of ``text`` (empty for a text without any)."""
    return F.array_remove(F.split(text, SPACE_PATTERN), "")


def shuffle_parts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
