"""The vocabulary: every term with a dense index in code point order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letterloom.functions.text import strip_blank
from letterloom.operators.ranking import global_rank


def clean_term(term: Column) -> Column:
    return F.lower(strip_blank(term))


def build_vocabulary(terms: DataFrame, column: str = "term") -> DataFrame:
    """(term, idx) from a column of raw terms; blank lines are left out."""
    distinct = terms.select(clean_term(F.col(column)).alias("term")).where("term <> ''").distinct()
    return global_rank(distinct, "term", rank="rank").select("term", (F.col("rank") - 1).alias("idx"))
