"""Missing values, duplicates and shape of a raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuscope.functions.numeric import percent, round_even
from corpuscope.operators.cleaning import text_digest


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns that have NULLs: count and percent (2 decimals). One pass over the table."""
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns],
    )
    long = totals.unpivot("_rows", df.columns, "column_name", "missing_count")
    return long.where(F.col("missing_count") > 0).select(
        "column_name", "missing_count",
        round_even(percent(F.col("missing_count"), F.col("_rows")), 2).alias("missing_pct"),
    ).orderBy(F.desc("missing_pct"), F.asc("column_name"))


def duplicate_profile(df: DataFrame, text: str) -> DataFrame:
    """Rows that repeat an earlier text; NULL texts repeat one another.

    Digests are counted in place of texts, so the shuffle carries 32 bytes per distinct text.
    """
    totals = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(text_digest(F.col(text))).alias("distinct_texts"),
        F.max(F.col(text).isNull().cast("long")).alias("has_null"),
    )
    extra = F.col("n_rows") - F.col("distinct_texts") - F.coalesce("has_null", F.lit(0))
    return totals.select(
        "n_rows", extra.alias("duplicate_rows"),
        round_even(percent(extra, F.col("n_rows")), 1).alias("duplicate_pct"),
    )


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows, number of columns, column names."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )
