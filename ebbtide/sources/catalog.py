"""Table profiles and the SQL entry point."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_sql(
    spark: SparkSession, text: str, params: dict[str, Any] | None = None
) -> DataFrame:
    """Free SQL over the registered views, with named parameters (``:name``)."""
    return spark.sql(text, args=params or {})


def table_info(df: DataFrame, table: str) -> DataFrame:
    """One row per column, in column order. File tables carry no column defaults."""
    rows = [
        (table, position, field.name, field.dataType.simpleString(), field.nullable)
        for position, field in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "table_name string, ordinal_position int, column_name string, "
        "data_type string, is_nullable boolean",
    )


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def date_range(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).agg(
        F.min(column).alias("min_date"),
        F.max(column).alias("max_date"),
        F.countDistinct(column).alias("unique_dates"),
    )
