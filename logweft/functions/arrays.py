"""Array to text, as a column function and as a SQL function."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def array_to_string(values: Column | str) -> Column:
    """Comma join; NULL stays NULL."""
    return F.array_join(values, ",")


def register_functions(spark: SparkSession) -> None:
    """Define ``array_to_string(array<string>)`` for SQL text; it is inlined, not a Python UDF."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION array_to_string(items ARRAY<STRING>) "
        "RETURNS STRING RETURN array_join(items, ',')"
    )
