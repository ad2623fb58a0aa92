"""CSV files for BI tools, NULL written as ``null``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NULL_TEXT = "null"


def export_csv(df: DataFrame, path: str) -> None:
    """Write a folder of CSV parts with a header, one part per task."""
    writer = df.write.mode("overwrite").option("header", True).option("nullValue", NULL_TEXT)
    writer.option("escape", '"').csv(path)


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read such files back; ``schema`` is a DDL string."""
    reader = spark.read.schema(schema).option("header", True).option("nullValue", NULL_TEXT)
    return reader.option("escape", '"').csv(path)
