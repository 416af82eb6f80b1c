"""Edge lists as CSV with a header.

Quotes inside a quoted field are doubled, as common CSV writers do it, so titles with quotes
or backslashes survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_edge_csv(spark: SparkSession, path: str) -> DataFrame:
    """``src, dst`` from the columns named ``source`` and ``target``, wherever they stand."""
    rows = spark.read.option("header", True).option("escape", '"').csv(path)
    return rows.select(F.col("source").alias("src"), F.col("target").alias("dst"))


def write_csv(frame: DataFrame, path: str) -> None:
    """Header CSV, one file per partition: nothing is gathered into one task.

    Blanks at the ends of a value stay. Empty strings and nulls can't be told apart in a CSV file: both
    are read back as null. A line break in a value would end the row for readers that split files, so
    such a value is an error.
    """
    checked = [
        F.when(F.col(name).rlike("[\r\n]"), F.raise_error(F.lit(f"line break in {name}")))
        .otherwise(F.col(name))
        .alias(name)
        if kind == "string"
        else F.col(name)
        for name, kind in frame.dtypes
    ]
    writer = frame.select(*checked).write.mode("overwrite").option("header", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).option("escape", '"').csv(path)


def write_small_csv(frame: DataFrame, path: str) -> None:
    """One CSV file. For results of a known small size only, such as the top k."""
    write_csv(frame.coalesce(1), path)
