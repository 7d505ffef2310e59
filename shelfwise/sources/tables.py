"""Saving, loading and exporting tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def save_periods(df: DataFrame, path: str, by: str = "period") -> None:
    """Write the weeks of ``df``, one folder each, and leave the other weeks at ``path`` untouched.

    Running a week again replaces that week alone. Rows are rebalanced by week, so that a week
    gets few files and a large one still many tasks.
    """
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parse_schema(text: str) -> T.StructType | None:
    try:
        return T.StructType.fromJson(json.loads(text))
    except (ValueError, KeyError, TypeError, AttributeError):
        return None


def _write_line(spark: SparkSession, line: str, path: str) -> None:
    spark.createDataFrame([(line,)], "line string").coalesce(1).write.mode("overwrite").text(path)


def plain_header(df: DataFrame, sep: str = "|") -> str:
    return sep.join(df.columns)


def save_delimited(df: DataFrame, path: str, sep: str = "|") -> None:
    """Data without a heading, plus its schema and a plain heading next to it."""
    df.write.mode("overwrite").csv(path, sep=sep, header=False)
    _write_line(df.sparkSession, df.schema.json(), f"{path}.sparkheader")
    _write_line(df.sparkSession, plain_header(df, sep), f"{path}.plainheader")


def load_delimited(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    line = spark.read.text(f"{path}.sparkheader").first()
    schema = parse_schema(line[0]) if line else None
    if schema is None:
        raise ValueError(f"bad schema: {path}.sparkheader")
    return spark.read.schema(schema).csv(path, sep=sep, header=False)


def write_plain_header(spark: SparkSession, path: str, sep: str = "|") -> None:
    """Write the plain heading of a saved table again."""
    _write_line(spark, plain_header(load_delimited(spark, path, sep), sep), f"{path}.plainheader")


def union_saved(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Several saved tables of the same columns as one."""
    return spark.read.parquet(*paths)


def split_export(df: DataFrame, path: str, by: Sequence[str], max_rows_per_file: int = 0) -> None:
    """One folder per value of ``by`` in a single job, instead of one job per value.

    Rows are rebalanced by ``by``: small folders get one file each, and a department with
    most rows is still split over many tasks.
    """
    writer = df.hint("rebalance", *(F.col(c) for c in by)).write.mode("overwrite").partitionBy(*by)
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def export_report(df: DataFrame, path: str, sort: Sequence[str] = (), sep: str = "|") -> None:
    """Delimited report with a heading in every part; the parts are in ``sort`` order.

    Nothing is drawn into one task: parts are range sorted and can be read in sequence.
    """
    ordered = df.orderBy(*sort) if sort else df
    ordered.write.mode("overwrite").csv(path, sep=sep, header=True)
