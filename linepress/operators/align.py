"""Joins by position: lines to pairs, pairs to sidecars, and distinct test sets from training data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepress.functions.text import strip

KEY = ["ds", "line_no"]


def zip_lines(source: DataFrame, target: DataFrame, pad: bool = True, key: list[str] | None = None) -> DataFrame:
    """(key, text) twice -> (key, source_segment, target_segment). pad: the shorter side is filled up with ''; else lines of
    the source alone decide and a missing target is ''."""
    key = key or KEY
    a, b = source.withColumnRenamed("text", "source_segment"), target.withColumnRenamed("text", "target_segment")
    j = a.join(b, key, "full_outer" if pad else "left")
    return j.select(*key, F.coalesce("source_segment", F.lit("")).alias("source_segment"), F.coalesce("target_segment", F.lit("")).alias("target_segment"))


def with_sidecar(lines: DataFrame, sidecar: DataFrame, column: str, key: list[str] | None = None) -> DataFrame:
    """lines with one column of a sidecar of the same key; '' where it has no line."""
    key = key or KEY
    j = lines.join(sidecar.select(*key, column), key, "left")
    return j.withColumn(column, F.coalesce(column, F.lit(""))) if dict(sidecar.dtypes)[column] == "string" else j


def unzip(pairs: DataFrame, key: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    key = key or KEY
    return pairs.select(*key, F.col("source_segment").alias("text")), pairs.select(*key, F.col("target_segment").alias("text"))


def decontaminate(train: DataFrame, test: DataFrame, source: str = "source_segment", target: str = "target_segment") -> DataFrame:
    """train without pairs whose two stripped sides are a pair of test. Rows of train keep their number of copies.

    Keyed by a 128-bit digest of both sides: texts are not shuffled; Spark broadcasts the test side where it is small.
    """
    def digest(d: DataFrame):
        return F.unhex(F.md5(F.concat_ws("\t", strip(F.coalesce(F.col(source), F.lit(""))), strip(F.coalesce(F.col(target), F.lit(""))))))

    keys = test.select(digest(test).alias("__k")).distinct()
    return train.withColumn("__k", digest(train)).join(keys, "__k", "left_anti").drop("__k")
