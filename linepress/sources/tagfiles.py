"""Tags of line files: taken out into a sidecar of JSON lines, and put back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepress.functions.text import strip
from linepress.operators import tags
from linepress.sources import readers, writers


def _whole(spark: SparkSession, path: str) -> DataFrame:
    """line_no, text of a file, or of a folder of files whose rows were written in order (number, tab, text)."""
    return readers.read_lines(spark, path).select("line_no", "text")


def extract_tags_file(spark: SparkSession, path: str, text_path: str, tags_path: str, mode: str = "error") -> None:
    """Writes the lines of path, stripped and without tags, and for each line its list of [symbol, item] as JSON."""
    d = _whole(spark, path).withColumn("x", tags.extract_tags(strip("text")))
    d = d.select("line_no", F.col("x.text").alias("text"), tags.to_json_repls("x.repls").alias("repls"))
    writers.write_json_lines(d.select("line_no", "text").repartitionByRange("line_no").sortWithinPartitions("line_no"), text_path, mode)
    writers.write_json_lines(d.select("line_no", "repls").repartitionByRange("line_no").sortWithinPartitions("line_no"), tags_path, mode)


def reinsert_tags_file(spark: SparkSession, text_path: str, tags_path: str, out_path: str, mode: str = "error") -> None:
    """The lines written by extract_tags_file (or their translation, under the same numbers) with their tags put back, in order."""
    d = spark.read.schema("line_no LONG, text STRING").json(text_path)
    t = spark.read.schema("line_no LONG, repls STRING").json(tags_path)
    back = d.join(t, "line_no", "left").withColumn("r", F.coalesce(tags.from_json_repls("repls"), F.expr(f"cast(array() as {tags.REPLS})")))
    writers.write_lines(back.select("line_no", tags.reinsert_tags(strip("text"), "r").alias("text")), out_path, "text", ["line_no"], mode)
