"""Writers: line files, JSON lines, CSV matrices, shard folders, document XML."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_lines(df: DataFrame, path: str, text: str, order: list[str], mode: str = "error") -> None:
    """One column as ordered text: files sort as their rows do."""
    df.orderBy(*order).select(F.col(text).alias("value")).write.mode(mode).option("lineSep", "\n").text(path)


def write_parallel(pairs: DataFrame, source_path: str, target_path: str, order: list[str], mode: str = "error") -> None:
    write_lines(pairs, source_path, "source_segment", order, mode)
    write_lines(pairs, target_path, "target_segment", order, mode)


def json_lines(df: DataFrame) -> DataFrame:
    """Rows as JSON with sorted keys; letters beyond ASCII are kept."""
    return df.select(F.to_json(F.struct(*sorted(df.columns))).alias("value"))


def write_json_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    json_lines(df).write.mode(mode).text(path)


def write_matrix(table: DataFrame, path: str, mode: str = "error") -> None:
    """A pivoted matrix as CSV with a header; numbers with six places."""
    cells = [F.format_string("%f", F.col(c).cast("double")).alias(c) if t != "string" else F.col(c) for c, t in table.dtypes]
    table.select(*cells).coalesce(1).write.mode(mode).option("header", "true").csv(path)


def write_shards(sharded: DataFrame, path: str, mode: str = "error") -> None:
    """Folders shard=001 ... by shard and dataset."""
    d = sharded.withColumn("shard", F.format_string("%03d", F.col("shard")))
    d.repartition("shard", "ds").sortWithinPartitions("ds", "line_no").write.mode(mode).partitionBy("shard", "ds").parquet(path)


def write_by(df: DataFrame, path: str, key: str, mode: str = "error") -> None:
    """One folder per value of key."""
    df.repartition(key).write.mode(mode).partitionBy(key).parquet(path)


def write_units(units: DataFrame, path: str, mode: str = "error") -> None:
    """Translation units (tuv: array of lang, seg) as TMX."""
    tuv = F.transform("tuv", lambda v: F.struct(v["lang"].alias("_xml:lang"), v["seg"].alias("seg")))
    units.select(tuv.alias("tuv")).write.mode(mode).format("xml").option("validateName", "false").option("rootTag", "tmx").option("rowTag", "tu").save(path)


def write_doc_xml(docs: DataFrame, path: str, mode: str = "error", root: str = "docs", tag: str = "doc") -> None:
    """Document elements whose text starts on a line of its own."""
    d = docs.withColumn("_VALUE", F.concat(F.lit("\n"), "text")).drop("text")
    d.write.mode(mode).format("xml").option("rootTag", root).option("rowTag", tag).option("valueTag", "_VALUE").save(path)


def merged(parts: list[DataFrame]) -> DataFrame:
    """The union of pieces by column name."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_once(df: DataFrame, path: str) -> None:
    """Writes unless something is there already."""
    df.write.mode("ignore").parquet(path)
