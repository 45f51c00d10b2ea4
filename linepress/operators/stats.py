"""Counts, size matrices, offsets and multi-way metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

MAX_LANGUAGES = 5000


def line_counts(lines: DataFrame, key: str = "ds") -> DataFrame:
    return lines.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def row_numbers(df: DataFrame, key: str, order: str, out: str = "row_no", chunk: int = 100_000) -> DataFrame:
    """df with each row's number (from 1) within its key by the integer column order.

    Two levels: rows of a key are counted by chunks of order, counts are summed up, and only rows of one chunk are sorted
    in one task, so a key that holds a third of all rows is spread over many. Rows of equal order are numbered in any order.
    """
    d = df.withColumn("__chunk", F.floor(F.col(order) / chunk))
    n = d.groupBy(key, "__chunk").agg(F.count(F.lit(1)).alias("__n"))
    n = n.select(key, "__chunk", (F.sum("__n").over(Window.partitionBy(key).orderBy("__chunk")) - F.col("__n")).alias("__before"))
    own = F.row_number().over(Window.partitionBy(key, "__chunk").orderBy(order))
    return d.join(n, [key, "__chunk"]).withColumn(out, F.col("__before") + own).drop("__chunk", "__before")


def size_matrix(sizes: DataFrame) -> DataFrame:
    """src_lang, tgt_lang, n in long form, of rows (src_lang, tgt_lang, size)."""
    return sizes.groupBy("src_lang", "tgt_lang").agg(F.sum("size").alias("n"))


def size_table(sizes: DataFrame, langs: list[str] | None = None) -> DataFrame:
    """One row per source language, one column per target language, 0 where there is nothing. At most MAX_LANGUAGES columns."""
    if not langs:
        langs = [r[0] for r in sizes.select("tgt_lang").distinct().orderBy("tgt_lang").limit(MAX_LANGUAGES + 1).collect()]
        if len(langs) > MAX_LANGUAGES:
            raise ValueError("too many languages for a table with a column for each; use size_matrix")
    return sizes.groupBy("src_lang").pivot("tgt_lang", langs).agg(F.sum("size")).na.fill(0, langs)


def with_total(matrix: DataFrame) -> DataFrame:
    """The long matrix and its grand total in a row with null languages."""
    return matrix.unionByName(matrix.agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("src_lang"), F.lit(None).cast("string").alias("tgt_lang"), "n"))


def shares(df: DataFrame, column: str, out: str = "share") -> DataFrame:
    return df.withColumn(out, F.col(column) / F.sum(column).over(Window.partitionBy()))


def lines_by_language(lines: DataFrame) -> DataFrame:
    """line_no, langs (sorted) of the non-blank lines of a multi-way set (lang, line_no, text)."""
    return lines.filter(F.trim("text") != "").groupBy("line_no").agg(F.array_sort(F.collect_set("lang")).alias("langs"))


def language_lines(lines: DataFrame, chunk: int = 100_000) -> DataFrame:
    """lang, chunk, line_nos (sorted): the non-blank lines of each language, in chunks so that no array grows with the data."""
    d = lines.filter(F.trim("text") != "").withColumn("chunk", F.floor(F.col("line_no") / chunk))
    return d.groupBy("lang", "chunk").agg(F.array_sort(F.collect_list("line_no")).alias("line_nos"))


def line_offsets(lines: DataFrame, key: str = "ds", order: str = "line_no", chunk: int = 100_000) -> DataFrame:
    """key, order, offset: the byte at which each line starts in a file of its dataset with newline ends.

    Two levels, so that a large dataset isn't one task's window: sums of chunks of lines, then a running sum within a chunk.
    """
    d = lines.select(key, order, (F.octet_length("text") + 1).cast("long").alias("__b"), F.floor(F.col(order) / chunk).alias("__c"))
    sums = d.groupBy(key, "__c").agg(F.sum("__b").alias("__t"))
    sums = sums.withColumn("__before", F.sum("__t").over(Window.partitionBy(key).orderBy("__c")) - F.col("__t")).drop("__t")
    w = Window.partitionBy(key, "__c").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = d.withColumn("__to", F.sum("__b").over(w) - F.col("__b"))
    return own.join(sums, [key, "__c"]).select(key, order, (F.col("__before") + F.col("__to")).alias("offset"))


def same_lengths(lines: DataFrame, key: str = "lang") -> None:
    """Raises if the files of a multi-way set don't have the same number of lines."""
    r = line_counts(lines, key).agg(F.min("n"), F.max("n")).first()
    if r[0] != r[1]:
        raise ValueError(f"files differ in length: {r[0]} and {r[1]} lines")


def multiway_meta(lines: DataFrame, files: dict[str, str]) -> DataFrame:
    """kind, key, value (JSON): the metadata of a multi-way set (lang, line_no from 1, text), of which every language has as many
    lines, as rows that can be written and looked up at any size: `files` (language to path), `lang_to_idx` (language and
    chunk of lines: the numbers, from 0, of its non-blank ones), `idx_to_lang` (line: its languages), `offsets` (path and
    chunk: the byte at which each line starts)."""
    same_lengths(lines)
    spark = lines.sparkSession
    d = lines.withColumn("line_no", F.col("line_no") - 1)
    row = lambda df, kind, key, value: df.select(F.lit(kind).alias("kind"), key.alias("key"), value.alias("value"))
    names = row(spark.createDataFrame(sorted(files.items()), "lang STRING, path STRING"), "files", F.col("lang"), F.col("path"))
    to_idx = row(language_lines(d), "lang_to_idx", F.concat_ws(":", "lang", "chunk"), F.to_json("line_nos"))
    all_lines = d.select("line_no").distinct().join(lines_by_language(d), "line_no", "left")
    to_lang = row(all_lines, "idx_to_lang", F.col("line_no").cast("string"), F.to_json(F.coalesce("langs", F.expr("cast(array() as array<string>)"))))
    at = line_offsets(d, "lang").withColumn("chunk", F.floor(F.col("line_no") / 100_000)).groupBy("lang", "chunk").agg(F.array_sort(F.collect_list("offset")).alias("offsets"))
    path = F.element_at(F.create_map(*[F.lit(x) for kv in sorted(files.items()) for x in kv]), F.col("lang"))
    offsets = row(at, "offsets", F.concat_ws(":", path, "chunk"), F.to_json("offsets"))
    return names.unionByName(to_idx).unionByName(to_lang).unionByName(offsets)


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df with a count of its rows that is known once an action has run; no extra pass."""
    o = Observation(name)
    return df.observe(o, F.count(F.lit(1)).alias("rows")), o
