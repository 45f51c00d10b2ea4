"""Readers: line files, TSV, TMX, SGM, document XML, lexicons, byte offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linepress.functions.text import EXTRACTOR_CHARS, col, delete_chars, fix_extracted, strip
from linepress.operators.align import zip_lines
from linepress.operators.stats import row_numbers

TMX_SCHEMA = "`tuv` ARRAY<STRUCT<`_xml:lang`: STRING, `seg`: STRING>>"


def read_lines(spark: SparkSession, paths: str | list[str], below: str | None = None) -> DataFrame:
    """file, line_no (from 1 within the file), text; records end at \\n only, invalid UTF-8 becomes U+FFFD. below: a glob of
    file names, taken from the whole tree below paths.

    Line numbers come from the order of rows within each split of a file: splits are numbered by their offset, counted,
    and summed, so nothing is collected and a large file isn't one task.
    """
    r = spark.read.option("lineSep", "\n")
    raw = (r.option("recursiveFileLookup", "true").option("pathGlobFilter", below) if below else r).text(paths)
    d = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), F.make_valid_utf8("value").alias("text"))
    sizes = d.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"))
    sizes = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("file").orderBy("block")) - F.col("n")).drop("n")
    # rows of one block have consecutive positions, as a split is read by one task in order
    return d.join(sizes, ["file", "block"]).select("file", (F.col("before") + F.col("pos") - F.col("first") + 1).alias("line_no"), "text")


def read_parallel(spark: SparkSession, source: str, target: str) -> DataFrame:
    """line_no, source_segment, target_segment of two line files; the shorter one is filled up with ''."""
    a = read_lines(spark, source).select("line_no", F.col("text").alias("source_segment"))
    b = read_lines(spark, target).select("line_no", F.col("text").alias("target_segment"))
    return a.join(b, "line_no", "full_outer").select("line_no", F.coalesce("source_segment", F.lit("")).alias("source_segment"), F.coalesce("target_segment", F.lit("")).alias("target_segment"))


def split_tsv(line: Column | str, source_col: int = 0, target_col: int = 1) -> tuple[Column, Column, Column]:
    """(enough columns, source, target) of a TSV line after cleaning and stripping."""
    cells = F.split(strip(fix_extracted(line)), "\t", -1)
    return F.size(cells) > max(source_col, target_col), F.try_element_at(cells, F.lit(source_col + 1)), F.try_element_at(cells, F.lit(target_col + 1))


def extract_tsv(lines: DataFrame, source_col: int = 0, target_col: int = 1, text: str = "text") -> DataFrame:
    """lines with source_segment and target_segment; rows with too few columns are skipped."""
    ok, s, t = split_tsv(F.col(text), source_col, target_col)
    return lines.filter(ok).withColumn("source_segment", s).withColumn("target_segment", t)


def extract_sgm(lines: DataFrame, text: str = "text") -> DataFrame:
    """Lines that, stripped, are a <seg id=...> element, without its tags."""
    x = strip(fix_extracted(F.col(text)))
    inner = F.regexp_replace(F.regexp_replace(x, r'<seg id="\d+">', ""), "</seg>", "")
    return lines.filter(x.startswith("<seg id=") & x.endswith("</seg>")).withColumn(text, strip(inner))


def extract_sgms(source: DataFrame, target: DataFrame, key: list[str] | None = None, text: str = "text") -> DataFrame:
    """Two SGM files as pairs: line_no and both sides of the segments, zipped by their order; the shorter one is filled up with ''.

    source, target: line_no, text (and key, by which several files are kept apart).
    """
    key = key or []

    def numbered(d: DataFrame) -> DataFrame:
        d = extract_sgm(d, text).withColumn("__one", F.concat_ws("\u0001", *key) if key else F.lit(""))
        return row_numbers(d, "__one", "line_no", "__n").select(*key, F.col("__n").alias("line_no"), F.col(text).alias("text"))

    return zip_lines(numbered(source), numbered(target), key=[*key, "line_no"])


def pick_translation(tuv: Column, lang: Column, lang_field: str = "lang") -> Column:
    """The segment of the last variant in exactly this language: text before inner markup, cleaned, newlines to spaces."""
    v = F.try_element_at(F.filter(tuv, lambda x: x[lang_field] == lang), F.lit(-1))
    text = F.element_at(F.split(v["seg"], "<"), 1)
    return F.replace(delete_chars(text, EXTRACTOR_CHARS), F.lit("\n"), F.lit(" "))


def extract_units(units: DataFrame, source_lang: Column, target_lang: Column, tuv: str = "tuv", lang_field: str = "lang") -> DataFrame:
    """Units with source_segment and target_segment; units that lack a side, or have it empty, are dropped."""
    d = units.withColumn("source_segment", pick_translation(F.col(tuv), source_lang, lang_field)).withColumn("target_segment", pick_translation(F.col(tuv), target_lang, lang_field))
    return d.filter((F.col("source_segment") != "") & (F.col("target_segment") != ""))


def read_tmx(spark: SparkSession, paths: str | list[str], fail_fast: bool = False) -> DataFrame:
    """tuv, path of each <tu>; splittable, inner markup kept as text."""
    r = spark.read.format("xml").option("rowTag", "tu").option("mode", "FAILFAST" if fail_fast else "PERMISSIVE").schema(TMX_SCHEMA)
    return r.load(paths if isinstance(paths, str) else ",".join(paths)).select("tuv", F.col("_metadata.file_path").alias("path"))


def extract_tmx(spark: SparkSession, path: str, source_lang: str, target_lang: str) -> DataFrame:
    return extract_units(read_tmx(spark, path), F.lit(source_lang), F.lit(target_lang), lang_field="_xml:lang").select("path", "source_segment", "target_segment")


def extract_tmx_tree(spark: SparkSession, folder: str, langs: list[str], skip_errors: bool = True) -> DataFrame:
    """path, src_lang, tgt_lang, pairs of all .tmx files below folder: for each ordered language pair whose xx-yy occurs in the path."""
    r = spark.read.format("xml").option("rowTag", "tu").option("mode", "PERMISSIVE" if skip_errors else "FAILFAST").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tmx")
    d = r.schema(TMX_SCHEMA).load(folder).select("tuv", F.col("_metadata.file_path").alias("path"))
    pairs = F.array(*[F.struct(F.lit(a).alias("src_lang"), F.lit(b).alias("tgt_lang")) for a in langs for b in langs if a != b])
    d = d.withColumn("p", F.explode(F.filter(pairs, lambda p: F.col("path").contains(F.concat(p["src_lang"], F.lit("-"), p["tgt_lang"])))))
    return extract_units(d, F.col("p.src_lang"), F.col("p.tgt_lang"), lang_field="_xml:lang").select("path", "p.src_lang", "p.tgt_lang", "source_segment", "target_segment")


def read_doc_xml(spark: SparkSession, path: str, tag: str = "doc") -> DataFrame:
    """_id, text of each document element."""
    return spark.read.format("xml").option("rowTag", tag).option("valueTag", "text").schema("_id STRING, text STRING").load(path)


def doc_texts(text: Column | str, tag: str = "doc") -> Column:
    """The text of each element of that name inside a text."""
    return F.regexp_extract_all(col(text), F.lit(rf"(?s)<{tag}[^>]*>(.*?)</{tag}>"), 1)


def read_replacements(spark: SparkSession, path: str) -> DataFrame:
    """lang, wrong, correct of a TSV dictionary, or of all files replacements.xx below a folder: both columns stripped, further
    ones ignored, the last entry of a word wins; lang is '' for a file that doesn't name it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        d = read_lines(spark, path, "replacements.*")
    else:
        d = read_lines(spark, path)
    d = d.withColumn("lang", F.regexp_extract("file", r"replacements\.([a-z]{2})$", 1)).withColumn("c", F.split("text", "\t", -1)).filter(F.size("c") >= 2)
    d = d.select("lang", strip(F.col("c")[0]).alias("wrong"), strip(F.col("c")[1]).alias("correct"), "line_no")
    return d.groupBy("lang", "wrong").agg(F.max_by("correct", "line_no").alias("correct"))


def read_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    """lang, words (sorted, distinct) of all xx.txt files below folder; blank lines and lines with # are skipped."""
    d = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").text(folder)
    d = d.select(F.regexp_extract("_metadata.file_name", r"([a-z]{2})\.txt$", 1).alias("lang"), strip("value").alias("word"))
    return d.filter((F.col("lang") != "") & (F.col("word") != "") & ~F.col("word").startswith("#")).groupBy("lang").agg(F.array_sort(F.collect_set("word")).alias("words"))
