"""Mixing sources to target weights by systematic sampling (problem 7).

Sizes are tokens. Every document of a source has the same expected number of copies; its prefix sums within the source
plus one random offset are cut at the integers, and a document is emitted once per integer boundary crossed. Prefix sums
are taken in two levels (buckets of hashed ids, then rows within a bucket), so no source is ever one task's window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linepress.llm import tokens
from linepress.session import materialise

#: Rows of one source that one window task sorts, about.
ROWS_PER_BUCKET = 50_000


def mix_sources(sized: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: str = "mix", row_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(chosen, report) of rows (row_id, source, n_tokens) and targets (source, target_share, max_repeats).

    chosen: row_id, source, n_tokens, repeats (at least 1). report: one row per listed source with its share asked for
    (normalised over the positive shares), tokens and documents there are, copies expected per document, tokens chosen
    and actual share, and attainable_tokens, the largest size of a mixture in which every source with documents gets its
    share within its cap (given as total_tokens, all shares hold). total_tokens: size of the mixture, by default the tokens of all documents of sources with a
    positive share. A source that its cap keeps below its share stays below; the others don't grow in its place.
    Shares null or below 0 count as 0, max_repeats null as 1; of a source listed twice the larger share holds.
    Documents of unlisted or no source and documents without tokens are not chosen (empty ones can't change a share).
    """
    t = targets.groupBy("source").agg(F.max(F.greatest(F.coalesce("target_share", F.lit(0.0)), F.lit(0.0))).alias("asked"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats")).filter("source IS NOT NULL")
    docs = sized.select(F.col(row_id).alias("row_id"), "source", "n_tokens").filter("source IS NOT NULL AND n_tokens > 0")
    sizes = docs.groupBy("source").agg(F.sum("n_tokens").alias("tokens_there"), F.count(F.lit(1)).alias("docs_there"))
    plan = t.join(sizes, "source", "left").na.fill(0, ["tokens_there", "docs_there"])
    sums = plan.agg(F.sum("asked"), F.sum(F.when(F.col("asked") > 0, F.col("tokens_there"))), F.max("docs_there")).first()
    share_sum, there, most = float(sums[0] or 0), int(sums[1] or 0), int(sums[2] or 0)
    total = float(there if total_tokens is None else total_tokens)
    n_buckets = max(16, -(-most // ROWS_PER_BUCKET))
    plan = plan.withColumn("target_share", F.col("asked") / F.lit(share_sum) if share_sum else F.lit(0.0))
    rate = F.when(F.col("tokens_there") > 0, F.least(F.col("target_share") * F.lit(total) / F.col("tokens_there"), F.col("max_repeats").cast("double"))).otherwise(0.0)
    offset = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "source")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    plan = plan.withColumn("copies_expected", rate).withColumn("offset", offset)
    plan = materialise(plan.drop("asked"), "mix-plan")

    rows = docs.join(plan.filter("copies_expected > 0").select("source", "copies_expected", "offset"), "source")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("row_id", F.lit(seed)), F.lit(n_buckets)))
    before = rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("source", "bucket", (F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("n_before"))
    rows = rows.join(before, ["source", "bucket"])
    rank = F.col("n_before") + F.row_number().over(Window.partitionBy("source", "bucket").orderBy("row_id"))
    upto = F.floor(rank * F.col("copies_expected") + F.col("offset"))
    since = F.floor((rank - 1) * F.col("copies_expected") + F.col("offset"))
    chosen = materialise(rows.withColumn("repeats", (upto - since).cast("int")).filter("repeats > 0").select("row_id", "source", "n_tokens", "repeats"), "mix-chosen")
    got = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens_chosen"), F.max("repeats").alias("most_repeats"))
    report = plan.drop("offset").join(got, "source", "left").na.fill(0, ["tokens_chosen", "most_repeats"])
    held = F.when((F.col("asked_share") > 0) & (F.col("tokens_there") > 0), F.col("max_repeats") * F.col("tokens_there") / F.col("asked_share"))
    with_docs = F.sum(F.when(F.col("tokens_there") > 0, F.col("target_share")).otherwise(0.0)).over(Window.partitionBy())
    report = report.withColumn("asked_share", F.when(F.col("tokens_there") > 0, F.col("target_share") / with_docs))
    report = report.withColumn("attainable_tokens", F.coalesce(F.floor(F.min(held).over(Window.partitionBy())), F.lit(0))).drop("asked_share")
    report = report.withColumn("actual_share", F.col("tokens_chosen") / F.greatest(F.sum("tokens_chosen").over(Window.partitionBy()), F.lit(1)))
    return chosen.withColumnRenamed("row_id", row_id), report


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = materialise(tokens.count_tokens(docs, "doc_id", "text", {"source": F.col("source")}, tokens.vocabulary_path()), "mix-sizes")
    return mix_sources(sized, spark.read.parquet(f"{sf_dir}/mix_targets.parquet"))


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen documents with their repeats, and their source's target and actual share."""
    chosen, report = _mix(spark, sf_dir)
    return chosen.join(report.select("source", "target_share", "actual_share", "max_repeats"), "source")


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]
