"""Exact and near duplicates, first-wins choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepress.functions.text import loose_form, mean_code_point


def digest(*columns: str) -> Column:
    """128 bits that tell rows by the given columns; null differs from '' and no two columns run together."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
    return F.unhex(F.md5(F.concat(*[part(c) for c in columns])))


def distinct_pairs(pairs: DataFrame, source: str = "source_segment", target: str = "target_segment") -> DataFrame:
    """The distinct pairs (binary equality); order them where they are written. Keyed by their digest."""
    d = pairs.select(source, target).withColumn("__d", digest(source, target))
    return d.groupBy("__d").agg(F.any_value(F.struct(source, target)).alias("__p")).select(F.col(f"__p.{source}").alias(source), F.col(f"__p.{target}").alias(target))


def first_of(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order. A minimum of structs by the key's digest: combines before it shuffles,
    no window, and a key that isn't read afterwards isn't shuffled at all."""
    cols = df.columns
    best = F.min_by(F.struct(*cols), F.struct(*order))
    return df.groupBy(digest(*key).alias("__d")).agg(best.alias("__b")).select(*[F.col(f"__b.{c}").alias(c) for c in cols])


def exact_groups(pairs: DataFrame, row_id: str, source: str = "source_segment", target: str = "target_segment") -> DataFrame:
    """pair_hash, n, first_id of each distinct pair; keyed by md5 so that texts are not shuffled."""
    h = F.md5(F.concat_ws("\t", F.coalesce(F.col(source), F.lit("")), F.coalesce(F.col(target), F.lit(""))))
    return pairs.groupBy(h.alias("pair_hash")).agg(F.count(F.lit(1)).alias("n"), F.min(row_id).alias("first_id"))


def near_groups(pairs: DataFrame, row_id: str, source: str = "source_segment", target: str = "target_segment") -> DataFrame:
    """loose_hash, n, best_id, ranking: groups whose sides agree in their loose form, and the member of best ranking
    (highest mean code point, then smallest id)."""
    s, t = F.coalesce(F.col(source), F.lit("")), F.coalesce(F.col(target), F.lit(""))
    d = pairs.select(row_id, F.md5(F.concat_ws("\t", loose_form(s), loose_form(t))).alias("loose_hash"), mean_code_point(F.concat(s, t)).alias("ranking"))
    best = F.min_by(F.struct(F.col(row_id).alias("best_id"), "ranking"), F.struct(-F.col("ranking"), F.col(row_id)))
    return d.groupBy("loose_hash").agg(F.count(F.lit(1)).alias("n"), best.alias("b")).select("loose_hash", "n", "b.best_id", "b.ranking")
