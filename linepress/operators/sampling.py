"""Sampling distributions over datasets and reproducible resampling.

Every random choice is a draw() of seed and key, so results depend neither on partitions nor on the engine.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linepress.functions.text import draw, fix_broken_chars, language_tag, strip
from linepress.operators.stats import row_numbers
from linepress.session import broadcast_if_small, is_small, materialise

METHODS = ("original", "uniform", "temperature", "sinkhorn")


def normalise(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """column divided by its sum, or its sum within by; 0 where the sum is 0."""
    total = F.sum(column).over(Window.partitionBy(*(by or [])))
    return df.withColumn(column, F.when(total > 0, F.col(column) / total).otherwise(F.lit(0.0)))


def original(datasets: DataFrame) -> DataFrame:
    """prob in proportion to size."""
    return normalise(datasets.withColumn("prob", F.col("size").cast("double")), "prob")


def uniform(datasets: DataFrame) -> DataFrame:
    """The same prob for every dataset that has lines."""
    return normalise(datasets.withColumn("prob", F.when(F.col("size") > 0, F.lit(1.0)).otherwise(F.lit(0.0))), "prob")


def language_sizes(datasets: DataFrame) -> DataFrame:
    """lang, size: lines in which a language is source or target."""
    sides = datasets.select(F.col("src_lang").alias("lang"), "size").unionByName(datasets.select(F.col("tgt_lang").alias("lang"), "size"))
    return sides.filter("lang <> ''").groupBy("lang").agg(F.sum("size").alias("size"))


def temperature(datasets: DataFrame, t: float = 5.0) -> DataFrame:
    """prob of a dataset is that of its target language: size ** (1/t) over all languages, not yet normalised over datasets."""
    q = normalise(language_sizes(datasets).withColumn("prob", F.pow(F.col("size").cast("double"), F.lit(1.0 / t))), "prob").select("lang", "prob")
    return datasets.join(broadcast_if_small(q), datasets["tgt_lang"] == q["lang"], "left").drop("lang").withColumn("prob", F.coalesce("prob", F.lit(0.0)))


def sinkhorn_matrix(a: np.ndarray, epsilon: float = 1e-9, max_iter: int = 1000) -> np.ndarray:
    """a scaled to doubly stochastic by turns of row and column scaling."""
    c = np.ones(a.shape[1])
    r = np.ones(a.shape[0])
    for _ in range(max_iter):
        r = 1.0 / np.maximum(a @ c, 1e-300)
        c = 1.0 / np.maximum(a.T @ r, 1e-300)
        p = r[:, None] * a * c[None, :]
        if np.abs(p.sum(1) - 1).max() < epsilon:
            break
    return r[:, None] * a * c[None, :]


def sinkhorn(datasets: DataFrame, t: float = 5.0, epsilon: float = 1e-9, max_iter: int = 1000, max_langs: int = 5000) -> DataFrame:
    """prob of a dataset from the language matrix made doubly stochastic, to the power 1/t, columns normalised.

    Languages without any line as source or as target are left out, again until none is. The matrix has a cell for each
    pair of languages (max_langs bounds it) and is fitted on the driver.
    """
    spark = datasets.sparkSession
    cells = datasets.filter("size > 0 AND src_lang <> '' AND tgt_lang <> ''").groupBy("src_lang", "tgt_lang").agg(F.sum("size").alias("n"))
    rows = cells.limit(max_langs * 20 + 1).collect()
    if len(rows) > max_langs * 20:
        raise ValueError("too many language pairs")
    keep = {x for r in rows for x in (r[0], r[1])}
    while True:
        left = [r for r in rows if r[0] in keep and r[1] in keep]
        now = {r[0] for r in left} & {r[1] for r in left}
        if now == keep:
            break
        keep = now
    probs: list[tuple[str, str, float]] = []
    if keep:
        langs = sorted(keep)
        at = {x: i for i, x in enumerate(langs)}
        a = np.zeros((len(langs), len(langs)))
        for s, g, n in left:
            a[at[s], at[g]] += float(n)
        p = sinkhorn_matrix(a, epsilon, max_iter) ** (1.0 / t) * (a > 0)
        p = p / p.sum(axis=0, keepdims=True)
        probs = [(s, g, float(p[at[s], at[g]])) for s in langs for g in langs if p[at[s], at[g]] > 0]
    table = spark.createDataFrame(probs, "src_lang STRING, tgt_lang STRING, prob DOUBLE")
    return datasets.join(F.broadcast(table), ["src_lang", "tgt_lang"], "left").withColumn("prob", F.coalesce("prob", F.lit(0.0)))


def distribution(datasets: DataFrame, method: str = "temperature", t: float = 5.0) -> DataFrame:
    """datasets (ds, src_lang, tgt_lang, size, weight) with prob: of the method, times weight (null counts as 1), normalised."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    d = {"original": original, "uniform": uniform}[method](datasets) if method in ("original", "uniform") else (temperature if method == "temperature" else sinkhorn)(datasets, t)
    d = d.withColumn("prob", F.when(F.col("size") > 0, F.col("prob") * F.coalesce("weight", F.lit(1.0))).otherwise(F.lit(0.0)))
    return normalise(d, "prob")


def cumulative(df: DataFrame, order: list[str], by: list[str] | None = None) -> DataFrame:
    """Rows with prob > 0 and their interval [lo, hi) of the running sum; the last interval is open-ended upwards."""
    part = Window.partitionBy(*(by or []))
    w = part.orderBy(*order)
    d = df.filter("prob > 0").withColumn("hi", F.sum("prob").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.row_number().over(part.orderBy(*[F.col(c).desc() for c in order])) == 1
    return d.withColumn("lo", F.col("hi") - F.col("prob")).withColumn("lo", F.lag("hi", 1, 0.0).over(w)).withColumn("hi", F.when(last, F.lit(2.0)).otherwise(F.col("hi")))


def cursor(k: Column, length: Column, compat: str | None = None) -> Column:
    """1-based line for the k-th draw of a dataset of length lines: round and round. compat 'parallel': the last line is never
    read; 'mono': it is left out of the first round only."""
    if compat == "parallel":
        return F.when(k <= length - 2, k).otherwise(F.pmod(k - (length - 1), F.greatest(length - 1, F.lit(1))) + 1)
    if compat == "mono":
        return F.when(k <= length - 1, k).otherwise(F.pmod(k - length, length) + 1)
    return F.pmod(k - 1, length) + 1


def pick(points: DataFrame, u: str, intervals: DataFrame, key: str | None = None, max_rows: int = 10_000, buckets: int = 4096) -> DataFrame:
    """points joined with the interval [lo, hi) that holds u (of the same key): small intervals are broadcast, many are joined
    by buckets of the unit interval."""
    same = [key] if key else []
    if is_small(intervals, max_rows):
        i = F.broadcast(intervals)
        on = (points[u] >= i["lo"]) & (points[u] < i["hi"])
        return points.join(i, (points[key] == i[key]) & on if key else on).drop(i[key] if key else i["lo"]).drop("lo", "hi")
    p = points.withColumn("__bucket", F.floor(F.col(u) * buckets))
    i = intervals.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col("lo") * buckets), F.floor(F.least(F.col("hi"), F.lit(1.0)) * buckets))))
    return p.join(i, [*same, "__bucket"]).filter((F.col(u) >= F.col("lo")) & (F.col(u) < F.col("hi"))).drop("__bucket", "lo", "hi")


def draws(spark: SparkSession, dist: DataFrame, n: int, seed: str) -> DataFrame:
    """draw_no, ds for n draws with replacement; dist has one row per dataset."""
    u = spark.range(1, n + 1).select(F.col("id").alias("draw_no"), draw(seed, "id").alias("u"))
    c = cumulative(dist, ["ds"]).select("ds", "lo", "hi")
    return pick(u, "u", c).select("draw_no", "ds")


def resample_parallel(pairs: DataFrame, datasets: DataFrame, n: int, method: str = "temperature", t: float = 5.0, add_tag: bool = False, seed: str = "resample", compat: str | None = None) -> DataFrame:
    """n pairs drawn with replacement: draw_no, ds, line_no, source_segment, target_segment.

    pairs: ds, line_no, source_segment, target_segment; datasets: ds, src_lang, tgt_lang, weight. Lines are cleaned of
    broken characters and stripped; pairs with a blank side take no part, so every draw gives a pair. Lines are taken
    round-robin in order of line_no. The number of usable lines per dataset is counted, not assumed.
    """
    spark = pairs.sparkSession
    s, g = strip(fix_broken_chars(F.coalesce("source_segment", F.lit("")))), strip(fix_broken_chars(F.coalesce("target_segment", F.lit(""))))
    clean = pairs.select("ds", "line_no", s.alias("source_segment"), g.alias("target_segment")).filter("source_segment <> '' AND target_segment <> ''")
    sizes = clean.groupBy("ds").agg(F.count(F.lit(1)).alias("size"))
    dist = distribution(datasets.join(sizes, "ds", "left").na.fill(0, ["size"]), method, t)
    return _take(spark, clean, dist, n, seed, compat, add_tag)


def _take(spark: SparkSession, clean: DataFrame, dist: DataFrame, n: int, seed: str, compat: str | None, add_tag: bool) -> DataFrame:
    dist = materialise(dist, "distribution")
    info = broadcast_if_small(dist.select("ds", "size", "tgt_lang"))
    d = row_numbers(draws(spark, dist, n, seed), "ds", "draw_no", "k")
    d = d.join(info, "ds").withColumn("ordinal", cursor(F.col("k"), F.col("size"), compat))
    lines = row_numbers(clean, "ds", "line_no", "ordinal")
    out = d.join(lines, ["ds", "ordinal"])
    if add_tag:
        out = out.withColumn("source_segment", language_tag("source_segment", F.col("tgt_lang")))
    return out.select("draw_no", "ds", "line_no", "source_segment", "target_segment")


def resample_mono(lines: DataFrame, datasets: DataFrame, n: int, method: str = "temperature", t: float = 5.0, dataset_method: str = "original", dataset_t: float = 5.0, seed: str = "mono", compat: str | None = None) -> DataFrame:
    """n lines drawn in two steps, language and then dataset of it: draw_no, lang, ds, line_no, text. Blank lines are kept.

    lines: ds, line_no, text; datasets: ds, lang. Methods: original, uniform, temperature.
    """
    spark = lines.sparkSession

    def probs(df: DataFrame, how: str, tt: float, by: list[str]) -> DataFrame:
        x = {"original": F.col("size").cast("double"), "uniform": F.lit(1.0), "temperature": F.pow(F.col("size").cast("double"), F.lit(1.0 / tt))}[how]
        return normalise(df.withColumn("prob", F.when(F.col("size") > 0, x).otherwise(F.lit(0.0))), "prob", by)

    sizes = lines.groupBy("ds").agg(F.count(F.lit(1)).alias("size"))
    ds = datasets.join(sizes, "ds")
    langs = cumulative(probs(ds.groupBy("lang").agg(F.sum("size").alias("size")), method, t, []), ["lang"]).select("lang", "lo", "hi")
    within = cumulative(probs(ds, dataset_method, dataset_t, ["lang"]), ["ds"], ["lang"]).select("lang", "ds", "size", "lo", "hi")
    u = spark.range(1, n + 1).select(F.col("id").alias("draw_no"), draw(seed, F.lit("lang"), "id").alias("u"), draw(seed, F.lit("ds"), "id").alias("v"))
    d = pick(u, "u", langs).select("draw_no", "lang", "v")
    d = pick(d, "v", within, "lang").select("draw_no", "lang", "ds", "size")
    d = row_numbers(d, "ds", "draw_no", "k").withColumn("ordinal", cursor(F.col("k"), F.col("size"), compat))
    numbered = row_numbers(lines, "ds", "line_no", "ordinal")
    return d.join(numbered, ["ds", "ordinal"]).select("draw_no", "lang", "ds", "line_no", "text")


def shuffled(df: DataFrame, key: list[str], seed: str = "shuffle") -> DataFrame:
    """All rows in a random total order that depends on seed and key only."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), *key)), *key)
