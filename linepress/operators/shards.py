"""Assignment of lines to numbered shards, and replication of small datasets into the shards they lack."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linepress.operators.stats import row_numbers


def shard_of(i: Column, length: Column, n_shards: Column) -> Column:
    """1-based shard of the line with 0-based number i: contiguous blocks of length div n_shards, the rest dealt out from shard 1."""
    block = F.floor(length / n_shards)
    rest = i - block * n_shards
    return F.when(rest < 0, F.floor(i / F.greatest(block, F.lit(1))) + 1).otherwise(F.pmod(rest, n_shards) + 1).cast("int")


def shard_count(length: Column, n_lines: Column, max_shards: int) -> Column:
    return F.least(F.greatest(F.floor(length / F.greatest(n_lines, F.lit(1))), F.lit(1)), F.lit(max_shards)).cast("int")


def assign_shards(lines: DataFrame, min_shards: int = 1, max_shards: int = 10, key: str = "ds", order: str = "line_no") -> DataFrame:
    """lines with n_shards and shard. The smallest dataset gets min_shards; the others as many as their size allows, up to max_shards.

    Lines are numbered because line numbers may have gaps.
    """
    sizes = lines.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.withColumn("__lines", F.greatest(F.floor(F.min("__n").over(Window.partitionBy()) / min_shards), F.lit(1)))
    sizes = sizes.withColumn("n_shards", shard_count(F.col("__n"), F.col("__lines"), max_shards)).drop("__lines")
    d = row_numbers(lines, key, order, "__i").withColumn("__i", F.col("__i") - 1).join(sizes, key)
    return d.withColumn("shard", shard_of(F.col("__i"), F.col("__n"), F.col("n_shards"))).drop("__i", "__n")


def replicate(sharded: DataFrame, max_shards: int = 10, compat: bool = False) -> DataFrame:
    """Lines copied into the shards their dataset lacks: shard c > n_shards holds a copy of a real shard, taken in turn.

    compat: the turn starts again one shard early, so that the last real shard is never copied.
    """
    n = F.greatest(F.col("n_shards") - 1, F.lit(1)) if compat else F.col("n_shards")
    targets = F.filter(F.sequence(F.lit(1), F.lit(max_shards)), lambda c: (c > F.col("n_shards")) & (F.pmod(c - F.col("n_shards") - 1, n) + 1 == F.col("shard")))
    copies = sharded.withColumn("__to", F.explode(F.concat(F.array("shard"), targets)))
    return copies.withColumn("shard", F.col("__to")).drop("__to")
