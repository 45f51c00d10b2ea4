"""The stateless operators and deduplication over streams (an extension; batch results are the reference)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linepress.functions.text import charfix
from linepress.operators import rules


def clean_stream(pairs: DataFrame, source_lang: str, target_lang: str) -> DataFrame:
    """A stream of pairs through character fixing and the quality rules."""
    d = pairs.withColumn("source_segment", charfix("source_segment")).withColumn("target_segment", charfix("target_segment"))
    return rules.keep_clean(d, "source_segment", "target_segment", F.lit(source_lang), F.lit(target_lang))


def distinct_stream(pairs: DataFrame, at: str, late: str = "1 hour") -> DataFrame:
    """The first of equal pairs that come within the watermark; keyed by a digest, so that the state holds no texts."""
    key = F.md5(F.concat_ws("\t", F.coalesce("source_segment", F.lit("")), F.coalesce("target_segment", F.lit(""))))
    return pairs.withWatermark(at, late).withColumn("pair_hash", key).dropDuplicatesWithinWatermark(["pair_hash"]).drop("pair_hash")


def windowed_counts(events: DataFrame, at: str, key: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return events.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n"))


def into(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Runs all that is there, batch by batch, and stops."""
    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
