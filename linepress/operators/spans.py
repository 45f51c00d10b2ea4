"""Query spans: a random n-gram of the target, to be put behind the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepress.functions.text import draw, strip

#: Characters taken out of a span; delimiter before it; chance of no span; lengths.
STRIPPED = r"?/.,<>;:\|][{}=+)(*&^%$#@!`~"
DELIMITER, DROPOUT, NGRAMS = " ||| ", 0.2, (1, 2, 3)


def stopword_map(stopwords: DataFrame) -> Column:
    """lang -> array of stop words, of a small table (lang, word); more than 100 000 words are refused."""
    rows = stopwords.filter("word IS NOT NULL").select("lang", "word").distinct().limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("too many stop words for a map")
    by: dict[str, list[str]] = {}
    for lang, word in sorted(map(tuple, rows)):
        by.setdefault(lang, []).append(word)
    if not by:
        return F.expr("cast(map() as map<string, array<string>>)")
    return F.create_map(*[x for lang, ws in by.items() for x in (F.lit(lang), F.array(*map(F.lit, ws)))])


def with_query_span(df: DataFrame, text: str, stopwords: Column, key: list[str], out: str = "query", seed: str = "span", dropout: float = DROPOUT, ngrams: tuple[int, ...] = NGRAMS) -> DataFrame:
    """df with a span of text in out, '' where dropped or the text is too short; stopwords is null where the language has none.

    With N more tokens than the span: up to N starts are drawn; the first whose span, without punctuation, doesn't end in
    a stop word is taken, else the last. A text as long as the span is taken whole. Without stop words the first start
    is taken and punctuation stays. The steps are columns of their own, so that none is computed once per try.
    """
    n = F.element_at(F.array(*map(F.lit, ngrams)), (F.floor(draw(seed, F.lit("n"), *key) * len(ngrams)) + 1).cast("int"))
    d = df.withColumn("__drop", draw(seed, F.lit("drop"), *key) < dropout).withColumn("__key", F.concat_ws(":", *key)).withColumn("__stop", stopwords).withColumn("__n", n)
    d = d.withColumn("__tk", F.when(~F.col("__drop"), F.filter(F.split(strip(text), r"\s+"), lambda w: w != "")))
    d = d.withColumn("__room", F.size("__tk") - F.col("__n"))

    def at(i: Column) -> Column:
        return F.array_join(F.slice("__tk", F.greatest(F.floor(draw(seed, i, "__key") * F.col("__room")) + 1, F.lit(1)).cast("int"), F.col("__n")), " ")

    def attempt(a: Column, i: Column) -> Column:
        span = F.translate(at(i), STRIPPED, "")
        return F.when(a["ok"], a).otherwise(F.struct(span.alias("span"), (~F.array_contains("__stop", F.lower(F.element_at(F.split(span, " "), -1)))).alias("ok")))

    start = F.struct(F.lit("").alias("span"), F.lit(False).alias("ok"))
    tries = F.aggregate(F.sequence(F.lit(1), F.greatest("__room", F.lit(1))), start, attempt)
    span = F.when(F.col("__room") < 0, F.lit("")).when(F.col("__room") == 0, F.array_join("__tk", " ")).when(F.col("__stop").isNull(), at(F.lit(1))).otherwise(tries["span"])
    d = d.withColumn(out, F.when(F.col("__drop"), F.lit("")).otherwise(F.coalesce(span, F.lit(""))))
    return d.drop("__drop", "__key", "__stop", "__n", "__tk", "__room")


def paste_query(text: Column, query: Column, delimiter: str = DELIMITER) -> Column:
    """text with the delimiter and query behind it, both stripped, where the query isn't empty."""
    q = F.coalesce(strip(query), F.lit(""))
    return F.when(q != "", F.concat(strip(text), F.lit(delimiter), q)).otherwise(strip(text))


