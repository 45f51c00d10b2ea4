"""Language identification: a native scorer by stop words, and the interface for models.

The native scorer counts a text's words among each language's stop words; nothing is shuffled. Its labels differ from
those of trained models. A model is any callable list[str] -> list[list[str]] made once per worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepress.functions.text import col

TOP_K, MIN_HITS, MIN_LEAD = 3, 3, 2
LABEL_PREFIX = "__label__"


def stopword_lists(stopwords: DataFrame, max_words: int = 100_000) -> dict[str, list[str]]:
    """lang -> sorted stop words of a small table (lang, word)."""
    rows = stopwords.filter("word IS NOT NULL").select("lang", "word").distinct().limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError("too many stop words")
    by: dict[str, list[str]] = {}
    for lang, word in sorted(map(tuple, rows)):
        by.setdefault(lang, []).append(word)
    return by


def scores(text: Column | str, words: dict[str, list[str]]) -> Column:
    """array of (lang, hits), most hits first, ties by lang; languages without hits are left out."""
    tokens = F.regexp_extract_all(F.lower(col(text)), F.lit(r"(\p{L}+)"), 1)

    def hits(ws: list[str]) -> Column:
        return F.size(F.filter(tokens, lambda w: w.isin(ws)))

    each = F.array(*[F.struct(hits(ws).alias("hits"), F.lit(lang).alias("lang")) for lang, ws in sorted(words.items())])
    found = F.filter(each, lambda s: s["hits"] > 0)
    return F.transform(F.array_sort(F.transform(found, lambda s: F.struct((-s["hits"]).alias("h"), s["lang"].alias("lang")))), lambda s: F.struct(s["lang"].alias("lang"), (-s["h"]).alias("hits")))


def top_labels(scored: Column, k: int = TOP_K) -> Column:
    return F.transform(F.slice(scored, 1, k), lambda s: s["lang"])


def detect(df: DataFrame, text: str, words: dict[str, list[str]], reliable: str = "reliable", lang: str = "detected") -> DataFrame:
    """Adds reliable (MIN_HITS hits, MIN_LEAD times the second) and the best language; null for a text without hits."""
    d = df.withColumn("__s", scores(text, words))
    best, second = F.try_element_at("__s", F.lit(1)), F.try_element_at("__s", F.lit(2))
    sure = (best["hits"] >= MIN_HITS) & (best["hits"] >= MIN_LEAD * F.coalesce(second["hits"], F.lit(0)))
    return d.withColumn(reliable, F.coalesce(sure, F.lit(False))).withColumn(lang, best["lang"]).drop("__s")


def accepted_labels(lang: Column, aliases: dict[str, list[str]] | None = None) -> Column:
    """The labels accepted for a language: itself and its aliases."""
    if not aliases:
        return F.array(lang)
    m = F.create_map(*[x for k, v in aliases.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    return F.array_union(F.array(lang), F.coalesce(F.try_element_at(m, lang), F.expr("cast(array() as array<string>)")))


def check_languages(pairs: DataFrame, source: str, target: str, source_lang: Column, target_lang: Column, words: dict[str, list[str]], k: int = TOP_K, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """Adds preds (top-k labels of either side) and lang_ok: either side has an accepted label among its top k."""
    d = pairs.withColumn("__a", top_labels(scores(source, words), k)).withColumn("__b", top_labels(scores(target, words), k))
    ok = F.arrays_overlap("__a", accepted_labels(source_lang, aliases)) & F.arrays_overlap("__b", accepted_labels(target_lang, aliases))
    return d.withColumn("preds", F.array("__a", "__b")).withColumn("lang_ok", F.coalesce(ok, F.lit(False))).drop("__a", "__b")


def predict_with(df: DataFrame, text: str, load: Callable[[], Callable[[list[str]], list[list[str]]]], column: str = "labels") -> DataFrame:
    """Adds labels from a model that load() makes once per task; a '__label__' prefix is taken off."""

    @F.pandas_udf("array<string>")
    def f(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for b in batches:
            yield pd.Series([[x.removeprefix(LABEL_PREFIX) for x in ls] for ls in model(b.fillna("").tolist())])

    return df.withColumn(column, f(text))
