"""Commands as steps over one table of pairs: chained in one plan, no files between them."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepress.functions.text import charfix
from linepress.operators import align, dedupe, langid, repair, rules, spans, tags

Step = Callable[[DataFrame], DataFrame]
SOURCE, TARGET = "source_segment", "target_segment"
log = logging.getLogger("linepress")


@dataclass
class Commands:
    """The commands for pairs with columns ds, line_no, source_segment, target_segment, src_lang, tgt_lang."""

    stopwords: dict[str, list[str]] = field(default_factory=dict)
    aliases: dict[str, list[str]] = field(default_factory=dict)
    max_id: int = 5
    dropout: float = 0.1
    seed: str = "linepress"
    orthography: DataFrame | None = None

    def charfix(self, d: DataFrame) -> DataFrame:
        return d.withColumn(SOURCE, charfix(SOURCE)).withColumn(TARGET, charfix(TARGET))

    def bifix(self, source_lang: str | Column, target_lang: str | Column, **options) -> Step:
        return lambda d: repair.fix_pairs(d, SOURCE, TARGET, source_lang, target_lang, **{"orthography": self.orthography, **options})

    def biclean(self, d: DataFrame, detected: rules.Detected | None = None, minimal_length: bool = True) -> DataFrame:
        return rules.keep_clean(d, SOURCE, TARGET, F.col("src_lang"), F.col("tgt_lang"), detected, minimal_length)

    def dedup(self, d: DataFrame) -> DataFrame:
        return dedupe.first_of(d, [SOURCE, TARGET], [F.col("ds"), F.col("line_no")])

    def langcheck(self, d: DataFrame) -> DataFrame:
        return langid.check_languages(d, SOURCE, TARGET, F.col("src_lang"), F.col("tgt_lang"), self.stopwords, aliases=self.aliases).filter("lang_ok").drop("lang_ok")

    def tagprotect(self, d: DataFrame) -> DataFrame:
        return tags.protect_pairs(d, SOURCE, TARGET, align.KEY, self.max_id, self.dropout, self.seed)

    def queries(self, d: DataFrame) -> DataFrame:
        words = F.create_map(*[x for k, v in self.stopwords.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]) if self.stopwords else F.expr("cast(map() as map<string, array<string>>)")
        return spans.with_query_span(d, TARGET, F.try_element_at(words, F.col("tgt_lang")), align.KEY, seed=self.seed)

    def named(self, name: str) -> Step:
        if name not in ("charfix", "biclean", "dedup", "langcheck", "tagprotect", "queries"):
            raise ValueError(f"unknown command {name}")
        return getattr(self, name)


def run(pairs: DataFrame, steps: list[Step | str], commands: Commands | None = None, no_empty: bool = False) -> DataFrame:
    """pairs through all steps. no_empty: an input without rows raises; else it is passed through with a warning."""
    if pairs.isEmpty():
        if no_empty:
            raise ValueError("empty input")
        log.warning("empty input")
    commands = commands or Commands()
    for s in steps:
        pairs = (commands.named(s) if isinstance(s, str) else s)(pairs)
    return pairs
