"""Protection of markup, URLs and e-mail addresses by numbered placeholders, and their re-insertion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepress.functions.text import col, draw, replace_first

# -- fixed values: patterns and templates ------------------------------------------------------------------------------
TAG = r"\s*<(?:[A-Za-z]+|/)[^<]*?>\s*"
URL = r"\b(?:[\w-]+://?|www[.])[^\s()<>]+(?:\(\w+\)|[^\p{Punct}\s]|/)"
EMAIL = r"[^\w][a-z0-9!#$%&'*+/=?^_‘{|}~-]+(?:\.[a-z0-9!#$%&'*+/=?^_‘{|}~-]+)*@(?:[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\.)+[a-z0-9](?:[a-z0-9-]*[a-z0-9])?[^\w]"
#: The URL pattern as first written, with its delimiters taken for part of it; it matches no real URL.
URL_COMPAT = r"#\b(?:(?:[\w-]+://?|www[.])[^\s()<>]+(?:\(\w+\)|(?:[\[^:punct\s]\s\]|/)))#iS"
TEMPLATES = (" [TAG", " [URL", " [EML")
REPLS = "ARRAY<STRUCT<repl: STRING, orig: STRING>>"


def _pattern(compat: bool) -> str:
    return f"({TAG})|({URL_COMPAT if compat else URL})|({EMAIL})"


def find_protected(text: Column | str, compat: bool = False) -> Column:
    """The matches in text, in order, as structs (kind 0 tag, 1 URL, 2 e-mail; item)."""
    items = F.regexp_extract_all(col(text), F.lit(_pattern(compat)), 0)
    url = f"^(?:{URL_COMPAT if compat else URL})$"
    return F.transform(items, lambda m: F.struct(F.when(m.rlike(f"^(?:{TAG})$"), 0).when(m.rlike(url), 1).otherwise(2).alias("kind"), m.alias("item")))


def _symbol(kind: Column, number: Column) -> Column:
    return F.concat(F.element_at(F.array(*map(F.lit, TEMPLATES)), kind + 1), number, F.lit("] "))


def extract_tags(text: Column | str, compat: bool = False) -> Column:
    """struct(text, repls): each match replaced, where it first occurs, by a symbol with the match's number."""
    found = F.transform(find_protected(text, compat), lambda m, i: F.struct(_symbol(m["kind"], i.cast("string")).alias("repl"), m["item"].alias("orig")))
    start = F.struct(col(text).alias("text"), F.expr(f"cast(array() as {REPLS})").alias("repls"))
    return F.aggregate(found, start, lambda a, m: F.struct(replace_first(a["text"], m["orig"], m["repl"]).alias("text"), F.concat(a["repls"], F.array(m)).alias("repls")))


def reinsert_tags(text: Column | str, repls: Column | str) -> Column:
    """Each symbol, without its blanks, replaced by its item where it first occurs; items whose symbol is missing go to the end."""

    def put(a: Column, m: Column) -> Column:
        symbol = F.trim(m["repl"])
        return F.when(F.call_function("locate", symbol, a) > 0, replace_first(a, symbol, m["orig"])).otherwise(F.concat(a, F.lit(" "), m["orig"]))

    return F.aggregate(col(repls), col(text), put)


def protect_pairs(pairs: DataFrame, source: str, target: str, key: list[str], max_id: int = 5, dropout: float = 0.1, seed: str = "tags", compat: bool = False) -> DataFrame:
    """Source and target with matches of the source protected on both sides, and repls.

    Match i gets number i, or none above max_id; a single match gets a random number below max_id. Each match is left as
    it is with probability dropout. A match is logged even when the target lacks it. Draws depend on seed and key only.
    """
    n = F.size("__found")
    chosen = F.transform(
        "__found",
        lambda m, i: F.struct(
            _symbol(
                m["kind"],
                F.when(n == 1, F.floor(draw(seed, F.lit("id"), *key) * max_id).cast("string")).when(i > max_id, F.lit("")).otherwise(i.cast("string")),
            ).alias("repl"),
            m["item"].alias("orig"),
            (draw(seed, i, *key) >= dropout).alias("use"),
        ),
    )
    start = F.struct(F.col(source).alias("s"), F.col(target).alias("t"), F.expr(f"cast(array() as {REPLS})").alias("r"))

    def step(a: Column, m: Column) -> Column:
        done = F.struct(
            replace_first(a["s"], m["orig"], m["repl"]).alias("s"),
            replace_first(a["t"], m["orig"], m["repl"]).alias("t"),
            F.concat(a["r"], F.array(F.struct(m["repl"].alias("repl"), m["orig"].alias("orig")))).alias("r"),
        )
        return F.when(m["use"], done).otherwise(a)

    d = pairs.withColumn("__found", find_protected(source, compat)).withColumn("__p", F.aggregate(chosen, start, step))
    return d.withColumn(source, F.col("__p.s")).withColumn(target, F.col("__p.t")).withColumn("repls", F.col("__p.r")).drop("__found", "__p")


def to_json_repls(repls: Column | str) -> Column:
    """[[symbol, item], ...] as JSON text."""
    return F.to_json(F.transform(col(repls), lambda m: F.array(m["repl"], m["orig"])))


def from_json_repls(text: Column | str) -> Column:
    return F.transform(F.from_json(col(text), "array<array<string>>"), lambda m: F.struct(m[0].alias("repl"), m[1].alias("orig")))
