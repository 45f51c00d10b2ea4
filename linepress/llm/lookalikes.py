"""Visually identical text of different characters (problem 5).

Look-alikes are mapped (one translate over tables built from Unicode's own data and a short list of same-shaped letters),
the mapped values are grouped in SQL under the accent- and case-sensitive collation UNICODE, which makes composed and
decomposed accents equal and ignores invisible format characters; each class gets its smallest stored pair as canonical
member, which is joined back. A cheap binary key, equal whenever the collation says equal, first finds the records that
can be in a class at all, so that whole texts are shuffled once and only those are compared under the collation.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from linepress.functions.text import literal_map
from linepress.session import materialise

#: Letters of other scripts with the shape of a Latin letter (Cyrillic, Greek, Armenian, phonetic, Roman numeral).
SAME_SHAPE = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "Ѕ": "S", "І": "I", "Ј": "J", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "ӏ": "l", "Ӏ": "I",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J", "α": "a", "ρ": "p", "ι": "i", "κ": "k", "υ": "u",
    "Г": "Γ", "П": "Π", "Ф": "Φ", "Л": "Λ", "ф": "φ", "п": "π", "к": "k",
    "օ": "o", "Օ": "O", "ս": "u", "հ": "h", "ց": "g", "ո": "n", "Տ": "S", "Լ": "L",
    "ɡ": "g", "ɑ": "a", "ı": "i",
}
#: Members of a class that one task compares with each other, about; a larger class is split.
SPLIT = 2_000


@lru_cache(maxsize=1)
def written_out() -> dict[str, str]:
    """Compatibility characters of several letters and what they stand for, by rule: all whose NFKC form is longer than one
    and isn't just their composed form, but for the spacing accents, which are no accents on a blank."""
    out = {}
    for cp in range(0x80, 0x20000):
        c = chr(cp)
        if 0xD800 <= cp < 0xE000:
            continue
        n = unicodedata.normalize("NFKC", c)
        if len(n) > 1 and n != unicodedata.normalize("NFC", c) and n[0] != " ":
            out[c] = n
    return out


@lru_cache(maxsize=1)
def mapping() -> tuple[str, str]:
    """The arguments of translate: from, to. Characters without a partner in to are deleted.

    By rule: every character whose NFKC form is one other character maps to that; blanks other than tab and line
    ends map to the space; format characters go. Control characters, which the collation would ignore, become private ones.
    """
    one, gone = {}, []
    for cp in range(0x80, 0x20000):
        c = chr(cp)
        if 0xD800 <= cp < 0xE000:
            continue
        cat = unicodedata.category(c)
        if cat == "Cf":
            gone.append(c)
        elif cat == "Zs":
            one[c] = " "
        elif cat == "Cc":
            one[c] = chr(0xE000 + cp)
        elif len(n := unicodedata.normalize("NFKC", c)) == 1 and n != c:
            one[c] = n
    for cp in range(0x20):
        if cp not in (9, 10, 13):
            one[chr(cp)] = chr(0xE000 + cp)
    one[chr(0x7F)] = chr(0xE07F)
    one |= {a: b for a, b in SAME_SHAPE.items() if a != b}
    # a composed letter of a same-shaped base becomes the composed letter of the other script, where that exists
    for cp in range(0x370, 0x530):
        d = unicodedata.normalize("NFD", chr(cp))
        if len(d) == 2 and d[0] in one and len(n := unicodedata.normalize("NFC", one[d[0]] + d[1])) == 1:
            one[chr(cp)] = n
    return "".join(one) + "".join(gone), "".join(one.values())


@lru_cache(maxsize=1)
def bases() -> tuple[str, str]:
    """The arguments of a translate that takes the accents off composed letters."""
    out = {}
    for cp in range(0xC0, 0x20000):
        d = unicodedata.normalize("NFD", chr(cp))
        if len(d) > 1 and all(unicodedata.combining(x) for x in d[1:]):
            out[chr(cp)] = d[0]
    return "".join(out), "".join(out.values())



def _plain(x: Column) -> Column:
    return F.char_length(x) == F.octet_length(x)


#: Private characters that stand for those of written_out() between the two steps of with_look.
STAND_IN = 0xF000


@lru_cache(maxsize=1)
def _steps() -> tuple[str, str, dict[str, str]]:
    """(from, to) of one translate that maps single letters and gives those of several letters a stand-in, and what each stand-in becomes."""
    source, target = mapping()
    table = {ord(a): (target[i] if i < len(target) else None) for i, a in enumerate(source)}
    long = list(written_out().items())
    stand_in = "".join(chr(STAND_IN + i) for i in range(len(long)))
    kept = len(target)
    return source[:kept] + "".join(c for c, _ in long) + source[kept:], target + stand_in, {chr(STAND_IN + i): t.translate(table) for i, (_, t) in enumerate(long)}


def with_look(df: DataFrame, text: str, look: str, base: str) -> DataFrame:
    """Adds look (text with look-alikes mapped; '' for null; accents, case, digits, number of blanks and punctuation stay)
    and base (equal for all texts that the collation finds equal: look without any mark). Each step is a column of its
    own so that it is computed once; texts in ASCII skip the tables.

    One translate maps all; a text that got a stand-in for several letters is gone through once more. The few texts that hold
    such private characters themselves have the several letters written out first.
    """
    x = F.coalesce(F.col(text), F.lit(""))
    source, target, long = _steps()
    letters = lambda t, table: F.array_join(F.transform(F.split(t, ""), lambda c: F.coalesce(F.try_element_at(literal_map(table), c), c)), "")
    private = f"[\\x{{{STAND_IN:x}}}-\\x{{{STAND_IN + len(long) - 1:x}}}]"
    one = F.when(_plain(x) & ~x.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"), x).when(x.rlike(private), F.translate(letters(x, written_out()), *mapping())).otherwise(F.translate(x, source, target))
    d = df.withColumn("__w", F.struct(one.alias("t"), x.rlike(private).alias("own")))
    w = F.col("__w.t")
    d = d.withColumn(look, F.when(~_plain(w) & ~F.col("__w.own") & w.rlike(private), letters(w, long)).otherwise(w)).drop("__w")
    m = F.col(look)
    return d.withColumn(base, F.when(_plain(m), m).otherwise(F.regexp_replace(F.translate(m, *bases()), r"[\p{M}\p{Cf}ᄀ-ᇿ가-퟿]+", "")))


def _sides(pairs: DataFrame, source: str, target: str, row_id: str) -> DataFrame:
    """row_id, s, t and stored, 128 bits that tell what is stored."""
    d = pairs.select(F.col(row_id).alias("row_id"), F.coalesce(F.col(source), F.lit("")).alias("s"), F.coalesce(F.col(target), F.lit("")).alias("t"))
    return d.withColumn("stored", F.unhex(F.md5(F.concat(F.octet_length("s").cast("string"), F.lit(":"), F.col("s"), F.col("t")))))


def lookalike_records(pairs: DataFrame, source: str = "source_segment", target: str = "target_segment", row_id: str = "pair_id") -> DataFrame:
    """The records that look like another one stored differently: row_id, stored (digest), canon_src, canon_tgt, class_id, n_links.

    Null sides count as empty. Records stored alike share the value stored; a class is a set of records whose both sides
    look the same; its canonical member is the smallest stored pair in binary order; n_links is the number of its records that
    are stored differently. Extra columns are ignored; a row that comes twice counts twice.
    """
    spark = pairs.sparkSession
    base = _sides(pairs, source, target, row_id)
    # the tables of look-alikes are applied to the whole corpus once; of it only digests are kept
    looks = with_look(with_look(base, "s", "__f", "src_base"), "t", "__g", "tgt_base")
    keyed = materialise(looks.select("stored", F.xxhash64("src_base", "tgt_base").alias("sk")), "lookalike-keys")
    mixed = keyed.groupBy("sk").agg(F.min("stored").alias("lo"), F.max("stored").alias("hi")).filter("lo <> hi").select("sk")
    wanted = materialise(keyed.join(mixed, "sk").distinct(), "lookalike-wanted")
    near = with_look(with_look(base.join(wanted, "stored"), "s", "src_form", "__b"), "t", "tgt_form", "__c")
    near = materialise(near.select("sk", "row_id", "stored", "s", "t", "src_form", "tgt_form"), "lookalikes")
    near.createOrReplaceTempView("__lookalike_near")
    return spark.sql("""
        WITH variants AS (
          SELECT sk, stored, count(*) n, min(s) s, min(t) t, min(src_form) src_form, min(tgt_form) tgt_form FROM __lookalike_near GROUP BY sk, stored),
        classes AS (
          SELECT sk, src_form COLLATE UNICODE AS a, tgt_form COLLATE UNICODE AS b, min(struct(s, t, stored)) AS canon, count(*) AS n_forms, sum(n) AS n_rows
          FROM variants GROUP BY sk, src_form COLLATE UNICODE, tgt_form COLLATE UNICODE),
        members AS (
          SELECT v.sk, v.stored, c.canon, c.n_rows - v.n AS n_links, c.n_rows FROM variants v JOIN classes c
          ON v.sk = c.sk AND v.src_form COLLATE UNICODE = c.a AND v.tgt_form COLLATE UNICODE = c.b WHERE c.n_forms > 1)
        SELECT n.row_id, n.stored, m.canon.s AS canon_src, m.canon.t AS canon_tgt, m.canon.stored AS class_id, n.sk, m.n_links, m.n_rows
        FROM __lookalike_near n JOIN members m ON n.sk = m.sk AND n.stored = m.stored""")


@F.pandas_udf(StringType())
def _normal(text: pd.Series) -> pd.Series:
    """Width and other compatibility forms, blanks and accents in their usual form, format characters gone; letters keep their script."""
    table = str.maketrans({c: t for c, t in zip(*_own_script())} | {c: None for c in _own_script()[0][len(_own_script()[1]) :]} | written_out())
    return text.map(lambda t: t if t.isascii() else unicodedata.normalize("NFC", t.translate(table)))


@lru_cache(maxsize=1)
def _own_script() -> tuple[str, str]:
    """mapping() without the letters of other scripts and control characters."""
    source, target = mapping()
    pairs = [(a, b) for a, b in zip(source, target) if a > "\x9f" and (len(n := unicodedata.normalize("NFKC", a)) == 1 and n != a or unicodedata.category(a) == "Zs")]
    return "".join(a for a, _ in pairs) + source[len(target) :], "".join(" " if unicodedata.category(a) == "Zs" else unicodedata.normalize("NFKC", a) for a, _ in pairs)


def canonical_form(pairs: DataFrame, source: str = "source_segment", target: str = "target_segment", row_id: str = "pair_id") -> DataFrame:
    """row_id, canon_src, canon_tgt for every record: one consistent form by which records that look the same are equal.

    That is the canonical member's segments where others look like the record, else its own, with width and compatibility
    forms, special blanks, composed accents and format characters in their usual form. Null sides count as empty.
    """
    own = _sides(pairs, source, target, row_id)
    # by what is stored, so that a row without an id, or an id that comes twice, is joined right
    c = lookalike_records(pairs, source, target, row_id).select("stored", "canon_src", "canon_tgt").dropDuplicates(["stored"])
    j = own.join(c, "stored", "left")
    return j.select("row_id", _normal(F.coalesce("canon_src", "s")).alias("canon_src"), _normal(F.coalesce("canon_tgt", "t")).alias("canon_tgt"))


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical_form(spark.read.parquet(f"{sf_dir}/bifixer.parquet")).withColumnRenamed("row_id", "pair_id")


def classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pair_id, first_pair_id, n_links: the class of each record that looks like another, named by its smallest id, and the number of its links."""
    r = lookalike_records(spark.read.parquet(f"{sf_dir}/bifixer.parquet"))
    first = r.groupBy("class_id", "sk").agg(F.min("row_id").alias("first_pair_id"))
    return r.join(first, ["class_id", "sk"]).select(F.col("row_id").alias("pair_id"), "first_pair_id", "n_links")


def linked_pairs(members: DataFrame) -> DataFrame:
    """row_id_a, row_id_b of every two members of a class that are not stored alike, smaller id first.

    The task asks for every pair. One side of a class is dealt out to parts of SPLIT records and the other is sent to each of
    them, so that no task gets a whole large class.
    """
    m = members.filter("row_id IS NOT NULL").select("class_id", "sk", "row_id", "stored", F.ceil(F.col("n_rows") / SPLIT).cast("int").alias("parts"))
    a = m.withColumn("part", F.pmod(F.xxhash64("row_id"), F.col("parts"))).alias("a")
    b = m.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts").cast("bigint") - 1))).alias("b")
    same = (F.col("a.class_id") == F.col("b.class_id")) & (F.col("a.sk") == F.col("b.sk")) & (F.col("a.part") == F.col("b.part"))
    return a.join(b, same & (F.col("a.stored") != F.col("b.stored")) & (F.col("a.row_id") < F.col("b.row_id"))).select(F.col("a.row_id").alias("row_id_a"), F.col("b.row_id").alias("row_id_b"))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of records of a class that are not stored alike, as the task asks."""
    return linked_pairs(lookalike_records(spark.read.parquet(f"{sf_dir}/bifixer.parquet"))).toDF("pair_id_a", "pair_id_b")
