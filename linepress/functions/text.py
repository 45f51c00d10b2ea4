"""Scalar text functions, Column -> Column. All stay in the JVM but for those that say otherwise.

Lengths count code points, as Python's len does. Null stays null unless a function says otherwise.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Unicode classes, written for Java's regular expressions.
ALPHA, DIGIT, UPPER, LOWER = r"\p{IsAlphabetic}", "[0-9]", r"\p{IsUppercase}", r"\p{IsLowercase}"
PUNCT = r"[\p{P}\p{S}&&[^\p{IsAlphabetic}]]"
BLANKS = r"[\s\p{Z}\u0085\u001c-\u001f]"
# Characters each fixer deletes.
CARRIAGE_RETURN, BROKEN_CHARS, EXTRACTOR_CHARS = "\r", "\r\u0000‌﻿", "\r\u0000‌"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def delete_chars(text: Column | str, chars: str) -> Column:
    return F.translate(col(text), chars, "")


def charfix(text: Column | str) -> Column:
    """text without carriage returns."""
    return delete_chars(text, CARRIAGE_RETURN)


def fix_broken_chars(text: Column | str) -> Column:
    """text without CR, NUL, zero-width non-joiner and byte order mark."""
    return delete_chars(text, BROKEN_CHARS)


def fix_extracted(text: Column | str) -> Column:
    """text without CR, NUL and zero-width non-joiner: what the extractors delete."""
    return delete_chars(text, EXTRACTOR_CHARS)


def strip(text: Column | str) -> Column:
    """Takes Unicode white space off both ends."""
    return F.regexp_replace(col(text), f"^{BLANKS}+|{BLANKS}+$", "")


def strip_blank_newline(text: Column | str) -> Column:
    """Takes spaces and newlines off both ends."""
    return F.regexp_replace(col(text), r"^[ \n]+|[ \n]+$", "")


def casefold(text: Column | str) -> Column:
    """Full case folding up to the choice of representative; the empty string in between keeps the optimiser from merging the steps."""
    low = F.lower(col(text))
    return F.lower(F.concat(F.upper(F.concat(low, F.lit(""))), F.lit("")))


def count_of(text: Column | str, pattern: str) -> Column:
    return F.regexp_count(col(text), F.lit(pattern))


def alpha_share(text: Column | str) -> Column:
    """Alphabetic characters per character; null for an empty text."""
    return count_of(text, ALPHA) / F.nullif(F.char_length(col(text)), F.lit(0))


def is_title(text: Column | str) -> Column:
    """True if every word starts with a capital and goes on in small letters, and there is one."""
    any_cased = r"[\p{IsUppercase}\p{IsLowercase}\p{Lt}]"
    wrong = rf"(?<={any_cased})[\p{{IsUppercase}}\p{{Lt}}]|(?<!{any_cased})\p{{IsLowercase}}"
    return ~col(text).rlike(wrong) & col(text).rlike(r"[\p{IsUppercase}\p{Lt}]")


def replace_first(text: Column, old: Column, new: Column) -> Column:
    """text with the first occurrence of old replaced by new; text as it is if old isn't there or is empty."""
    at = F.locate(old, text) if isinstance(old, str) else F.call_function("locate", old, text)
    done = F.concat(F.substring(text, F.lit(1), at - 1), new, F.substring(text, at + F.char_length(old), F.char_length(text)))
    return F.when((at > 0) & (F.char_length(old) > 0), done).otherwise(text)


def mean_code_point(text: Column | str) -> Column:
    """Mean code point, to two places (halves go up, in whole numbers, so that engines agree); 0 for an empty text."""
    chars = F.filter(F.split(col(text), ""), lambda c: c != "")
    total = F.aggregate(chars, F.lit(0).cast("long"), lambda a, c: a + F.ascii(c))
    n = F.char_length(col(text))
    return F.when(n == 0, F.lit(0.0)).otherwise(F.floor((total * 200 + n) / (n * 2)) / 100.0)


@F.pandas_udf(StringType())
def xxh64_hex(text: pd.Series) -> pd.Series:
    """XXH64 with seed 0, as 16 hex digits (Arrow batches; Spark's xxhash64 has seed 42)."""
    import xxhash

    return text.map(lambda t: None if t is None else xxhash.xxh64_hexdigest(t.encode("utf-8", "surrogatepass")))


# Letters written out that have no decomposition, and the letters of Cyrillic and Greek in Latin.
SPELLED = {"ß": "ss", "æ": "ae", "ø": "o", "œ": "oe", "đ": "d", "ł": "l", "þ": "th", "ð": "d", "ı": "i", "ħ": "h", "ŧ": "t"}
CYRILLIC = {"а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ж": "zh", "з": "z", "и": "i", "й": "i", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u", "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "iu", "я": "ia", "ё": "io", "є": "ie", "і": "i", "ї": "yi", "ґ": "g", "ђ": "dj", "ј": "j", "љ": "lj", "њ": "nj", "ћ": "c", "џ": "dz", "ў": "u"}
GREEK = {"α": "a", "β": "b", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "e", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "ς": "s", "τ": "t", "υ": "u", "φ": "ph", "χ": "kh", "ψ": "ps", "ω": "o"}


@lru_cache(maxsize=1)
def ascii_tables() -> tuple[str, str, dict[str, str]]:
    """(from, to) of a translate, and what letters become that take several: Latin, Greek, Cyrillic, ligatures and width forms.

    By rule: a letter's compatibility decomposition without marks, its base letter written in Latin; capitals as their small
    letters, with a capital first."""
    base = SPELLED | CYRILLIC | GREEK
    base |= {k.upper(): v.title() for k, v in base.items() if len(k.upper()) == 1 and k.upper() not in base}
    one, long = {}, {}
    for cp in [*range(0x80, 0x3000), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F)]:
        c = chr(cp)
        if unicodedata.combining(c):
            continue
        n = "".join(base.get(x, x) for x in unicodedata.normalize("NFKD", base.get(c, c)) if not unicodedata.combining(x))
        if n != c:
            if len(n) == 1:
                one[c] = n
            else:
                long[c] = n
    return "".join(one), "".join(one.values()), long


def literal_map(table: dict[str, str]) -> Column:
    """table as one literal of the plan: parsed once, when the query is planned."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def char_class(chars: Iterable[str]) -> str:
    """A regular expression's class of these characters, by ranges."""
    out, cps = "", sorted(map(ord, chars))
    while cps:
        n = next((i for i in range(1, len(cps)) if cps[i] != cps[0] + i), len(cps))
        out += f"\\x{{{cps[0]:x}}}" + (f"-\\x{{{cps[n - 1]:x}}}" if n > 1 else "")
        cps = cps[n:]
    return f"[{out}]"


def ascii_letters(text: Column | str) -> Column:
    """Letters in Latin without accents; what has no such form stays. Texts in ASCII skip the tables."""
    x = col(text)
    source, target, long = ascii_tables()
    written = F.array_join(F.transform(F.split(x, ""), lambda c: F.coalesce(F.try_element_at(literal_map(long), c), c)), "")
    wide = F.when(x.rlike(char_class(long)), written).otherwise(x)
    return F.when(F.char_length(x) == F.octet_length(x), x).otherwise(F.regexp_replace(F.translate(wide, source, target), r"\p{Mn}+", ""))


def loose_form(text: Column | str) -> Column:
    """What aggressive near-duplicate keys compare: small letters without accents, spaces, ASCII punctuation and digits."""
    return F.regexp_replace(ascii_letters(F.lower(col(text))), r"[ \p{Punct}0-9]", "")


def draw(seed: str, *key: Column | str) -> Column:
    """A number in [0, 1) that depends on seed and key only: the same on any cluster, at any partitioning, and in other SQL engines."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[col(k).cast("string") for k in key]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def language_tag(source: Column | str, target_lang: Column | str) -> Column:
    """<2xx> and the source text."""
    return F.concat(F.lit("<2"), col(target_lang), F.lit("> "), col(source))


def code_of(label: Column | str) -> Column:
    """A language label in small letters, without blanks and region."""
    return F.regexp_extract(F.lower(F.trim(col(label))), r"^([a-z]*)", 1)
