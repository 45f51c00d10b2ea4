"""Restorative cleaning of segments: white space, entities, mojibake, character maps, punctuation, spelling."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepress.functions import text as T

MAX_CHARS = 5000
# -- fixed values ------------------------------------------------------------------------------------------------------
CYRILLIC_LANGS = "ab av az ba be bg bs ce cv kk ku kv ky mk mn os ru sr tg tk tt ug uk uz".split()
CLOSE_UP = [" !", " ?", " :", " ;", " ,", " )", " }", " ]", " ...", " º", "( ", "{ ", "[ ", "¿ ", "¡ "]
CLOSE_UP_FRENCH = [" ,", " )", " }", " ]", " ...", "( ", "{ ", "[ "]
CONTRACTIONS = "s|S|t|T|m|M|d|D|re|RE|ll|LL|ve|VE|em|EM"
CARON_LANGS = "cs et fi hr ln lt lv sk sl sr yo".split()
#: Letters of other scripts that become Latin ones in texts of languages without that script.
FROM_CYRILLIC = {"Ѐ": "È", "Ё": "Ë", "Ѕ": "S", "Ї": "Ï", "І": "I", "Ј": "J", "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "y", "Х": "X", "Ь": "b", "ѐ": "è", "ё": "ë", "а": "a", "в": "B", "г": "r", "е": "e", "к": "k", "м": "M", "н": "H", "о": "o", "р": "p", "с": "c", "т": "T", "у": "y", "х": "x", "ь": "b", "ѕ": "s", "і": "i", "ї": "ï", "ј": "j", "Ү": "Y", "Һ": "h", "һ": "h", "Ӏ": "I", "ӏ": "I", "Ӓ": "Ä", "ӓ": "ä", "Ԁ": "d", "ԁ": "d", "Ԛ": "Q", "ԛ": "q", "Ԝ": "W", "ԝ": "w", "Ꙇ": "l", "ꙇ": "l", "Ꚃ": "S", "ꚃ": "S"}
FROM_GREEK = {"Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a", "η": "n", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u"}
FROM_HEBREW = {"׳": "'", "״": '"', "־": "-", "׀": "|", "׃": ":"}
#: The same for all languages: line ends, ligatures (no long s), modifier letters, a Latin letter or sign shown in Windows-1252.
LINE_ENDS = {"\u2028": " ", "\n": "", "\r": ""}
LIGATURES = "ﬀﬁﬂﬃﬄﬆ"
MODIFIERS = {"ˁ": "¿", "˂": "<", "˃": ">"}
SHOWN_WRONG = "¿¡µŒœšťŸŽžľ"
NOT_SHOWN_WRONG = "×÷àí"
#: Full-width marks of Japanese, from ASCII in Japanese texts and to it in others; beside the ideographic ones.
FULL_WIDTH = {"{": "｛", "}": "｝", "(": "（", ")": "）", "[": "［", "]": "］", ",": "，", ":": "：", ";": "；", "?": "？", "!": "！", "<": "＜", "=": "＝", ">": "＞", "_": "＿", "'": "｀"}
IDEOGRAPHIC = {"【": "(", "】": ")", "。": ".", "、": ","}
CONTROLS = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f\u206a-\u206f\ufeff\ufff9-\ufffc]")
WIDTHS = re.compile("[\u3000\uff01-\uffef]+")
#: Matches nowhere.
NOTHING = "(?!)"

@lru_cache(maxsize=32)
def char_map(lang: str) -> dict[str, str]:
    """Replacements for one language. Line ends, ligatures and Latin letters shown in Windows-1252 (also with the second byte
    written out, as in Ã<89>) for all; letters and marks of other scripts to Latin where the language's script isn't theirs;
    full-width marks to ASCII or, in Japanese, from it."""
    lang = lang.lower()
    out = dict(LINE_ENDS) | {c: unicodedata.normalize("NFKC", c) for c in LIGATURES} | MODIFIERS
    for c in [*map(chr, range(0xC0, 0x100)), *SHOWN_WRONG]:
        if c not in NOT_SHOWN_WRONG:
            try:
                out[c.encode("utf-8").decode("cp1252")] = c
            except UnicodeDecodeError:
                continue
    for first, seconds in ((0xC3, [*range(0x80, 0x97), *range(0x98, 0xA0), 0xAD]), (0xC4, range(0x80, 0x84))):
        out |= {f"{chr(first)}<{second:02X}>": bytes([first, second]).decode("utf-8") for second in seconds}
    if lang not in CARON_LANGS:
        out |= {"ť": "t'", "ƒ": "f"}
    if lang not in CYRILLIC_LANGS:
        out |= FROM_CYRILLIC
    if lang != "de":
        out |= FROM_HEBREW
    if lang != "el":
        out |= FROM_GREEK
    return out | (FULL_WIDTH if lang == "ja" else {b: a for a, b in FULL_WIDTH.items()} | IDEOGRAPHIC)


def collapse_blanks(text: Column) -> Column:
    """Stages 1 and 2: white space off the ends, runs of spaces to one, numeric entities with blanks in them closed up."""
    x = T.strip_blank_newline(F.regexp_replace(T.strip(text), " +", " "))
    return F.regexp_replace(x, r"& *# *([0-9]{2,6}) *;", "&#$1;")


def _by_language(lang: str | Column, special: dict[str, str], other: str) -> Column:
    """A pattern by language: a literal for one language, else chosen for each row."""
    if isinstance(lang, str):
        return F.lit(special.get(lang, other))
    out = F.lit(other)
    for k, v in special.items():
        out = F.when(lang == k, F.lit(v)).otherwise(out)
    return out


def drop_ranges(text: Column, lang: str | Column) -> Column:
    """Stages 6 and 7: private use, compatibility and specials unless Japanese; typographic blanks; controls up to the no-break space."""
    x = F.regexp_replace(text, _by_language(lang, {"ja": NOTHING}, "[-￿]"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(x, "[ -‏]", ""), "[\u007f- ]", "")


def single_apostrophes(text: Column) -> Column:
    """Stage 8: it''s to it's."""
    return F.regexp_replace(text, rf"(\p{{IsAlphabetic}})''((?:{CONTRACTIONS})\W)", "$1'$2")


def close_up_punctuation(text: Column, lang: str | Column) -> Column:
    """Stage 9: no blank before closing and after opening marks; French keeps blanks before its high punctuation."""
    return T.strip(F.regexp_replace(text, _by_language(lang, {"fr": _blanks_beside(CLOSE_UP_FRENCH)}, _blanks_beside(CLOSE_UP)), F.lit("$1$2")))


def _blanks_beside(marks: list[str]) -> str:
    before = "|".join(re.escape(m[1:]) for m in marks if m[0] == " ")
    after = "|".join(re.escape(m[:-1]) for m in marks if m[-1] == " ")
    return f" ({before})|({after}) "


def _mojibake(word: str) -> str:
    """A word shown in Windows-1252 or Latin-1 that was UTF-8, put right; others as they are."""
    for _ in range(2):
        if word.isascii():
            return word
        for enc in ("cp1252", "latin-1"):
            try:
                new = word.encode(enc).decode("utf-8")
            except UnicodeError:
                continue
            if new != word:
                word = new
                break
        else:
            return word
    return word


def _segment(word: str) -> str:
    """A word with entities and mojibake put right, width forms narrowed, control characters gone, accents composed."""
    word = _mojibake(html.unescape(word) if "&" in word else word)
    if word.isascii():
        return CONTROLS.sub("", word) if not word.isprintable() else word
    return unicodedata.normalize("NFC", CONTROLS.sub("", WIDTHS.sub(lambda m: unicodedata.normalize("NFKC", m.group()), word)))


@lru_cache(maxsize=32)
def _char_pattern(lang: str) -> re.Pattern:
    table = char_map(lang)
    firsts = "".join(sorted({k[0] for k in table}))
    # the class ahead spares trying every key at every character
    return re.compile(f"(?=[{re.escape(firsts)}])(?:" + "|".join(map(re.escape, sorted(table, key=len, reverse=True))) + ")")


def _restored(t: str | None, lang: str | None) -> str | None:
    if t is None:
        return None
    table, pattern = char_map(lang or ""), _char_pattern(lang or "")
    t = html.unescape(" ".join(_segment(w) for w in t.split()))
    return pattern.sub(lambda m: table[m.group()], t)


def restore_text(text: Column | str, lang: str | Column) -> Column:
    """Stages 3 to 5 (Arrow batches): mojibake by word, entities, one pass of the character map."""

    @F.pandas_udf("string")
    def f(text: pd.Series, lang: pd.Series) -> pd.Series:
        return pd.Series([_restored(t, x) for t, x in zip(text, lang)], index=text.index, dtype=object)

    # nondeterministic: keeps the optimiser from running it once for each use of its result
    return f.asNondeterministic()(T.col(text), F.lit(lang) if isinstance(lang, str) else lang)


def fix_text(text: Column | str, lang: str | Column) -> Column:
    """All nine stages, in order; lang: a language or a column of them."""
    x = restore_text(collapse_blanks(T.col(text)), lang)
    return close_up_punctuation(single_apostrophes(drop_ranges(x, lang)), lang)


WORD_OR_GAP = r"[-'\p{IsAlphabetic}]+|[^-'\p{IsAlphabetic}]+"


def fix_spelling(text: Column | str, corrections: Column) -> Column:
    """Words found in the map corrections replaced, case-sensitively, in one pass; what is between words stays."""
    parts = F.regexp_extract_all(T.col(text), F.lit(f"({WORD_OR_GAP})"), 1)
    return F.array_join(F.transform(parts, lambda w: F.coalesce(F.try_element_at(corrections, w), w)), "")


def correction_map(orthography: DataFrame) -> Column:
    """A map literal wrong -> correct per language, of a small table (lang, wrong, correct): lang -> map. At most 100 000 entries."""
    rows = orthography.filter("wrong IS NOT NULL AND correct IS NOT NULL").select("lang", F.trim("wrong"), F.trim("correct")).limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("too many corrections for a map; join them instead")
    by: dict[str, dict[str, str]] = {}
    for lang, wrong, right in sorted(map(tuple, rows)):
        by.setdefault(lang, {})[wrong] = right
    if not by:
        return F.expr("cast(map() as map<string, map<string, string>>)")
    return F.create_map(*[x for lang, d in by.items() for x in (F.lit(lang), F.create_map(*[F.lit(y) for kv in d.items() for y in kv]))])


def spell_pairs(pairs: DataFrame, orthography: DataFrame, source: str, target: str, source_lang: Column, target_lang: Column) -> DataFrame:
    m = correction_map(orthography)
    none = F.expr("cast(map() as map<string, string>)")
    d = pairs.withColumn("__s", F.coalesce(F.try_element_at(m, source_lang), none)).withColumn("__t", F.coalesce(F.try_element_at(m, target_lang), none))
    return d.withColumn(source, fix_spelling(source, F.col("__s"))).withColumn(target, fix_spelling(target, F.col("__t"))).drop("__s", "__t")


def fix_pairs(pairs: DataFrame, source: str, target: str, source_lang: str | Column, target_lang: str | Column, ignore_empty: bool = True, ignore_long: bool = True, aggressive: bool = False, orthography: DataFrame | None = None, ignore_orthography: bool = False) -> DataFrame:
    """Pairs fixed, with seg_hash and ranking added. source_lang, target_lang: the languages of all pairs, or columns of them.

    ignore_empty drops pairs with an empty side before and after fixing. ignore_long lets pairs with a side of more than
    MAX_CHARS through with only blanks and newlines taken off. aggressive: the hash is of the loose form and ranking is
    the mean code point, so that near-duplicates share a hash; else of the text itself, and ranking is 1. orthography: a small
    table (lang, wrong, correct) by which misspelt words are put right in the fixed text, before hash and ranking; languages
    without words in it stay as they are. ignore_orthography leaves this stage out. Pairs let through aren't spelled either.
    """
    s, t = F.col(source), F.col(target)
    filled = lambda d: d.filter((F.col(source) != "") & (F.col(target) != "")) if ignore_empty else d
    long = (F.char_length(s) > MAX_CHARS) | (F.char_length(t) > MAX_CHARS) if ignore_long else F.lit(False)
    d = filled(pairs).withColumn("__long", long)
    d = d.withColumn(source, F.when(F.col("__long"), T.strip_blank_newline(s)).otherwise(fix_text(F.when(~F.col("__long"), s), source_lang)))
    d = d.withColumn(target, F.when(F.col("__long"), T.strip_blank_newline(t)).otherwise(fix_text(F.when(~F.col("__long"), t), target_lang)))
    if orthography is not None and not ignore_orthography:
        m, none = correction_map(orthography), F.expr("cast(map() as map<string, string>)")
        for side, lang in ((source, source_lang), (target, target_lang)):
            corrections = F.when(~F.col("__long"), F.coalesce(F.try_element_at(m, F.lit(lang) if isinstance(lang, str) else lang), none))
            d = d.withColumn("__m", corrections).withColumn(side, F.when(F.col("__long"), F.col(side)).otherwise(fix_spelling(side, F.col("__m")))).drop("__m")
    d = filled(d.drop("__long"))
    if aggressive:
        key, rank = F.concat_ws("\t", T.loose_form(source), T.loose_form(target)), T.mean_code_point(F.concat(s, t))
    else:
        key, rank = F.concat_ws("\t", s, t), F.lit(1.0)
    return d.withColumn("seg_hash", T.xxh64_hex(key)).withColumn("ranking", rank)
