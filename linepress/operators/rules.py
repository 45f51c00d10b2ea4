"""The ordered cascade of quality rules: the first rule that rejects a pair names the reason, 'keep' if none does.

Built as one CASE, so later rules are not evaluated for rows an earlier one rejects. The two rules that need a language
take detected languages as columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linepress.functions.text import ALPHA, LOWER, PUNCT, UPPER, alpha_share, casefold, col, count_of, is_title

# -- fixed values ------------------------------------------------------------------------------------------------------
MAX_CHARS, MIN_BLANKS, MAX_RATIO = 1024, 2, 2.0
MIN_ALPHA, MAX_URL_CHARS, MAX_BREADCRUMBS, MAX_ARROWS, MAX_PARENTHESES, MAX_UNWANTED = 0.5, 15, 3, 2, 10, 5
BLANK, BREADCRUMBS, ARROWS = "[ \u00a0]", r"( [-/] |[<>*]| : )", "( » |[|→←•·¬])"
NOISE, SPACED, PARENTHESES, UNWANTED = "[\u0080-ÿ]{3,}", "(?d)( .){4,} ", r"[\[\](){}]", r"[+*]"
ESCAPED, GLUED = r"\\u[0-9a-fA-F]{3,}", f"({ALPHA}*{UPPER}{LOWER}+){{3}}"
REPLY, PLACEHOLDERS = ["Re:"], ["{{", "%s", "}}"]
SAFE_NOISE_LANGS = ["en", "es", "fr", "pl", "de", "it", "pt", "nl", "cs", "ro", "fi", "lv", "et", "bg", "hr", "da", "hu", "ga", "eu", "gl", "sl", "sv", "mt", "sk", "is", "lt", "nb", "nn", "no"]
SIMILAR_PAIRS = [("ca", "es"), ("es", "gl"), ("gl", "pt"), ("nn", "no"), ("da", "no")]
LONG_TEXT = 30
#: A URL and its inner groups; lengths of all groups of all matches add up.
URL = (
    r"((?:https?://|www\d{0,3}[.]|[a-z0-9.\-]+[.][a-z]{2,4}/)"
    r"(?:[^\s()<>]|\((:?[^\s()<>]+|(\([^\s()<>]+\)))*\))+"
    r"(?:\(([^\s()<>]+|(\([^\s()<>]+\)))*\)|[^\s`!()\[\]{};:'\".,<>?«»“”‘’]))"
)
URL_GROUPS = 5
URL_HINT = r"https?://|www[0-9]{0,3}[.]|[a-z0-9.\-]+[.][a-z]{2,4}/"
KEEP, EMPTY = "keep", "empty_side"


def _urls(text: Column) -> Column:
    """Characters in all groups of all URLs; nested groups count each time. Null gives 0. Only texts that can hold one are searched."""
    lengths = [F.char_length(F.array_join(F.regexp_extract_all(text, F.lit(URL), k), "")) for k in range(1, 1 + URL_GROUPS)]
    return F.when(text.rlike(URL_HINT), sum(lengths[1:], lengths[0])).otherwise(0)


@dataclass(frozen=True)
class Detected:
    """Names of columns with the detected languages: (reliable, lang) of either side."""

    source_reliable: str
    source_lang: str
    target_reliable: str
    target_lang: str


def _between(x: Column) -> Column:
    return (x >= 1 / MAX_RATIO) & (x <= MAX_RATIO)


def _ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def length_ratio_fails(left: Column, right: Column) -> Column:
    chars = _between(_ratio(F.char_length(left), F.char_length(right)))
    octets = _between(_ratio(F.octet_length(left), F.octet_length(right)))
    return ~(chars | octets)


def _similar(a: Column, b: Column) -> Column:
    return F.concat_ws("+", F.array_sort(F.array(a, b))).isin([f"{x}+{y}" for x, y in SIMILAR_PAIRS])


def _norwegian(x: Column) -> Column:
    return F.when(x == "nb", F.lit("no")).otherwise(x)


def different_language_fails(d: Detected, source_lang: Column, target_lang: Column) -> Column:
    """Both sides are reliably in one language, which isn't one of a pair of similar languages. An undetected side (null) rejects."""
    s, t = _norwegian(source_lang), _norwegian(target_lang)
    a, b = F.col(d.source_lang), F.col(d.target_lang)
    both = F.col(d.source_reliable) & F.col(d.target_reliable)
    fine = ~both | (a != b) | ((a == s) | (a == t)) & _similar(s, t)
    return ~F.coalesce(fine, F.lit(False))


def wrong_long_language(text: Column, reliable: Column, detected: Column, lang: Column) -> Column:
    """A text of more than LONG_TEXT characters is reliably in another language that isn't similar. Undetected passes."""
    a, b = _norwegian(detected), _norwegian(lang)
    return F.coalesce((F.char_length(text) > LONG_TEXT) & reliable & (a != b) & ~_similar(a, b), F.lit(False))


def rules(left: Column, right: Column, source_lang: Column, target_lang: Column, detected: Detected | None = None, minimal_length: bool = True) -> list[tuple[str, Column]]:
    """(reason, rejects) in order; reasons are part of the output contract."""
    both_sides = lambda name, f: [(f"{name}(left)", f(left)), (f"{name}(right)", f(right))]

    def literals(ws: list[str], x: Column) -> Column:
        out = x.contains(ws[0])
        for w in ws[1:]:
            out = out | x.contains(w)
        return out

    def without(pattern: str) -> Column:
        return casefold(F.regexp_replace(left, pattern, "")) == casefold(F.regexp_replace(right, pattern, ""))

    out = [("len(left) >= 1024", F.char_length(left) >= MAX_CHARS), ("len(right) >= 1024", F.char_length(right) >= MAX_CHARS)]
    out += [("c_no_literals(['Re:'], left)", literals(REPLY, left)), ("c_no_literals(['Re:'], right)", literals(REPLY, right))]
    if minimal_length:
        out.append(("c_minimal_length(left) and c_minimal_length(right)", (count_of(left, BLANK) < MIN_BLANKS) & (count_of(right, BLANK) < MIN_BLANKS)))
    out += [
        ("c_length or c_length_bytes", length_ratio_fails(left, right)),
        ("c_identical", casefold(left) == casefold(right)),
        ("c_identical_wo_digits", without("[0-9]")),
        ("c_identical_wo_punct", without(PUNCT)),
    ]
    if detected:
        out.append(("c_different_language", different_language_fails(detected, source_lang, target_lang)))
    out += both_sides("c_majority_alpha", lambda x: alpha_share(x) < MIN_ALPHA)
    out += both_sides("c_no_urls", lambda x: _urls(x) >= MAX_URL_CHARS)
    out += both_sides("c_no_breadcrumbs1", lambda x: count_of(x, BREADCRUMBS) >= MAX_BREADCRUMBS)
    out += both_sides("c_no_breadcrumbs2", lambda x: count_of(x, ARROWS) >= MAX_ARROWS)
    out += both_sides("c_no_glued_words", lambda x: x.rlike(GLUED))
    out += [
        ("args.source_lang in safe_noise_detection_langs and not c_no_noise(left)", source_lang.isin(SAFE_NOISE_LANGS) & left.rlike(NOISE)),
        ("args.target_lang in safe_noise_detection_langs and not c_no_noise(right)", target_lang.isin(SAFE_NOISE_LANGS) & right.rlike(NOISE)),
    ]
    out += both_sides("c_no_space_noise", lambda x: x.rlike(SPACED))
    out += both_sides("c_no_paren", lambda x: count_of(x, PARENTHESES) >= MAX_PARENTHESES)
    out += both_sides("c_unwanted", lambda x: count_of(x, UNWANTED) >= MAX_UNWANTED)
    out += both_sides("c_inconditional", lambda x: x.contains('="'))
    out += both_sides("c_no_escaped_unicode", lambda x: x.rlike(ESCAPED))
    names = str(PLACEHOLDERS).replace("'", '"')
    out += [(f"c_no_literals({names}, left)", literals(PLACEHOLDERS, left)), (f"c_no_literals({names}, right)", literals(PLACEHOLDERS, right))]
    out.append(("left.istitle() and right.istitle()", is_title(left) & is_title(right)))
    if detected:
        out += [
            ("c_reliable_long_language(left, sourcelang)", wrong_long_language(left, F.col(detected.source_reliable), F.col(detected.source_lang), source_lang)),
            ("c_reliable_long_language(right, targetlang)", wrong_long_language(right, F.col(detected.target_reliable), F.col(detected.target_lang), target_lang)),
        ]
    return out


def has_alpha(text: Column | str) -> Column:
    """At least one alphabetic character; stands beside the cascade."""
    return col(text).rlike(ALPHA)


def judge(pairs: DataFrame, source: str, target: str, source_lang: Column, target_lang: Column, detected: Detected | None = None, minimal_length: bool = True) -> DataFrame:
    """pairs with reason and keep. A pair with a null or blank side gets reason 'empty_side'."""
    left, right = F.col(source), F.col(target)
    empty = F.coalesce((F.trim(left) == "") | (F.trim(right) == ""), F.lit(True))
    case = F.when(empty, F.lit(EMPTY))
    for reason, rejects in rules(left, right, source_lang, target_lang, detected, minimal_length):
        case = case.when(F.coalesce(rejects, F.lit(False)), F.lit(reason))
    return pairs.withColumn("reason", case.otherwise(F.lit(KEEP))).withColumn("keep", F.col("reason") == KEEP)


def keep_clean(pairs: DataFrame, source: str, target: str, source_lang: Column, target_lang: Column, detected: Detected | None = None, minimal_length: bool = True) -> DataFrame:
    return judge(pairs, source, target, source_lang, target_lang, detected, minimal_length).filter("keep").drop("reason", "keep")
