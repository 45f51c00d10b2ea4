import pytest
from pyspark.sql import functions as F

from linepress.operators import rules

FINE = ("This is a good sentence here", "Das ist ein guter Satz hier")


def reasons(spark, rows, **kw):
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i INT, s STRING, g STRING, a STRING, b STRING")
    got = rules.judge(d, "s", "g", F.col("a"), F.col("b"), **kw).orderBy("i").collect()
    return [r.reason for r in got]


def pair(s=FINE[0], g=FINE[1], a="en", b="de"):
    return (s, g, a, b)


LONG = "word " * 204 + "abc"  # 1023 characters
CASES = [
    (pair(), "keep"),
    (pair(LONG, LONG.replace("word", "Wort")), "keep"),
    (pair(LONG + "d", LONG.replace("word", "Wort")), "len(left) >= 1024"),
    (pair(LONG.replace("word", "Wort"), LONG + "d"), "len(right) >= 1024"),
    (pair("Re: " + FINE[0]), "c_no_literals(['Re:'], left)"),
    (pair(g="Re: " + FINE[1]), "c_no_literals(['Re:'], right)"),
    (pair("one two", "eins zwei"), "c_minimal_length(left) and c_minimal_length(right)"),
    (pair("one two three four", "eins zwei"), "keep"),
    (pair("a b c", "aaaaa bbbbb ccccc ddddd"), "c_length or c_length_bytes"),
    (pair("ab cd efg", "abc cdef efghijkl "), "keep"),  # exactly 2.0
    (pair("Die Straße ist lang", "DIE STRASSE IST LANG"), "c_identical"),
    (pair("page one two 3", "page one two 44"), "c_identical_wo_digits"),
    (pair("well, it is so", "well it is so."), "c_identical_wo_punct"),
    (pair("a 123456 789 b", "Das 12 ist gut"), "c_majority_alpha(left)"),
    (pair("It is 12 good", "b 123456 789 a"), "c_majority_alpha(right)"),
    (pair("see http://example.org/page for more text", "siehe die Seite im Netz für mehr Text"), "c_no_urls(left)"),
    (pair("a - b - c - more text here", "Das ist ein guter Satz hier"), "c_no_breadcrumbs1(left)"),
    (pair("alpha - beta - gamma more text here", "Das ist ein guter Satz hier"), "keep"),
    (pair("this → that → those are here", "Das ist ein guter Satz hier"), "c_no_breadcrumbs2(left)"),
    (pair("this → that those are here", "Das ist ein guter Satz hier"), "keep"),
    (pair("some GluedWordsHere in this text", "Das ist ein guter Satz hier"), "c_no_glued_words(left)"),
    (pair("some bad ÃÂÃ noise in text", "Das ist ein guter Satz hier"), "args.source_lang in safe_noise_detection_langs and not c_no_noise(left)"),
    (pair("some bad ÃÂÃ noise in text", "Das ist ein guter Satz hier", "xx"), "keep"),
    (pair("this is s p a c e d out text", "Das ist ein guter Satz hier"), "c_no_space_noise(left)"),
    (pair("(a) [b] {c} (d) [e] good words in here yes", "Das ist ein guter Satz hier und da auch"), "c_no_paren(left)"),
    (pair("(a) [b] {c} (d) [e good words in here yes", "Das ist ein guter Satz hier und da auch"), "keep"),
    (pair("a+b+c+d+e+f good words here", "Das ist ein guter Satz hier"), "c_unwanted(left)"),
    (pair('the value is="good" in here', "Das ist ein guter Satz hier"), 'c_inconditional(left)'),
    (pair("escaped \\u00e4b text in here", "Das ist ein guter Satz hier"), "c_no_escaped_unicode(left)"),
    (pair("a value %s is put in here", "Das ist ein guter Satz hier"), 'c_no_literals(["{{", "%s", "}}"], left)'),
    (pair("This Is A Title Here", "Das Ist Ein Titel Hier"), "left.istitle() and right.istitle()"),
    (pair("", "Das ist"), "empty_side"),
    (pair(None, "Das ist"), "empty_side"),
]


@pytest.mark.parametrize("n", range(len(CASES)))
def test_case(spark, n, cache={}):  # noqa: B006
    if not cache:
        cache["got"] = reasons(spark, [c[0] for c in CASES])
    assert cache["got"][n] == CASES[n][1]


def test_language_rules(spark):
    rows = [("en", "de", True, "en", True, "de"), ("en", "de", True, "en", True, "en"), ("en", "de", False, "en", True, "en"), ("es", "ca", True, "es", True, "es"), ("en", "de", True, "fr", True, "de"), ("nb", "da", True, "no", True, "da")]
    d = spark.createDataFrame([(i, "This is a good long sentence right here", "Das ist ein guter langer Satz genau hier", *r) for i, r in enumerate(rows)], "i INT, s STRING, g STRING, a STRING, b STRING, so BOOLEAN, sl STRING, t BOOLEAN, tl STRING")
    got = [r.reason for r in rules.judge(d, "s", "g", F.col("a"), F.col("b"), rules.Detected("so", "sl", "t", "tl")).orderBy("i").collect()]
    assert got == ["keep", "c_different_language", "c_reliable_long_language(right, targetlang)", "keep", "c_reliable_long_language(left, sourcelang)", "keep"]


def test_empty_table_and_clashing_columns(spark):
    d = spark.createDataFrame([], "reason STRING, keep STRING, s STRING, g STRING")
    assert rules.judge(d, "s", "g", F.lit("en"), F.lit("de")).count() == 0
