from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linepress.functions import text as T

ODD = ["", " ", "a", "straße", "STRASSE", "a\r\u0000‌﻿b", " x ", "é😀", "Ⅷ", None]


def column(spark, values, expr):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, x STRING")
    return [r[0] for r in d.orderBy("i").select(expr).collect()]


def test_deletions(spark):
    assert column(spark, ODD, T.charfix("x"))[5] == "a\u0000‌﻿b"
    assert column(spark, ODD, T.fix_broken_chars("x"))[5] == "ab"
    assert column(spark, ODD, T.fix_extracted("x"))[5] == "a﻿b"
    assert column(spark, ODD, T.strip("x"))[6] == "x"
    assert column(spark, ODD, T.charfix("x"))[-1] is None


def test_casefold_equates_sharp_s(spark):
    got = column(spark, ["straße", "STRASSE", "Straße"], T.casefold("x"))
    assert len(set(got)) == 1


def test_title(spark):
    words = ["Hello World", "Hello world", "HELLO", "1 Abc", "", "Ein Das-Wort", "They'Re", "abc"]
    assert column(spark, words, T.is_title("x")) == [w.istitle() for w in words]


def test_random_strings_against_python(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), max_codepoint=0x2FFF), max_size=12), min_size=5, max_size=40))
    def check(values):
        assert column(spark, values, F.char_length("x")) == [len(v) for v in values]
        want = [0.0 if not v else (200 * sum(map(ord, v)) + len(v)) // (2 * len(v)) / 100 for v in values]
        assert column(spark, values, T.mean_code_point("x")) == want

    check()


def test_hash_is_seed_zero(spark):
    import xxhash

    assert column(spark, ["ab", ""], T.xxh64_hex("x")) == [xxhash.xxh64_hexdigest(b"ab"), xxhash.xxh64_hexdigest(b"")]


def test_replace_first(spark):
    d = spark.createDataFrame([("a<b><b>", "<b>"), ("abc", "x"), ("abc", "")], "t STRING, o STRING")
    assert [r[0] for r in d.select(T.replace_first(F.col("t"), F.col("o"), F.lit("#"))).collect()] == ["a#<b>", "abc", "abc"]


def test_draw_does_not_depend_on_partitions(spark):
    d = spark.range(200)
    a = {r.id: r.u for r in d.select("id", T.draw("s", "id").alias("u")).collect()}
    b = {r.id: r.u for r in d.repartition(7).select("id", T.draw("s", "id").alias("u")).collect()}
    assert a == b and 0 <= min(a.values()) and max(a.values()) < 1
