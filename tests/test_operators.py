import numpy as np
import pytest
from pyspark.sql import functions as F

from linepress.operators import align, catalog, dedupe, external, langid, repair, sampling, shards, spans, stats, tags


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# -- repair ------------------------------------------------------------------------------------------------------------
def test_fix_stages(spark):
    d = spark.createDataFrame([(1, "  two  spaces & # 233 ; it''s ( so ) ! "), (2, "cafÃ© ﬁne ａｂ “x”"), (3, ""), (4, None)], "i INT, x STRING")
    got = [r[0] for r in d.orderBy("i").select(repair.fix_text("x", "en")).collect()]
    assert got == ["two spaces é it's (so)!", "café fine ab “x”", "", None]


CHARACTERS = [
    ("en", "Кот в доме", "KoT B дoMe"), ("ru", "Кот в доме", "Кот в доме"), ("en", "ёжик Їжак", "ëжиk Ïжak"), ("mk", "Ѕ ѐ", "Ѕ ѐ"), ("en", "Αθήνα", "Aθήva"), ("el", "Αθήνα", "Αθήνα"),
    ("en", "ť ƒ", "t' f"), ("cs", "ť ƒ", "ť ƒ"), ("en", "א׳ ב״ ־ ׀ ׃", "א' ב\" - | :"), ("de", "א׳ ־", "א׳ ־"), ("en", "【a】。、", "(a).,"), ("en", "ａ（１）！", "a(1)!"), ("ja", "a(1)!", "a（1）！"), ("ja", "ａ", "a"),
    ("en", "Ã<89>t Ä<83>", "Ét ă"), ("en", "ﬁ ﬆ ˂ˁ", "fi st <¿"), ("de", "„x“ – ‘y’", "„x“ – ‘y’"), ("en", "“x” — …", "“x” — …"), ("en", "e\u0301t a\x07b", "ét ab"),
]


def test_characters_by_language(spark):
    d = spark.createDataFrame([(i, lang, x) for i, (lang, x, _) in enumerate(CHARACTERS)], "i INT, lang STRING, x STRING")
    got = [r[0] for r in d.orderBy("i").select(repair.restore_text("x", F.col("lang"))).collect()]
    assert got == [want for _, _, want in CHARACTERS]
    assert repair.char_map("EN") == repair.char_map("en") and set(repair.FROM_GREEK) <= set(repair.char_map("fr"))


def test_letters_in_latin(spark):
    from linepress.functions import text

    d = spark.createDataFrame([(1, "Straße Ærø Łódź"), (2, "Щука и ёж"), (3, "Ψυχή"), (4, "plain"), (5, "ﬁｘ e\u0301"), (6, None), (7, "")], "i INT, x STRING")
    got = [r[0] for r in d.orderBy("i").select(text.ascii_letters("x")).collect()]
    assert got == ["Strasse Aero Lodz", "Shchuka i iozh", "Psukhe", "plain", "fix e", None, ""]


def test_french_keeps_high_punctuation(spark):
    d = spark.createDataFrame([("oui ! ( non )",)], "x STRING")
    assert d.select(repair.close_up_punctuation(F.col("x"), "fr")).first()[0] == "oui ! (non)"


def test_spelling_is_one_pass_and_case_sensitive(spark):
    m = F.create_map(F.lit("teh"), F.lit("the"), F.lit("the"), F.lit("THE"))
    d = spark.createDataFrame([("teh Teh the, it's teh-x",)], "x STRING")
    assert d.select(repair.fix_spelling("x", m)).first()[0] == "the Teh THE, it's teh-x"


def test_fix_pairs_gates(spark):
    long = "a" * 5001
    d = spark.createDataFrame([(1, "a  b", "c"), (2, "", "c"), (3, f" {long}  x ", "c")], "i INT, s STRING, g STRING")
    got = {r.i: r for r in repair.fix_pairs(d, "s", "g", "en", "de").collect()}
    assert set(got) == {1, 3} and got[1].s == "a b" and got[3].s == f"{long}  x" and got[1].ranking == 1.0
    same = spark.createDataFrame([(1, "Café 1", "x"), (2, "cafe, 2", "X!")], "i INT, s STRING, g STRING")
    assert len({r.seg_hash for r in repair.fix_pairs(same, "s", "g", "en", "de", aggressive=True).collect()}) == 1


def test_fix_pairs_spells_before_hash_and_ranking(spark):
    words = spark.createDataFrame([("en", "teh", " the "), ("de", "nciht", "nicht")], "lang STRING, wrong STRING, correct STRING")
    long = "teh " * 1300
    d = spark.createDataFrame([(1, "teh  cat", "nciht teh"), (2, "the cat", "nicht teh"), (3, long, "nciht")], "i INT, s STRING, g STRING")
    for aggressive in (False, True):
        got = {r.i: r for r in repair.fix_pairs(d, "s", "g", "en", "de", aggressive=aggressive, orthography=words).collect()}
        assert (got[1].s, got[1].g) == ("the cat", "nicht teh") and got[1][3:] == got[2][3:]
        assert (got[3].s, got[3].g) == (long.strip(), "nciht")
    off = {r.i: r for r in repair.fix_pairs(d, "s", "g", "en", "de", orthography=words, ignore_orthography=True).collect()}
    assert (off[1].s, off[1].g) == ("teh cat", "nciht teh") and off[1].seg_hash != off[2].seg_hash


def test_fix_pairs_by_language_column(spark):
    """Each pair comes out as fix_pairs of its own two languages gives it."""
    words = spark.createDataFrame([("en", "teh", "the"), ("fr", "lse", "les")], "lang STRING, wrong STRING, correct STRING")
    texts = ["teh lse oui ! ( non ) „Haus“", "Москва cafÃ© &amp; ﬁn", "ＡＢＣ it''s \ue000 x ?"]
    langs = ["en", "fr", "ru", "de", "ja", "el", ""]
    d = spark.createDataFrame([(100 * i + 10 * j + k, t, texts[k - 1], a, b) for i, a in enumerate(langs) for j, b in enumerate(langs) for k, t in enumerate(texts)], "i INT, s STRING, g STRING, a STRING, b STRING")
    cols = ("i", "s", "g", "seg_hash", "ranking")
    got = {tuple(r) for r in repair.fix_pairs(d, "s", "g", F.col("a"), F.col("b"), aggressive=True, orthography=words).select(*cols).collect()}
    want = set()
    for a, b in (("en", "fr"), ("fr", "ru"), ("ja", "de"), ("", "el"), ("de", "")):
        part = {tuple(r) for r in repair.fix_pairs(d.filter((F.col("a") == a) & (F.col("b") == b)), "s", "g", a, b, aggressive=True, orthography=words).select(*cols).collect()}
        assert len(part) == len(texts)
        want |= part
    assert want <= got and len(got) == d.count()


# -- tags --------------------------------------------------------------------------------------------------------------
def test_tags_out_and_in(spark):
    d = spark.createDataFrame([("see <b> bold </b> at http://x.org/a now",), ("mail (a.b@c.de) me",), ("plain",), ("",)], "x STRING")
    out = d.select("x", tags.extract_tags("x").alias("t")).select("x", "t.text", "t.repls", tags.reinsert_tags("t.text", "t.repls").alias("back")).collect()
    assert "[TAG0]" in out[0].text and "[URL2]" in out[0].text and "[EML0]" in out[1].text
    assert all(r.back.replace(" ", "") == r.x.replace(" ", "") for r in out)
    lost = d.limit(1).select(tags.reinsert_tags(F.lit("gone"), tags.extract_tags("x")["repls"])).first()[0]
    assert lost.startswith("gone") and "http://x.org/a" in lost


def test_protection_is_drawn_by_key_only(spark):
    d = spark.createDataFrame([(i, f"a <i>{i}</i> b", f"x <i>{i}</i> y") for i in range(50)], "i INT, s STRING, g STRING")
    a = rows(tags.protect_pairs(d, "s", "g", ["i"]), "i", "s", "g")
    assert a == rows(tags.protect_pairs(d.repartition(9), "s", "g", ["i"]), "i", "s", "g")
    assert rows(tags.protect_pairs(d, "s", "g", ["i"], dropout=1.0), "i", "s") == rows(d, "i", "s")
    j = tags.protect_pairs(d, "s", "g", ["i"], dropout=0.0).select(tags.to_json_repls("repls").alias("j")).select("j", tags.from_json_repls("j").alias("r"))
    assert all(len(r.r) == 2 for r in j.collect())


# -- spans -------------------------------------------------------------------------------------------------------------
def test_spans(spark):
    d = spark.createDataFrame([(1, "only"), (2, "a b"), (3, "the cat, sat on the mat."), (4, ""), (5, None)], "i INT, x STRING")
    stop = F.array(F.lit("the"), F.lit("on"))
    got = {r.i: r.q for r in spans.with_query_span(d, "x", stop, ["i"], "q", dropout=0.0).collect()}
    assert got[4] == got[5] == "" and all(w in "the cat sat on the mat a b only" for w in got[3].split())
    assert set(r.q for r in spans.with_query_span(d, "x", stop, ["i"], "q", dropout=1.0).collect()) == {""}
    assert d.limit(1).select(spans.paste_query(F.lit(" s "), F.lit(" q "))).first()[0] == "s ||| q"


# -- joins -------------------------------------------------------------------------------------------------------------
def test_zip_pads_and_decontaminates(spark):
    a = spark.createDataFrame([("d", 1, "x"), ("d", 2, "y")], "ds STRING, line_no INT, text STRING")
    b = spark.createDataFrame([("d", 2, "Y"), ("d", 3, "Z")], "ds STRING, line_no INT, text STRING")
    assert rows(align.zip_lines(a, b), "line_no", "source_segment", "target_segment") == [(1, "x", ""), (2, "y", "Y"), (3, "", "Z")]
    assert rows(align.zip_lines(a, b, pad=False), "line_no", "target_segment") == [(1, ""), (2, "Y")]
    train = spark.createDataFrame([(1, "a", "b"), (2, "a", "b"), (3, "c", None)], "i INT, source_segment STRING, target_segment STRING")
    test = spark.createDataFrame([(" c ", "")], "source_segment STRING, target_segment STRING")
    assert rows(align.decontaminate(train, test), "i") == [(1,), (2,)]


def test_multiway_meta(spark):
    lines = spark.createDataFrame([("a", 1, "x"), ("a", 2, " "), ("b", 1, "éé"), ("b", 2, "z")], "lang STRING, line_no INT, text STRING")
    got = {(r.kind, r.key): r.value for r in stats.multiway_meta(lines, {"a": "f.a", "b": "f.b"}).collect()}
    assert got == {("files", "a"): "f.a", ("files", "b"): "f.b", ("lang_to_idx", "a:0"): "[0]", ("lang_to_idx", "b:0"): "[0,1]", ("idx_to_lang", "0"): '["a","b"]', ("idx_to_lang", "1"): '["b"]', ("offsets", "f.a:0"): "[0,2]", ("offsets", "f.b:0"): "[0,5]"}
    with pytest.raises(ValueError):
        stats.multiway_meta(lines.filter("lang = 'a' OR line_no = 1"), {"a": "f.a", "b": "f.b"})


def test_shuffled_is_a_permutation(spark):
    d = spark.range(200)
    a, b = [r.id for r in sampling.shuffled(d, ["id"]).collect()], [r.id for r in sampling.shuffled(d.repartition(7), ["id"]).collect()]
    assert a == b != list(range(200)) and sorted(a) == list(range(200)) and [r.id for r in sampling.shuffled(d, ["id"], "other").collect()] != a


def test_size_table_refuses_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(stats, "MAX_LANGUAGES", 2)
    d = spark.createDataFrame([("en", x, 1) for x in "abc"], "src_lang STRING, tgt_lang STRING, size LONG")
    with pytest.raises(ValueError):
        stats.size_table(d)
    assert stats.size_table(d.filter("tgt_lang <> 'c'")).count() == 1


def test_first_of_and_near_groups(spark):
    d = spark.createDataFrame([(1, "Café", "x"), (2, "cafe!", "X"), (3, "other", "y"), (4, None, None)], "i INT, source_segment STRING, target_segment STRING")
    g = {r.n: r for r in dedupe.near_groups(d, "i").filter("n = 2").collect()}
    assert g[2].best_id == 1
    assert rows(dedupe.first_of(d.select("i", F.lit("k").alias("k")), ["k"], [F.col("i")]), "i") == [(1,)]


# -- sampling ----------------------------------------------------------------------------------------------------------
DATASETS = [("a", "en", "de", 1.0, 100), ("b", "en", "fr", None, 300), ("c", "de", "en", 2.0, 50), ("d", "fr", "en", 1.0, 0)]


def datasets(spark):
    return spark.createDataFrame(DATASETS, "ds STRING, src_lang STRING, tgt_lang STRING, weight DOUBLE, size LONG")


@pytest.mark.parametrize("method", sampling.METHODS)
def test_distributions_sum_to_one(spark, method):
    p = {r.ds: r.prob for r in sampling.distribution(datasets(spark), method).collect()}
    assert abs(sum(p.values()) - 1) < 1e-9 and p["d"] == 0


def test_original_and_temperature(spark):
    p = {r.ds: r.prob for r in sampling.distribution(datasets(spark), "original").collect()}
    assert p["b"] == pytest.approx(300 / (100 + 300 + 100))
    q = {r.ds: r.prob for r in sampling.distribution(datasets(spark), "temperature", 1.0).collect()}
    de, fr, en = 150, 300, 450
    w = {"a": de, "b": fr, "c": 2 * en}
    assert q["a"] == pytest.approx(w["a"] / sum(w.values()))


def test_sinkhorn_is_doubly_stochastic():
    m = sampling.sinkhorn_matrix(np.array([[1.0, 5.0], [2.0, 3.0]]))
    assert np.allclose(m.sum(0), 1) and np.allclose(m.sum(1), 1)


def test_pick_by_buckets_and_by_broadcast_agree(spark):
    u = spark.range(500).select("id", (F.col("id") / 500).alias("u"), (F.col("id") % 2).alias("k"))
    c = spark.createDataFrame([(0, 0.0, 0.3, "a"), (0, 0.3, 2.0, "b"), (1, 0.0, 0.00001, "c"), (1, 0.00001, 2.0, "d")], "k LONG, lo DOUBLE, hi DOUBLE, ds STRING")
    assert rows(sampling.pick(u, "u", c, "k"), "id", "ds") == rows(sampling.pick(u, "u", c, "k", max_rows=0), "id", "ds")
    one = c.filter("k = 0").drop("k")
    assert rows(sampling.pick(u, "u", one), "id", "ds") == rows(sampling.pick(u, "u", one, max_rows=0), "id", "ds")


def test_cursor_formulas(spark):
    d = spark.range(1, 9).select("id", sampling.cursor(F.col("id"), F.lit(3)).alias("x"), sampling.cursor(F.col("id"), F.lit(3), "parallel").alias("p"), sampling.cursor(F.col("id"), F.lit(3), "mono").alias("m"))
    got = d.orderBy("id").collect()
    assert [r.x for r in got] == [1, 2, 3, 1, 2, 3, 1, 2]
    assert [r.p for r in got] == [1, 1, 2, 1, 2, 1, 2, 1]
    assert [r.m for r in got] == [1, 2, 1, 2, 3, 1, 2, 3]


def test_resampling_gives_exactly_n_and_skips_blanks(spark):
    lines = spark.createDataFrame([("a", i, f"s{i}" if i != 2 else " ", f"t{i}") for i in range(1, 5)] + [("b", 1, "x", "y")], "ds STRING, line_no INT, source_segment STRING, target_segment STRING")
    ds = spark.createDataFrame([("a", "en", "de", 1.0), ("b", "en", "fr", 1.0), ("e", "en", "fr", 1.0)], "ds STRING, src_lang STRING, tgt_lang STRING, weight DOUBLE")
    r = sampling.resample_parallel(lines, ds, 40, "uniform", add_tag=True).collect()
    assert len(r) == 40 and {x.line_no for x in r if x.ds == "a"} == {1, 3, 4} and all(x.source_segment.startswith("<2") for x in r)
    m = sampling.resample_mono(lines.select("ds", "line_no", F.col("source_segment").alias("text")), ds.select("ds", F.col("src_lang").alias("lang")), 30, "uniform")
    assert m.count() == 30


# -- shards ------------------------------------------------------------------------------------------------------------
def test_shards_and_replicas(spark):
    d = spark.createDataFrame([("a", i) for i in range(1, 12)] + [("b", i) for i in range(1, 4)], "ds STRING, line_no INT")
    s = shards.assign_shards(d, 1, 3)
    assert [r.shard for r in s.filter("ds = 'a'").orderBy("line_no").collect()] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 1, 2]
    assert {r.shard for r in s.filter("ds = 'b'").collect()} == {1}
    full = shards.replicate(s, 3).groupBy("ds", "shard").count()
    assert rows(full.filter("ds = 'b'"), "shard", "count") == [(1, 3), (2, 3), (3, 3)]


# -- languages ---------------------------------------------------------------------------------------------------------
WORDS = {"de": ["das", "ist", "und"], "en": ["the", "is", "and"]}


def test_stop_word_scores(spark):
    d = spark.createDataFrame([(1, "The cat is here and the dog"), (2, "das ist the"), (3, ""), (4, None)], "i INT, x STRING")
    got = {r.i: (r.reliable, r.detected) for r in langid.detect(d, "x", WORDS).collect()}
    assert got == {1: (True, "en"), 2: (False, "de"), 3: (False, None), 4: (False, None)}


def test_langcheck_aliases(spark):
    d = spark.createDataFrame([("the cat", "das ist")], "s STRING, g STRING")
    ok = lambda a, b, al=None: langid.check_languages(d, "s", "g", F.lit(a), F.lit(b), WORDS, aliases=al).first().lang_ok
    assert ok("en", "de") and not ok("en", "fr") and ok("en", "nds", {"nds": ["de"]})


def test_model_interface(spark):
    d = spark.createDataFrame([("a",), (None,)], "x STRING")
    got = langid.predict_with(d, "x", lambda: lambda ts: [["__label__en"] if t else [] for t in ts]).collect()
    assert [r.labels for r in got] == [["en"], []]


# -- statistics, catalog, outside programs -----------------------------------------------------------------------------
def test_offsets_match_bytes(spark):
    texts = ["ä", "", "abc", "😀"]
    d = spark.createDataFrame([("d", i + 1, t) for i, t in enumerate(texts)], "ds STRING, line_no INT, text STRING")
    want = [(i + 1, len("".join(t + "\n" for t in texts[:i]).encode())) for i in range(4)]
    assert rows(stats.line_offsets(d, chunk=2), "line_no", "offset") == want


def test_matrix(spark):
    m = stats.size_table(datasets(spark))
    assert {r.src_lang: (r.de, r.en, r.fr) for r in m.collect()} == {"en": (100, 0, 300), "de": (0, 50, 0), "fr": (0, 0, 0)}
    with pytest.raises(ValueError):
        stats.same_lengths(spark.createDataFrame([("en", 1), ("de", 1), ("de", 2)], "lang STRING, line_no INT"))


def test_discovery(spark):
    files = [f"data/{x}" for x in ("a.en-de.en", "a.en-de.de", "sub/b.en", "sub/b.fr", "skip/c.en", "skip/c.de", "d.en")]
    d = catalog.discover(spark.createDataFrame([(f,) for f in files], "path STRING"), ["en", "de", "fr"], root="data/", exclude=["skip"], ordered="forward", mono=True)
    assert rows(d, "ds") == [("de_mono_a.en-de",), ("en2de_a.en-de",), ("en2fr_sub-b",), ("en_mono_a.en-de",), ("en_mono_d",), ("en_mono_sub-b",), ("fr_mono_sub-b",)]
    assert catalog.merge({"a": {"x": 1, "y": 2}}, {"a": {"y": 3}}) == {"a": {"x": 1, "y": 3}}


def test_pipe(spark):
    docs = spark.createDataFrame([(1, "a\nb\r\nc"), (2, ""), (3, None)], "doc_id LONG, text STRING")
    assert rows(external.pipe_documents(docs, "cat"), "doc_id", "text") == [(1, "a\nb\r\nc"), (2, "")]
    assert rows(external.pipe_documents(docs, "tr a-z A-Z"), "doc_id", "text")[0] == (1, "A\nB\r\nC")
    with pytest.raises(Exception, match="ended early"):
        external.pipe_documents(docs, "head -n 0").collect()
