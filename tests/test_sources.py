import os

import pytest
from pyspark.sql import functions as F

from linepress.operators import catalog
from linepress.plans.pipeline import Commands, run
from linepress.sources import readers, remote, tagfiles, writers
from linepress.streaming import lines as streams


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_lines_keep_order_and_returns(spark, tmp_path):
    f = tmp_path / "x.txt"
    f.write_bytes(b"a\rb\r\nc\n\xff\n\nend")
    got = rows(readers.read_lines(spark, str(f)), "line_no", "text")
    assert got == [(1, "a\rb\r"), (2, "c"), (3, "�"), (4, ""), (5, "end")]


def test_lines_of_a_split_file(spark, tmp_path):
    f = tmp_path / "big.txt"
    f.write_text("".join(f"line {i}\n" for i in range(1, 30001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        d = readers.read_lines(spark, str(f))
        assert d.rdd.getNumPartitions() > 1
        assert d.filter("text <> concat('line ', line_no)").count() == 0 and d.count() == 30000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parallel_pads(spark, tmp_path):
    (tmp_path / "a").write_text("1\n2\n3\n")
    (tmp_path / "b").write_text("x\n")
    assert rows(readers.read_parallel(spark, str(tmp_path / "a"), str(tmp_path / "b")), "line_no", "source_segment", "target_segment") == [(1, "1", "x"), (2, "2", ""), (3, "3", "")]


TMX = """<?xml version="1.0"?><tmx><body>
<tu><tuv xml:lang="en"><seg>Old</seg></tuv><tuv xml:lang="en"><seg>New &amp; line</seg></tuv><tuv xml:lang="de"><seg>Neu <b>fett</b></seg></tuv></tu>
<tu><tuv xml:lang="en"><seg>Only</seg></tuv></tu>
<tu><tuv xml:lang="en"><seg>x</seg></tuv><tuv xml:lang="de"><seg></seg></tuv></tu>
</body></tmx>"""


def test_tmx(spark, tmp_path):
    d = tmp_path / "t" / "en-de"
    d.mkdir(parents=True)
    (d / "x.tmx").write_text(TMX)
    assert rows(readers.extract_tmx(spark, str(d / "x.tmx"), "en", "de"), "source_segment", "target_segment") == [("New & line", "Neu ")]
    assert rows(readers.extract_tmx_tree(spark, str(tmp_path / "t"), ["en", "de", "fr"]), "src_lang", "tgt_lang") == [("en", "de")]


def test_sgm_and_tsv(spark):
    d = spark.createDataFrame([(' <seg id="1">a b</seg> ',), ("<seg>no</seg>",), ("x\ty\tz",), ("short",)], "text STRING")
    assert rows(readers.extract_sgm(d), "text") == [("a b",)]
    assert rows(readers.extract_tsv(d, 0, 2), "source_segment", "target_segment") == [("x", "z")]


def test_tag_files(spark, tmp_path):
    lines = ["see <b>this</b> now", "", "plain", "at http://a.org/x today", "two <i>x</i> <i>x</i>"]
    (tmp_path / "in").write_text("".join(f"{x}\n" for x in lines))
    p = lambda n: str(tmp_path / n)
    tagfiles.extract_tags_file(spark, p("in"), p("text"), p("tags"))
    bare = {r.line_no: r.text for r in spark.read.schema("line_no LONG, text STRING").json(p("text")).collect()}
    assert "<" not in "".join(bare.values()) and "http" not in "".join(bare.values()) and set(bare) == {1, 2, 3, 4, 5}
    tagfiles.reinsert_tags_file(spark, p("text"), p("tags"), p("out"))
    squeezed = lambda x: x.replace(" ", "")
    assert [squeezed(r[0]) for r in spark.read.text(p("out")).collect()] == [squeezed(x) for x in lines]


def test_doc_xml_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("1", "a\nb"), ("2", "c")], "_id STRING, text STRING")
    writers.write_doc_xml(d, str(tmp_path / "x"))
    got = readers.read_doc_xml(spark, str(tmp_path / "x"))
    assert {(r._id, r.text.strip()) for r in got.collect()} == {("1", "a\nb"), ("2", "c")}


def test_lexicons(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("teh\tthe\tnote\nteh\tThe\nshort\n")
    assert rows(readers.read_replacements(spark, str(tmp_path / "r.tsv")), "wrong", "correct") == [("teh", "The")]
    (tmp_path / "rep").mkdir()
    (tmp_path / "rep" / "replacements.da").write_text("a\tb\na\t c \n")
    assert rows(readers.read_replacements(spark, str(tmp_path / "rep")), "lang", "wrong", "correct") == [("da", "a", "c")]
    s = tmp_path / "stop" / "deep"
    s.mkdir(parents=True)
    (s / "en.txt").write_text("the\n# no\n\nand\nthe\n")
    assert [(r.lang, r.words) for r in readers.read_stopwords(spark, str(tmp_path / "stop")).collect()] == [("en", ["and", "the"])]


def test_writers(spark, tmp_path):
    d = spark.createDataFrame([("d", 2, "b", "B", 1), ("d", 1, "a", "A", 2)], "ds STRING, line_no INT, source_segment STRING, target_segment STRING, shard INT")
    writers.write_parallel(d, str(tmp_path / "s"), str(tmp_path / "t"), ["line_no"])
    assert [r[0] for r in spark.read.text(str(tmp_path / "s")).collect()] == ["a", "b"]
    writers.write_shards(d, str(tmp_path / "shards"))
    assert sorted(x for x in os.listdir(tmp_path / "shards") if x.startswith("shard")) == ["shard=001", "shard=002"]
    writers.write_json_lines(d.select("line_no", "ds"), str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0].startswith('{"ds":')
    writers.write_matrix(spark.createDataFrame([("en", 3)], "src_lang STRING, de LONG"), str(tmp_path / "m"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "m")).collect()] == ["src_lang,de", "en,3.000000"]
    writers.write_once(d, str(tmp_path / "s"))


def test_remote_is_offline_safe(spark, tmp_path):
    index = b'{"corpora": [{"corpus": "A", "url": "u1"}, {"corpus": "A", "url": "u2"}, {"corpus": "B", "url": "u3"}]}'
    assert rows(remote.query_corpora(spark, "x", "en", "de", lambda u: index), "corpus", "url") == [("A", "u1"), ("B", "u3")]

    def broken(url):
        raise OSError

    assert remote.query_corpora(spark, "x", "en", "de", broken).count() == 0
    p = remote.download("u", str(tmp_path / "m" / "x"), "2cf24dba", lambda u: b"hello")
    assert open(p, "rb").read() == b"hello"
    with pytest.raises(ValueError):
        remote.download("u", str(tmp_path / "y"), "00", lambda u: b"hello")


def test_config(spark, tmp_path):
    (tmp_path / "a.yml").write_text("data: {x: {src_lang: en, tgt_lang: de, src: '', tgt: ''}}\nargs: {k: 1}\n")
    (tmp_path / "b.yml").write_text("data: {x: {weight: 2}}\n")
    c = catalog.load_config([str(tmp_path / "a.yml"), str(tmp_path / "b.yml")])
    assert c["data"]["x"]["weight"] == 2.0 and c["args"] == {"k": 1}
    catalog.save_config(c, str(tmp_path / "c.yml"))
    assert rows(catalog.to_frame(spark, c), "ds", "weight") == [("x", 2.0)]


def test_pipeline(spark):
    s, g = "This is the good sentence here\r", "Das ist der gute Satz hier"
    d = spark.createDataFrame([("d", 1, s, g, "en", "de"), ("d", 2, s, g, "en", "de"), ("d", 3, "x", "y", "en", "de")], "ds STRING, line_no INT, source_segment STRING, target_segment STRING, src_lang STRING, tgt_lang STRING")
    c = Commands({"en": ["this", "is", "the"], "de": ["das", "ist", "der"]})
    out = run(d, ["charfix", c.bifix("en", "de"), "biclean", "dedup", "langcheck", "tagprotect", "queries"], c)
    assert [(r.line_no, r.source_segment) for r in out.collect()] == [(1, s.strip())]
    with pytest.raises(ValueError):
        run(d.limit(0), ["charfix"], no_empty=True)
    with pytest.raises(ValueError):
        run(d, ["nothing"])


def test_streams(spark, tmp_path):
    d = spark.createDataFrame([("This is the good sentence", "Das ist der gute Satz"), ("This is the good sentence", "Das ist der gute Satz"), ("x", "y")], "source_segment STRING, target_segment STRING").withColumn("at", F.timestamp_seconds(F.lit(1000)))
    d.write.parquet(str(tmp_path / "in"))
    got = []
    q = streams.into(streams.distinct_stream(streams.clean_stream(spark.readStream.schema(d.schema).parquet(str(tmp_path / "in")), "en", "de"), "at"), lambda b, n: got.extend(b.collect()), str(tmp_path / "cp"))
    assert q.awaitTermination(120)
    assert len(got) == 1
