import argparse
import json
import logging
import os

import pytest

from linepress import cli


def catalog(tmp_path):
    for lang, text in (("en", "This is the good sentence {}\n"), ("de", "Das ist der gute Satz {}\n")):
        (tmp_path / f"a.{lang}").write_text("".join(text.format(i) for i in range(20)))
    (tmp_path / "m.en").write_text("only one\n")
    (tmp_path / "c.yml").write_text(f"data:\n  a: {{src_lang: en, tgt_lang: de, src: {tmp_path}/a.en, tgt: {tmp_path}/a.de}}\n  m: {{src_lang: en, tgt_lang: '', src: {tmp_path}/m.en, tgt: ''}}\n")
    return str(tmp_path / "c.yml")


@pytest.mark.parametrize("command", ["charfix", "bifix", "biclean", "tagprotect", "queries", "dedup", "shard"])
def test_commands(spark, tmp_path, command):
    out = str(tmp_path / "out")
    cli.main([command, "--config", catalog(tmp_path), "--out", out], spark)
    got = spark.read.parquet(f"{out}/{command}.run")
    assert got.filter("ds = 'a'").select("line_no").distinct().count() == 20
    cli.main([command, "--config", catalog(tmp_path), "--out", out], spark)  # what is there stays


def test_sizes_and_resample(spark, tmp_path):
    out = str(tmp_path / "out")
    cli.main(["sizes", "--config", catalog(tmp_path), "--out", out], spark)
    assert "20.000000" in "".join(r[0] for r in spark.read.text(f"{out}/sizes.run").collect())
    cli.main(["resample", "--config", catalog(tmp_path), "--out", out, "--n", "50", "--method", "uniform"], spark)
    assert spark.read.parquet(f"{out}/resample.run").count() == 50
    cli.main(["resample", "--config", catalog(tmp_path), "--out", out, "--name", "dry", "--dry-run"], spark)
    assert spark.read.parquet(f"{out}/resample.dry").count() == 2


def test_resample_mono_and_multimeta(spark, tmp_path):
    out = str(tmp_path / "out")
    cli.main(["resample_mono", "--config", catalog(tmp_path), "--out", out, "--n", "40", "--method", "uniform"], spark)
    assert spark.read.parquet(f"{out}/resample_mono.run").count() == 40
    cli.main(["multimeta", "--config", catalog(tmp_path), "--out", out], spark)
    got = {(r.kind, r.key): r.value for r in spark.read.json(f"{out}/multimeta.run/a.meta").collect()}
    assert got["files", "en"] == f"{tmp_path}/a.en" and got["idx_to_lang", "3"] == '["de","en"]'
    text = (tmp_path / "a.de").read_bytes()
    starts = json.loads(got["offsets", f"{tmp_path}/a.de:0"])
    assert [text[i:].split(b"\n")[0].decode() for i in starts] == text.decode().splitlines() and json.loads(got["lang_to_idx", "en:0"]) == list(range(20))


def texts(spark, path):
    return [r[0] for r in spark.read.text(path).collect()]


def test_extraction_from_files(spark, tmp_path):
    out = str(tmp_path / "out")
    (tmp_path / "x.tsv").write_text("a\tb\tc\nshort\nd\te\tf\n")
    cli.main(["extract_tsv", "--source", str(tmp_path / "x.tsv"), "--target-col", "2", "--source-lang", "en", "--target-lang", "de", "--out", out], spark)
    assert texts(spark, f"{out}/extract_tsv.run.en") == ["a", "d"] and texts(spark, f"{out}/extract_tsv.run.de") == ["c", "f"]
    (tmp_path / "s.sgm").write_text('<doc>\n<seg id="1">one</seg>\n<seg id="2">two</seg>\n</doc>\n')
    (tmp_path / "t.sgm").write_text('<seg id="1">eins</seg>\n')
    cli.main(["extract_sgms", "--source", str(tmp_path / "s.sgm"), "--target", str(tmp_path / "t.sgm"), "--out", out], spark)
    assert texts(spark, f"{out}/extract_sgms.run.src") == ["one", "two"] and texts(spark, f"{out}/extract_sgms.run.tgt") == ["eins", ""]
    (tmp_path / "x.tmx").write_text('<tmx><body><tu><tuv xml:lang="en"><seg>yes</seg></tuv><tuv xml:lang="de"><seg>ja</seg></tuv></tu></body></tmx>')
    cli.main(["extract_tmx", "--source", str(tmp_path / "x.tmx"), "--source-lang", "en", "--target-lang", "de", "--out", out], spark)
    assert texts(spark, f"{out}/extract_tmx.run.en") == ["yes"] and texts(spark, f"{out}/extract_tmx.run.de") == ["ja"]
    for name, text in (("te", "one\n"), ("td", "eins\n"), ("tre", "one\ntwo\n"), ("trd", "eins\nzwei\n")):
        (tmp_path / name).write_text(text)
    p = lambda n: str(tmp_path / n)
    cli.main(["decontaminate", "--source", p("tre"), "--target", p("trd"), "--test-source", p("te"), "--test-target", p("td"), "--out", out], spark)
    assert texts(spark, f"{out}/decontaminate.run.src") == ["two"]


def test_discover_and_translate(spark, tmp_path):
    out = str(tmp_path / "out")
    (tmp_path / "c").mkdir()
    for x in ("set.en", "set.de", "other.en"):
        (tmp_path / "c" / x).write_text("x\n")
    cli.main(["discover", "--source", str(tmp_path / "c"), "--langs", "en", "de", "--ordered", "forward", "--mono", "--out", out], spark)
    import yaml

    data = yaml.safe_load(open(f"{out}/discover.run.yml"))["data"]
    assert {k: (v["src_lang"], v["tgt_lang"]) for k, v in data.items()}["en2de_set"] == ("en", "de") and any("mono" in k for k in data)
    (tmp_path / "d.xml").write_text('<docs><doc id="1">\na\nb</doc><doc id="2">\nc</doc></docs>')
    cli.main(["translate_docs", "--source", str(tmp_path / "d.xml"), "--shell", "tr a-z A-Z", "--out", out], spark)
    from linepress.sources import readers

    got = {r._id: r.text.split() for r in readers.read_doc_xml(spark, f"{out}/translate_docs.run").collect()}
    assert got == {"1": ["A", "B"], "2": ["C"]}


def test_missing_arguments(tmp_path):
    for argv in (["sizes", "--out", str(tmp_path)], ["extract_tsv", "--out", str(tmp_path)]):
        with pytest.raises(SystemExit):
            cli.main(argv)


def test_bifix_spells(spark, tmp_path):
    (tmp_path / "words").mkdir()
    (tmp_path / "words" / "replacements.de").write_text("gute\tbeste\n")
    config, more = catalog(tmp_path), ["--orthography", str(tmp_path / "words")]
    for name, options, word in (("on", more, "beste"), ("off", [*more, "--ignore-orthography"], "gute")):
        cli.main(["bifix", "--config", config, "--out", str(tmp_path / "out"), "--name", name, *options], spark)
        got = {r[0] for r in spark.read.parquet(f"{tmp_path}/out/bifix.{name}").select("target_segment").collect()}
        assert got == {f"Das ist der {word} Satz {i}" for i in range(20)}


def test_validators(tmp_path):
    assert cli.positive("3") == 3 and cli.positive_or_zero("0") == 0 and cli.share("0.5") == 0.5 and cli.folder(str(tmp_path))
    for f, bad in ((cli.positive, "0"), (cli.positive_or_zero, "-1"), (cli.share, "1.5"), (cli.folder, "/nowhere")):
        with pytest.raises(argparse.ArgumentTypeError):
            f(bad)


def test_logger(tmp_path):
    log = cli.setup_logger("lp", str(tmp_path), logging.INFO, to_stdout=False)
    log.info("hello")
    assert cli.setup_logger("lp", str(tmp_path)) is log and "hello" in open(os.path.join(tmp_path, "lp.log")).read()
