"""Command line: the cleaning commands, sizes, shards, resampling and metadata over a YAML catalog; extraction, decontamination,
discovery of a catalog and translation of documents over files.

python -m linepress.cli COMMAND --config a.yml [b.yml ...] --out FOLDER [--name NAME] [options]
python -m linepress.cli extract_tmx|extract_tsv|extract_sgms|decontaminate|discover|translate_docs --source PATH ... --out FOLDER [options]
"""

from __future__ import annotations

import argparse
import logging
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepress.operators import align, catalog, external, langid, sampling, shards, stats
from linepress.plans.pipeline import Commands, run
from linepress.session import build_session, collect_small, materialise, ship_package
from linepress.sources import readers, writers

CLEANING = ("charfix", "bifix", "biclean", "dedup", "langcheck", "tagprotect", "queries")
OTHERS = ("sizes", "shard", "resample", "resample_mono", "multimeta")
#: Commands that read files named on the command line instead of a catalog.
FILES = ("extract_tmx", "extract_tsv", "extract_sgms", "decontaminate", "discover", "translate_docs")


def positive(text: str) -> int:
    n = int(text)
    if n <= 0:
        raise argparse.ArgumentTypeError(f"{text} isn't positive")
    return n


def positive_or_zero(text: str) -> int:
    n = int(text)
    if n < 0:
        raise argparse.ArgumentTypeError(f"{text} is negative")
    return n


def share(text: str) -> float:
    x = float(text)
    if not 0 <= x <= 1:
        raise argparse.ArgumentTypeError(f"{text} isn't between 0 and 1")
    return x


def folder(text: str) -> str:
    if not os.path.isdir(text):
        raise argparse.ArgumentTypeError(f"{text} isn't a folder")
    return text


def setup_logger(name: str, path: str | None = None, level: int = logging.INFO, to_stdout: bool = True) -> logging.Logger:
    """A logger that writes to path/name.log and, if asked, to standard output; handlers are added once."""
    log = logging.getLogger(name)
    log.setLevel(level)
    if not log.handlers:
        form = logging.Formatter("%(asctime)s %(name)s %(levelname)s %(message)s")
        handlers: list[logging.Handler] = [logging.StreamHandler(sys.stdout)] if to_stdout else []
        if path:
            os.makedirs(path, exist_ok=True)
            handlers.append(logging.FileHandler(os.path.join(path, f"{name}.log"), encoding="utf-8"))
        for h in handlers:
            h.setFormatter(form)
            log.addHandler(h)
    return log


def load_pairs(spark: SparkSession, config: dict) -> DataFrame:
    """All datasets of a catalog as one table; a monolingual dataset has '' as its target."""
    out = None
    for name, d in config["data"].items():
        if d["tgt"]:
            p = readers.read_parallel(spark, d["src"], d["tgt"])
        else:
            p = readers.read_lines(spark, d["src"]).select("line_no", F.col("text").alias("source_segment"), F.lit("").alias("target_segment"))
        p = p.select(F.lit(name).alias("ds"), "line_no", "source_segment", "target_segment", F.lit(d["src_lang"]).alias("src_lang"), F.lit(d["tgt_lang"]).alias("tgt_lang"))
        out = p if out is None else out.unionByName(p)
    if out is None:
        raise ValueError("the catalog has no datasets")
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.ArgumentDefaultsHelpFormatter)
    p.add_argument("command", choices=CLEANING + OTHERS + FILES)
    p.add_argument("--config", nargs="+")
    p.add_argument("--out", required=True)
    p.add_argument("--name", default="run")
    p.add_argument("--stopwords", type=folder, help="folder of xx.txt files")
    p.add_argument("--orthography", type=folder, help="folder of files replacements.xx, by which bifix puts misspelt words right")
    p.add_argument("--ignore-orthography", action="store_true", help="bifix without --orthography's corrections")
    p.add_argument("--no-empty", action="store_true")
    p.add_argument("--max-id", type=positive_or_zero, default=5)
    p.add_argument("--dropout", type=share, default=0.1)
    p.add_argument("--n", type=positive, default=100_000)
    p.add_argument("--method", choices=sampling.METHODS, default="temperature")
    p.add_argument("--temperature", type=float, default=5.0)
    p.add_argument("--tag", action="store_true")
    p.add_argument("--dry-run", action="store_true", help="write the probabilities only")
    p.add_argument("--min-shards", type=positive, default=1)
    p.add_argument("--max-shards", type=positive, default=10)
    p.add_argument("--no-replicate", action="store_true")
    p.add_argument("--dataset-method", choices=("original", "uniform", "temperature"), default="original", help="of resample_mono: how a language's dataset is drawn")
    p.add_argument("--source", help="file of the source side, or the one file (or, for discover, folder) that is read")
    p.add_argument("--target", help="file of the target side")
    p.add_argument("--source-lang", default="")
    p.add_argument("--target-lang", default="")
    p.add_argument("--source-col", type=positive_or_zero, default=0)
    p.add_argument("--target-col", type=positive_or_zero, default=1)
    p.add_argument("--test-source", nargs="+", default=[])
    p.add_argument("--test-target", nargs="+", default=[])
    p.add_argument("--langs", nargs="+", default=[], help="of discover: the wanted languages")
    p.add_argument("--prefix", default="")
    p.add_argument("--suffix", default="")
    p.add_argument("--exclude", nargs="+")
    p.add_argument("--require", nargs="+")
    p.add_argument("--ordered", choices=("forward", "backward"))
    p.add_argument("--skip", nargs="+")
    p.add_argument("--unique", action="store_true")
    p.add_argument("--mono", action="store_true")
    p.add_argument("--shell", help="of translate_docs: the command that translates lines")
    return p


def on_files(a: argparse.Namespace, spark: SparkSession, target: str) -> None:
    """The commands in FILES: pairs, a catalog or documents from files, written to target."""
    if a.command == "discover":
        files = spark.createDataFrame([(f,) for f in catalog.list_files(a.source)], "path STRING")
        found = catalog.discover(files, a.langs, a.source, a.suffix, a.prefix, a.exclude, a.require, a.ordered, a.unique, a.mono, a.skip)
        data = {r.ds: {k: r[k] for k in ("src_lang", "tgt_lang", "src", "tgt")} for r in collect_small(found.orderBy("ds"))}
        catalog.save_config({"data": data, "args": {}}, f"{target}.yml")
    elif a.command == "translate_docs":
        docs = readers.read_doc_xml(spark, a.source).withColumn("doc_id", F.monotonically_increasing_id())
        docs = materialise(docs, "docs")  # ids are drawn once
        done = external.pipe_documents(docs.select("doc_id", "text"), a.shell)
        writers.write_doc_xml(docs.drop("text").join(done, "doc_id").orderBy("doc_id").drop("doc_id"), target, "ignore")
    elif a.command == "decontaminate":
        tests = [readers.read_parallel(spark, s, t) for s, t in zip(a.test_source, a.test_target, strict=True)]
        clean = align.decontaminate(readers.read_parallel(spark, a.source, a.target), writers.merged(tests))
        writers.write_parallel(clean, f"{target}.{a.source_lang or 'src'}", f"{target}.{a.target_lang or 'tgt'}", ["line_no"], "ignore")
    else:
        if a.command == "extract_tmx":
            pairs = readers.extract_tmx(spark, a.source, a.source_lang, a.target_lang).withColumn("line_no", F.monotonically_increasing_id())
        elif a.command == "extract_tsv":
            pairs = readers.extract_tsv(readers.read_lines(spark, a.source), a.source_col, a.target_col)
        else:
            pairs = readers.extract_sgms(readers.read_lines(spark, a.source), readers.read_lines(spark, a.target))
        pairs = materialise(pairs.select("line_no", "source_segment", "target_segment"), "extracted")
        writers.write_parallel(pairs, f"{target}.{a.source_lang or 'src'}", f"{target}.{a.target_lang or 'tgt'}", ["line_no"], "ignore")


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    p = parser()
    a = p.parse_args(argv)
    os.makedirs(a.out, exist_ok=True)
    if a.command in FILES:
        if not a.source:
            p.error(f"{a.command} needs --source")
        spark = spark or build_session("linepress")
        ship_package(spark)
        return on_files(a, spark, os.path.join(a.out, f"{a.command}.{a.name}"))
    if not a.config:
        p.error(f"{a.command} needs --config")
    config = catalog.load_config(a.config)
    catalog.save_config(config, os.path.join(a.out, f"config.{a.command}.{a.name}.yml"))
    spark = spark or build_session("linepress")
    ship_package(spark)
    target = os.path.join(a.out, f"{a.command}.{a.name}")
    pairs = load_pairs(spark, config)
    words: dict[str, list[str]] = {}
    if a.stopwords:
        words = langid.stopword_lists(readers.read_stopwords(spark, a.stopwords).select("lang", F.explode("words").alias("word")))
    c = Commands(words, config["args"].get("aliases") or {}, a.max_id, a.dropout, orthography=readers.read_replacements(spark, a.orthography) if a.orthography else None)
    datasets = catalog.to_frame(spark, config)
    if a.command == "bifix":
        done = None
        for s, t in {(d["src_lang"], d["tgt_lang"]) for d in config["data"].values()}:
            part = run(pairs.filter((F.col("src_lang") == s) & (F.col("tgt_lang") == t)), [c.bifix(s, t, ignore_orthography=a.ignore_orthography)], c, a.no_empty)
            done = part if done is None else done.unionByName(part)
        writers.write_once(done, target)
    elif a.command in CLEANING:
        writers.write_once(run(pairs, [a.command], c, a.no_empty), target)
    elif a.command == "resample_mono":
        lines = pairs.select("ds", "line_no", F.col("source_segment").alias("text"))
        out = sampling.resample_mono(lines, datasets.select("ds", F.col("src_lang").alias("lang")), a.n, a.method, a.temperature, a.dataset_method)
        writers.write_by(out, target, "lang", "ignore")
    elif a.command == "multimeta":
        for name, d in config["data"].items():
            one = pairs.filter(F.col("ds") == name)
            side = lambda column, lang, one=one: one.select(F.lit(lang).alias("lang"), "line_no", F.col(column).alias("text"))
            lines = side("source_segment", d["src_lang"])
            files = {d["src_lang"]: d["src"]}
            if d["tgt"]:
                lines, files = lines.unionByName(side("target_segment", d["tgt_lang"])), files | {d["tgt_lang"]: d["tgt"]}
            writers.write_json_lines(stats.multiway_meta(lines, files), os.path.join(target, f"{name}.meta"), "ignore")
    elif a.command == "sizes":
        sizes = datasets.join(stats.line_counts(pairs).withColumnRenamed("n", "size"), "ds", "left").na.fill(0, ["size"])
        writers.write_matrix(stats.size_table(sizes), target, "ignore")
    elif a.command == "shard":
        s = shards.assign_shards(pairs, a.min_shards, a.max_shards)
        writers.write_shards(s if a.no_replicate else shards.replicate(s, a.max_shards), target, "ignore")
    elif a.dry_run:
        sizes = datasets.join(stats.line_counts(pairs).withColumnRenamed("n", "size"), "ds", "left").na.fill(0, ["size"])
        writers.write_once(sampling.distribution(sizes, a.method, a.temperature).select("ds", "prob"), target)
    else:
        out = sampling.resample_parallel(pairs, datasets, a.n, a.method, a.temperature, a.tag)
        writers.write_by(out, target, "ds", "ignore")


if __name__ == "__main__":
    main()
