"""The catalog of datasets: discovery from files, configuration, per-dataset settings."""

from __future__ import annotations

import os
from collections.abc import Iterable
from itertools import permutations
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = "ds STRING, src_lang STRING, tgt_lang STRING, src STRING, tgt STRING"


def merge(base: dict[str, Any], other: dict[str, Any]) -> dict[str, Any]:
    """Deep merge; values of other win."""
    out = dict(base)
    for k, v in other.items():
        out[k] = merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load_config(paths: Iterable[str], check_files: bool = True) -> dict[str, Any]:
    """YAML files merged in order: data (name -> src_lang, tgt_lang, src, tgt, weight) and args."""
    import yaml

    config: dict[str, Any] = {}
    for p in paths:
        with open(p, encoding="utf-8") as f:
            config = merge(config, yaml.safe_load(f) or {})
    data = {}
    for name, d in (config.get("data") or {}).items():
        row = {k: d.get(k) or "" for k in ("src_lang", "tgt_lang", "src", "tgt")} | {"weight": float(d.get("weight", 1.0))}
        for k in ("src", "tgt"):
            if check_files and row[k] and not os.path.exists(row[k]):
                raise FileNotFoundError(f"{name}: {row[k]}")
        data[name] = row
    return {"data": data, "args": config.get("args") or {}}


def save_config(config: dict[str, Any], path: str) -> None:
    import yaml

    with open(path, "w", encoding="utf-8") as f:
        yaml.safe_dump(config, f, allow_unicode=True)


def to_frame(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    rows = [(n, d["src_lang"], d["tgt_lang"], d["src"], d["tgt"], d.get("weight", 1.0)) for n, d in config["data"].items()]
    return spark.createDataFrame(rows, FIELDS + ", weight DOUBLE")


def list_files(folder: str) -> list[str]:
    return sorted(os.path.join(d, f) for d, _, files in os.walk(folder) for f in files)


def discover(files: DataFrame, langs: list[str], root: str = "", suffix: str = "", prefix: str = "", exclude: list[str] | None = None, require: list[str] | None = None, ordered: str | None = None, unique: bool = False, mono: bool = False, skip: list[str] | None = None) -> DataFrame:
    """Catalog rows (ds, src_lang, tgt_lang, src, tgt) from a table of paths (column path).

    base.xx[suffix] and base.yy[suffix] make a pair for each ordered pair of langs that isn't in skip ('xx2yy') and, with
    ordered 'forward' or 'backward', goes that way through langs. exclude drops pairs with any of its parts in either path,
    require keeps only those with one. ds is xx2yy_ and the path below root with - for /. unique keeps the first pair of
    each two file names. mono adds one row for each file name that is in a wanted language, once.
    """
    if ordered not in (None, "forward", "backward"):
        raise ValueError("ordered must be 'forward' or 'backward'")
    spark = files.sparkSession
    p = F.col("path")
    name = F.element_at(F.split(p, "/"), -1)
    wanted = files.select("path").distinct().filter(p.startswith(root) & name.startswith(prefix) & p.endswith(suffix))
    stem = F.substring(p, F.lit(1), F.char_length(p) - len(suffix)) if suffix else p
    wanted = wanted.withColumn("lang", F.regexp_extract(stem, r"\.([^./]+)$", 1)).withColumn("base", F.regexp_replace(stem, r"\.[^./]+$", "")).withColumn("name", name)

    def allowed(*paths) -> Any:
        ok = F.lit(True)
        for x in exclude or []:
            for q in paths:
                ok = ok & ~q.contains(x)
        if require:
            any_of = F.lit(False)
            for x in require:
                for q in paths:
                    any_of = any_of | q.contains(x)
            ok = ok & any_of
        return ok

    pairs = [(a, b) for a, b in permutations(langs, 2) if f"{a}2{b}" not in (skip or []) and not (ordered == "forward" and langs.index(a) > langs.index(b)) and not (ordered == "backward" and langs.index(a) < langs.index(b))]
    order = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(pairs)], "src_lang STRING, tgt_lang STRING, rank INT")
    a = wanted.select("base", F.col("lang").alias("src_lang"), F.col("path").alias("src"), F.col("name").alias("src_name"))
    b = wanted.select("base", F.col("lang").alias("tgt_lang"), F.col("path").alias("tgt"), F.col("name").alias("tgt_name"))
    d = a.join(b, "base").join(F.broadcast(order), ["src_lang", "tgt_lang"]).filter(allowed(F.col("src"), F.col("tgt")))
    below = F.regexp_replace(F.regexp_replace(F.substring("base", len(root) + 1, 1_000_000), "^/+", ""), "/", "-")
    d = d.withColumn("ds", F.concat("src_lang", F.lit("2"), "tgt_lang", F.lit("_"), below))
    if unique:
        d = d.groupBy("src_lang", "tgt_lang", "src_name", "tgt_name").agg(F.min_by(F.struct("ds", "src", "tgt"), F.struct("rank", "base")).alias("m")).select("m.ds", "src_lang", "tgt_lang", "m.src", "m.tgt")
    out = d.select("ds", "src_lang", "tgt_lang", "src", "tgt")
    if mono:
        m = wanted.filter(F.col("lang").isin(langs) & allowed(p)).groupBy("name").agg(F.min(F.struct("path", "lang", "base")).alias("m")).select("m.*")
        m = m.withColumn("ds", F.concat("lang", F.lit("_mono_"), below))
        out = out.unionByName(m.select("ds", F.col("lang").alias("src_lang"), F.lit("").alias("tgt_lang"), F.col("path").alias("src"), F.lit("").alias("tgt")))
    return out
