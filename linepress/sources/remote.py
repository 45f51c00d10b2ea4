"""Corpus index and model downloads. The network is reached through a function that can be replaced."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Fetch = Callable[[str], bytes]


def _http(url: str) -> bytes:
    with urllib.request.urlopen(url, timeout=60) as r:
        return r.read()


def query_corpora(spark: SparkSession, index_url: str, source_lang: str, target_lang: str, fetch: Fetch = _http) -> DataFrame:
    """corpus, url, position of a JSON index of corpora; the first entry of each corpus holds. Errors give an empty table."""
    try:
        found = json.loads(fetch(f"{index_url}?source={source_lang}&target={target_lang}&preprocessing=moses&version=latest")).get("corpora", [])
    except (OSError, ValueError):
        found = []
    rows = [(c.get("corpus"), c.get("url"), i) for i, c in enumerate(found)]
    d = spark.createDataFrame(rows, "corpus STRING, url STRING, position INT")
    return d.groupBy("corpus").agg(F.min_by("url", "position").alias("url"), F.min("position").alias("position"))


def download(url: str, path: str, sha256_prefix: str | None = None, fetch: Fetch = _http) -> str:
    """Fetches url to path unless it is there; through a temporary file, checked against the start of its SHA-256."""
    if os.path.exists(path):
        return path
    data = fetch(url)
    if sha256_prefix and not hashlib.sha256(data).hexdigest().startswith(sha256_prefix):
        raise ValueError(f"{url}: wrong hash")
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with tempfile.NamedTemporaryFile(dir=os.path.dirname(os.path.abspath(path)), delete=False) as f:
        f.write(data)
    os.replace(f.name, path)
    return path


def add_model(spark: SparkSession, path: str) -> None:
    """Sends a model file to every executor; workers find it with SparkFiles.get(basename)."""
    spark.sparkContext.addFile(path)
