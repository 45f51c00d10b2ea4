"""Encoding of a corpus with a public byte-level BPE vocabulary (problem 6).

Speculate and verify: for each distinct word of a batch, greedy longest match over the vocabulary proposes tokens; all
adjacent pairs of all proposals are then tested at once against the set of pairs known to be compatible (a pair is
compatible if encoding its joined bytes gives the pair back; a sequence whose adjacent pairs all are is the one that
merging would give). Pairs not met before are decided once by exact merging and remembered; only words with an
incompatible pair are merged exactly.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that splits a text into words before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words remembered per worker; beyond it the memory is emptied and filled anew (results don't depend on it).
WORDS_KEPT = 400_000
LONGEST_KEPT = 64
#: Decided pairs remembered per worker; beyond it the memory is emptied (results don't depend on it).
PAIRS_KEPT = 1_000_000


class Encoder:
    """Encodes words of one rank file. Not shared between processes."""

    def __init__(self, path: str):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {i: b for b, i in self.ranks.items()}
        self.size = max(self.bytes_of) + 1
        self.longest = max(map(len, self.ranks))
        self.split = regex.compile(PATTERN).findall
        self.sound: dict[int, bool] = {}
        self.known = np.empty(0, np.int64)  # sorted keys a * size + b of pairs decided so far
        self.fits = np.empty(0, bool)
        self.words: dict[str, tuple[int, ...]] = {}
        self.merged = 0  # words that had to be merged exactly
        self.proposed = 0

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the adjacent pair of lowest rank first, leftmost among equals; a heap keeps long words quick."""
        n = len(word)
        ranks = self.ranks
        end = list(range(1, n + 1))  # end of the part that starts here; 0: no part starts here
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := ranks.get(word[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := before[i]) >= 0 and (r := ranks.get(word[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : end[i]]])
            i = end[i]
        return out

    def _is_sound(self, token: int) -> bool:
        if (s := self.sound.get(token)) is None:
            s = self.sound[token] = self.merge(self.bytes_of[token]) == [token]
        return s

    def _greedy(self, word: bytes) -> list[int]:
        out, i, n, ranks = [], 0, len(word), self.ranks
        while i < n:
            for j in range(min(n, i + self.longest), i, -1):
                t = ranks.get(word[i:j])
                if t is not None and (j == i + 1 or self._is_sound(t)):
                    out.append(t)
                    i = j
                    break
        return out

    def _compatible(self, keys: np.ndarray) -> np.ndarray:
        """For each key a * size + b: does merging the joined bytes give (a, b)?"""
        new = np.setdiff1d(keys, self.known)
        if new.size:
            ok = np.fromiter((self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b] for a, b in zip((new // self.size).tolist(), (new % self.size).tolist())), bool, new.size)
            if self.known.size + new.size > PAIRS_KEPT:
                now = np.isin(self.known, keys, assume_unique=True)
                self.known, self.fits = self.known[now], self.fits[now]
            k, f = np.concatenate([self.known, new]), np.concatenate([self.fits, ok])
            order = np.argsort(k)
            self.known, self.fits = k[order], f[order]
        return self.fits[np.searchsorted(self.known, keys)] if keys.size else np.empty(0, bool)

    def learn(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of each of the given distinct words."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        plans = [self._greedy(b) for b in raw]
        lengths = np.fromiter(map(len, plans), np.int64, len(plans))
        flat = np.fromiter(chain.from_iterable(plans), np.int64, int(lengths.sum()))
        bad: set[int] = set()
        if flat.size > 1:
            owner = np.repeat(np.arange(len(plans)), lengths)
            inner = owner[1:] == owner[:-1]
            keys = (flat[:-1] * self.size + flat[1:])[inner]
            uniq, back = np.unique(keys, return_inverse=True)
            fits = self._compatible(uniq)[back]
            bad = set(owner[1:][inner][~fits].tolist())
        self.proposed += len(words)
        self.merged += len(bad)
        return {w: tuple(self.merge(raw[i]) if i in bad else plans[i]) for i, w in enumerate(words)}

    def encode(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); null and empty texts have none."""
        split, words = self.split, self.words
        parts = [split(t) if t else [] for t in texts]
        fresh = set(chain.from_iterable(parts)).difference(words)
        extra: dict[str, tuple[int, ...]] = {}
        if fresh:
            learnt = self.learn(sorted(fresh))
            extra = {w: t for w, t in learnt.items() if len(w) > LONGEST_KEPT}
            if len(words) + len(learnt) > WORDS_KEPT:
                words = self.words = {w: words[w] for w in set(chain.from_iterable(parts)).intersection(words)}
            words.update((w, t) for w, t in learnt.items() if len(w) <= LONGEST_KEPT)
        get = words.__getitem__ if not extra else (lambda w: words[w] if w in words else extra[w])
        rows = [list(chain.from_iterable(map(get, p))) for p in parts]
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.fromiter(chain.from_iterable(rows), np.int32, int(counts.sum())), counts


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _blocks(batch: pa.RecordBatch, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about max_bytes each, so that a batch of long texts doesn't fill the worker's memory."""
    rows = max(1, min(batch.num_rows, int(batch.num_rows * max_bytes / max(1, batch.nbytes))))
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def encode_corpus(docs: DataFrame, row_id: str = "doc_id", text: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """row_id and ids, one row per row of docs, without special tokens; an empty list for null and empty texts.

    vocabulary is a rank file readable on every executor; its directory is a parameter and may come from TOKENIZERS_DIR.
    Narrow: no shuffle. Extra columns are ignored.
    """
    path = vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for b in _blocks(batch, 4 << 20):
                ids, counts = e.encode(b.column(1).to_pylist())
                offsets = np.zeros(len(counts) + 1, np.int32)
                np.cumsum(counts, out=offsets[1:])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))], names=["row_id", "ids"])

    kind = dict(docs.dtypes)[row_id]
    d = docs.select(F.col(row_id).alias("row_id"), F.col(text).cast("string").alias("text"))
    return d.mapInArrow(run, f"row_id {kind}, ids ARRAY<INT>").withColumnRenamed("row_id", row_id)


def count_tokens(docs: DataFrame, row_id: str, text: str, keep: dict[str, Column], vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """row_id, the columns of keep, and n_tokens; the same encoder, but only lengths leave the worker."""
    path = vocabulary
    d = docs.select(F.col(text).cast("string").alias("__text"), F.col(row_id), *[c.alias(k) for k, c in keep.items()])
    schema = ", ".join(f"`{k}` {t}" for k, t in d.dtypes[1:]) + ", n_tokens BIGINT"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            for b in _blocks(batch, 4 << 20):
                _, counts = e.encode(b.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(counts)], names=[*b.schema.names[1:], "n_tokens"])

    return d.mapInArrow(run, schema)


def vocabulary_path() -> str:
    folder = os.environ.get("TOKENIZERS_DIR")
    return os.path.join(folder, "byte_bpe_50k.tiktoken") if folder else DEFAULT_VOCABULARY


def ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary=vocabulary_path())
