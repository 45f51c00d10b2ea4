"""Duplicates hidden by formatting: an incremental ledger of canonical keys (problem 1).

A record's canonical key holds the letters, combining marks and digits of its two sides, case-folded, in an order
that does not depend on which side is the source. The ledger keeps (bucket, key, n_copies, first_id); a batch is
aggregated by key, full-outer-joined with the ledger's matching buckets only, counts are added and the smallest id
is kept. Buckets live in their own folders; a manifest of each version says where every bucket's rows are, so an
update rewrites only what the batch touches and an update that was lost half-way leaves the old version whole.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepress.session import fresh_path, materialise

#: The dotless i has no case partner of its own in upper case; this caseless letter stands for it.
DOTLESS_I, DOTLESS_I_STANDS_FOR = "ı", "ꟷ"
SEPARATOR = "\u0001"
#: Records for each bucket of a ledger, where its user names no number of buckets.
ROWS_PER_BUCKET = 2_000_000


def letters_only(text: Column) -> Column:
    """Letters, combining marks and digits of text, fully case-folded; '' for null.

    Lower then upper case equals full case folding up to the choice of representative (ß, ẞ, SS agree, as do σ and ς);
    the removal between the two keeps the optimiser from merging them.
    """
    low = F.lower(F.translate(F.coalesce(text, F.lit("")), DOTLESS_I, DOTLESS_I_STANDS_FOR))
    return F.upper(F.regexp_replace(low, r"[^\p{L}\p{M}\p{N}]+", ""))


def with_pair_key(df: DataFrame, source: str, target: str, key: str = "copy_key") -> DataFrame:
    """Adds a 16-byte key equal for copies (also with sides exchanged); null where a record has no letter or digit."""
    d = df.withColumn("__a", letters_only(F.col(source))).withColumn("__b", letters_only(F.col(target)))
    text = F.concat_ws(SEPARATOR, F.least("__a", "__b"), F.greatest("__a", "__b"))
    # combining marks alone are neither letters nor digits
    has = F.concat("__a", "__b").rlike(r"[\p{L}\p{N}]")
    return d.withColumn(key, F.when(has, F.unhex(F.md5(text)))).drop("__a", "__b")


def bucket_of(key: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


class CopyLedger:
    """Counts of canonical keys on shared storage, updated batch by batch.

    path: folder of the ledger. n_buckets: fixed when the ledger is made; choose it so that a bucket is a few hundred MB
    (16 here suits gigabytes, 4096 suits 100 TB). apply() is idempotent by batch_id.
    """

    def __init__(self, spark: SparkSession, path: str, n_buckets: int = 16):
        self.spark, self.path, self.n_buckets = spark, path.rstrip("/"), n_buckets
        self.version, self.batches, self.places = 0, [], {}
        jvm = spark._jvm
        self._fs = jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._load()

    def _hpath(self, p: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(p)

    def _load(self) -> None:
        root = self._hpath(f"{self.path}/manifest")
        if not self._fs.exists(root):
            return
        versions = sorted(int(s.getPath().getName()) for s in self._fs.listStatus(root) if s.getPath().getName().isdigit())
        if versions:
            text = self.spark.read.text(f"{self.path}/manifest/{versions[-1]}", wholetext=True).first()[0]
            m = json.loads(text)
            self.version, self.batches, self.n_buckets = versions[-1], m["batches"], m["n_buckets"]
            self.places = {int(k): v for k, v in m["places"].items()}

    def _publish(self) -> None:
        body = json.dumps({"batches": self.batches, "n_buckets": self.n_buckets, "places": self.places})
        tmp = self._hpath(f"{self.path}/manifest/_{uuid.uuid4().hex}")
        out = self._fs.create(tmp)
        out.write(bytearray(body.encode()))
        out.close()
        if not self._fs.rename(tmp, self._hpath(f"{self.path}/manifest/{self.version}")):
            raise RuntimeError("another writer published this version of the ledger")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """bucket, copy_key, n_copies, first_id; of the given buckets or of all."""
        schema = "copy_key BINARY, n_copies BIGINT, first_id BIGINT"
        wanted = sorted(b for b in (self.places if buckets is None else buckets) if b in self.places)
        if not wanted:
            return self.spark.createDataFrame([], f"bucket INT, {schema}")
        by: dict[str, list[int]] = {}
        for b in wanted:
            by.setdefault(self.places[b], []).append(b)
        out = None
        for v, bs in by.items():
            part = self.spark.read.schema(f"{schema}, bucket INT").parquet(f"{self.path}/data/{v}").filter(F.col("bucket").isin(bs))
            out = part if out is None else out.unionByName(part)
        return out.select("bucket", "copy_key", "n_copies", "first_id")

    def apply(self, batch: DataFrame, batch_id: str, key: str = "copy_key", row_id: str = "pair_id") -> bool:
        """Adds a batch (null keys don't count); False if this batch_id was applied before."""
        if batch_id in self.batches:
            return False
        new = (
            batch.filter(F.col(key).isNotNull())
            .groupBy(F.col(key).alias("copy_key"))
            .agg(F.count(F.lit(1)).alias("n_new"), F.min(row_id).alias("first_new"))
            .withColumn("bucket", bucket_of(F.col("copy_key"), self.n_buckets))
        )
        if len(self.places) == self.n_buckets or not self.places:
            touched = list(range(self.n_buckets))
        else:
            new = materialise(new, "ledger-batch")
            touched = [r[0] for r in new.select("bucket").distinct().collect()]  # at most n_buckets numbers
        old = self.read(touched)
        merged = new.join(old, ["bucket", "copy_key"], "full_outer").select(
            "bucket",
            "copy_key",
            (F.coalesce("n_new", F.lit(0)) + F.coalesce("n_copies", F.lit(0))).alias("n_copies"),
            F.least("first_new", "first_id").alias("first_id"),
        )
        self.version += 1
        place = f"v{self.version}-{uuid.uuid4().hex[:8]}"
        n = min(self.n_buckets, max(1, len(touched)))
        # a bucket is one task's, and tasks get as many buckets each
        merged.repartitionById(n, F.pmod("bucket", F.lit(n)).cast("int")).write.partitionBy("bucket").parquet(f"{self.path}/data/{place}")
        self.places |= {b: place for b in touched}
        self.batches.append(batch_id)
        self._publish()
        self._clean()
        return True

    def _clean(self) -> None:
        """Deletes manifests but the last two, and data that neither of them names: readers of the version before go on."""
        root = self._hpath(f"{self.path}/manifest")
        versions = sorted(int(s.getPath().getName()) for s in self._fs.listStatus(root) if s.getPath().getName().isdigit())
        for v in versions[:-2]:
            self._fs.delete(self._hpath(f"{self.path}/manifest/{v}"), True)
        named = set()
        for v in versions[-2:]:
            text = self.spark.read.text(f"{self.path}/manifest/{v}", wholetext=True).first()[0]
            named |= set(json.loads(text)["places"].values())
        for s in self._fs.listStatus(self._hpath(f"{self.path}/data")):
            name = s.getPath().getName()
            if name not in named and int(name[1:].split("-")[0]) < versions[-1]:
                self._fs.delete(s.getPath(), True)


def copy_links(keyed: DataFrame, ledger: DataFrame, row_id: str = "pair_id", key: str = "copy_key", hot_share: float = 0.001) -> DataFrame:
    """One row (first_id, row_id) for every record but the first of its group of copies.

    A key that holds more than hot_share of all copies is broadcast (at most 1/hot_share such keys exist); the others
    are joined by key, where no key is large.
    """
    groups = ledger.filter("n_copies > 1").select("copy_key", "first_id", "n_copies")
    total = groups.agg(F.sum("n_copies")).first()[0] or 0
    hot = groups.filter(F.col("n_copies") > F.lit(hot_share * total)).filter("n_copies > 10000")
    cold = groups.filter(~((F.col("n_copies") > F.lit(hot_share * total)) & (F.col("n_copies") > 10000)))
    rows = keyed.filter(F.col(key).isNotNull()).select(F.col(row_id), F.col(key).alias("copy_key"))
    if hot.isEmpty():
        j = rows.join(cold.select("copy_key", "first_id"), "copy_key")
    else:
        marked = rows.join(F.broadcast(hot.select("copy_key", F.col("first_id").alias("hot_first"))), "copy_key", "left")
        a = marked.filter("hot_first IS NOT NULL").select("copy_key", row_id, F.col("hot_first").alias("first_id"))
        b = marked.filter("hot_first IS NULL").drop("hot_first").join(cold.select("copy_key", "first_id"), "copy_key").select("copy_key", row_id, "first_id")
        j = a.unionByName(b)
    return j.filter(F.col(row_id) != F.col("first_id")).select("first_id", row_id)


def collapse_copies(spark: SparkSession, pairs: DataFrame, source: str = "source_segment", target: str = "target_segment", row_id: str = "pair_id", n_batches: int = 3, n_buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(keyed records, ledger) of a table, fed to a new ledger in n_batches of ascending row_id, as it would arrive.

    n_buckets: by default one for each two million records, 16 at least. Null sides count as empty; records with no letter or digit are in no group; an empty table gives an empty ledger.
    Extra columns are ignored.
    """
    base = pairs.select(F.col(row_id).alias("pair_id"), F.col(source).alias("__s"), F.col(target).alias("__t"))
    keyed = materialise(with_pair_key(base, "__s", "__t").select("pair_id", "copy_key").filter("copy_key IS NOT NULL"), "copy-keys")
    lo, hi, n = keyed.agg(F.min("pair_id"), F.max("pair_id"), F.count(F.lit(1))).first()
    ledger = CopyLedger(spark, fresh_path(spark, "ledger"), n_buckets or max(16, -(-n // ROWS_PER_BUCKET)))
    if lo is not None:
        edges = [lo + (hi - lo + 1) * i // n_batches for i in range(n_batches + 1)]
        for i in range(n_batches):
            ledger.apply(keyed.filter((F.col("pair_id") >= edges[i]) & (F.col("pair_id") < edges[i + 1])), f"batch-{i}")
    return keyed, ledger.read()


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spark.read.parquet(f"{sf_dir}/bifixer.parquet")
    keyed, ledger = collapse_copies(spark, pairs)
    return copy_links(keyed, ledger).select(F.col("first_id").alias("first_pair_id"), F.col("pair_id").alias("copy_pair_id"))


def distinct_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per distinct pair: its first record's id and the number of copies."""
    _, ledger = collapse_copies(spark, spark.read.parquet(f"{sf_dir}/bifixer.parquet"))
    return ledger.select(F.col("first_id").alias("first_pair_id"), "n_copies")
