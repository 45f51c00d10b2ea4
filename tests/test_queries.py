import os

import pytest

from linepress.plans import catalogue
from tests.compare import DATA, spark_rows, sql_rows

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    got = spark_rows(QUERIES[name](spark, DATA))
    if name in SQL:
        assert got == sql_rows(SQL[name])


@pytest.mark.parametrize("name", ["rule_verdicts", "query_spans", "resample_parallel", "shard_assign", "tag_protect", "line_offsets"])
def test_partitions_change_nothing(spark, name):
    a = spark_rows(QUERIES[name](spark, DATA))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark_rows(QUERIES[name](spark, DATA)) == a
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_fix_full_takes_every_language_pair(spark):
    d = catalogue.pairs(spark, DATA).filter("trim(source_segment) <> '' AND trim(target_segment) <> ''").select("pair_id", "src_lang", "tgt_lang")
    left = d.join(QUERIES["fix_full"](spark, DATA), "pair_id").select("src_lang", "tgt_lang").distinct()
    assert left.count() == d.select("src_lang", "tgt_lang").distinct().count() > 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
