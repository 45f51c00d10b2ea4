import os

import pytest

from linepress import session


@pytest.fixture
def unset(spark, monkeypatch):
    """The session without the setting and without a checkpoint directory."""
    made = []
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: made[-1] if made else None)
    monkeypatch.setattr(spark.sparkContext, "setCheckpointDir", made.append)
    monkeypatch.setattr(spark.conf, "get", lambda k, d=None: d)
    return made


def test_setting_names_the_folder(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_one_machine_needs_no_setting(spark, unset):
    assert session.shared_dir(spark) == unset[-1]


def test_checkpoint_directory_of_the_session_is_used(spark, unset):
    unset.append("file:/shared/check/1")
    assert session.shared_dir(spark) == "file:/shared/check/1"


def test_cluster_without_a_shared_folder_is_an_error(spark, unset, monkeypatch):
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        monkeypatch.setattr(spark.sparkContext, "master", master)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(spark)


def test_discarded_tables_are_gone(spark):
    t = session.materialise(spark.range(5), "t")
    path = t._linepress_path
    assert t.count() == 5 and os.path.isdir(path)
    session.discard(t, spark.range(1))
    assert not os.path.exists(path)
