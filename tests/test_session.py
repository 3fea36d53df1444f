import os

import pytest

from starloom import session
from starloom.session import Scratch, materialize, scratch_path, shared_dir


def test_shared_dir_is_the_one_the_session_names(spark, monkeypatch):
    assert shared_dir(spark) == shared_dir(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


class _Conf:
    def get(self, name, default=None):
        return default


class _Cluster:
    """A session on a cluster without a shared folder."""

    conf = _Conf()

    class sparkContext:
        master = "spark://somewhere:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Cluster())


def test_copies_keep_rows_and_types(spark):
    df = spark.sql("select cast(1.5 as decimal(10,2)) as a, cast(null as date) as b, id from range(3)")
    copy = materialize(df, "copy")
    assert copy.schema.simpleString() == df.schema.simpleString()
    assert sorted(copy.collect()) == sorted(df.collect())


def test_scratch_removes_its_copies_only(spark):
    other = materialize(spark.range(2), "other")
    scratch = Scratch(spark)
    kept = scratch.keep(spark.range(5), "mine")
    folder = scratch.paths[0].removeprefix("file:")
    assert kept.count() == 5 and os.path.isdir(folder)
    scratch.clear()
    assert not os.path.exists(folder) and other.count() == 2


def test_runtime_settings_are_applied(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    session.configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
