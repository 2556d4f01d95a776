"""Where intermediate tables go."""

import pytest

from millrace import session


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Conf:
    def __init__(self, folder):
        self.folder = folder

    def get(self, key, default=None):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


class _Session:
    def __init__(self, master, conf=None, folder=None):
        self.sparkContext, self.conf = _Context(master, folder), _Conf(conf)


def test_the_session_names_the_folder():
    spark = _Session("spark://host:7077", conf="hdfs://shared/work/")
    assert session.shared_folder(spark) == "hdfs://shared/work"
    assert spark.sparkContext.folder == "hdfs://shared/work/"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        session.shared_folder(_Session("yarn"))


def test_a_local_master_gets_a_folder_once():
    spark = _Session("local[2]")
    assert session.shared_folder(spark) == session.shared_folder(spark)


def test_staged_tables_keep_schema_and_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    stored = session.staged(df, "sample")
    assert stored.schema == df.schema
    assert sorted(r["a"] for r in stored.collect()) == [1, 2]
    assert "FileScan" in stored._jdf.queryExecution().executedPlan().toString()
