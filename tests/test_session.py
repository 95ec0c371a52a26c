import pytest

from quayside import session


class Context:
    def __init__(self, master, directory=None):
        self.master, self.directory = master, directory

    def getCheckpointDir(self):
        return self.directory

    def setCheckpointDir(self, directory):
        self.directory = directory


class Session:
    """Just enough of a session to ask it where its shared folder is."""

    def __init__(self, master, named=None, directory=None):
        self.sparkContext, self.named = Context(master, directory), named
        self.conf = self

    def get(self, key, default):
        return self.named if key == "spark.checkpoint.dir" else default


def test_the_named_folder_is_used():
    spark = Session("yarn", "hdfs:///shared/")
    assert session.workspace_root(spark) == "hdfs:///shared"
    assert spark.sparkContext.directory == "hdfs:///shared/"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.workspace_root(Session("yarn"))


def test_a_local_session_gets_a_folder_once():
    spark = Session("local[2]")
    assert session.workspace_root(spark) == session.workspace_root(spark)


def test_settings_reach_a_session_made_elsewhere(spark):
    session.apply_settings(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.sparkContext.getCheckpointDir()
