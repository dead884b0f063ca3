"""The work folder follows the session; only local mode may make its own."""

import pytest

from claimflow.session import fresh_path, work_dir


class Conf(dict):
    def set(self, key, value):
        assert not key.startswith("spark."), "core settings cannot be changed in a session"
        self[key] = value


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = Context(master), Conf(conf)


def test_named_folder_is_used():
    session = Session("spark://x", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert work_dir(session) == "hdfs:///shared" and session.sparkContext.folder == "hdfs:///shared/"
    assert fresh_path(session, "a") != fresh_path(session, "a")


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError):
        work_dir(Session("spark://x"))


def test_local_mode_makes_one_folder():
    session = Session("local[2]")
    assert work_dir(session) == work_dir(session)
