"""The shared checkpoint folder is read from the session; a private folder
is made only when the setting is absent."""

import os

import pytest

from emporium import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class _Ctx:
    def __init__(self, value):
        self._conf, self.registered, self.master = _Conf(value), None, "local[1]"

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.registered

    def setCheckpointDir(self, d):
        self.registered = d


class _Spark:
    def __init__(self, value):
        self.sparkContext, self.conf = _Ctx(value), _Conf(value)


def test_reads_the_configured_folder():
    assert session.checkpoint_dir(_Spark("hdfs://shared/ckpt")) == "hdfs://shared/ckpt"


def test_a_cluster_needs_the_shared_folder():
    s = _Spark(None)
    s.sparkContext.master = "spark://host:7077"
    with pytest.raises(RuntimeError):
        session.checkpoint_dir(s)


def test_private_folder_only_when_unset():
    s = _Spark(None)
    d = session.checkpoint_dir(s)
    assert os.path.isdir(d) and s.sparkContext.registered == d
    assert session.run_folder(s, "x").startswith(d.rstrip("/") + "/runs/x-")
