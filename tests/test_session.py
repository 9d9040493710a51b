"""Shared-folder resolution: the session's setting first, a local folder only when unset."""

import os

import pytest

from ledgerlake import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, current=None, master="local[4]"):
        self.current, self.set_to, self.master = current, None, master

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.set_to = path


class _Session:
    def __init__(self, conf_value=None, current=None, master="local[4]"):
        self.conf, self.sparkContext = _Conf(conf_value), _Context(current, master)


def test_configured_folder_wins():
    assert session.shared_dir(_Session("hdfs://nn/shared/ckpt/")) == "hdfs://nn/shared/ckpt"


def test_checkpoint_dir_of_the_context_is_used():
    assert session.shared_dir(_Session(None, "s3a://bucket/ckpt/abc")) == "s3a://bucket/ckpt/abc"


def test_unset_creates_and_registers_a_local_folder():
    s = _Session(None, None)
    path = session.shared_dir(s)
    assert os.path.isdir(path) and s.sparkContext.set_to == path


def test_unset_raises_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(_Session(None, None, master))


def test_fresh_dirs_are_distinct():
    s = _Session("/shared")
    a, b = session.fresh_dir(s, "x"), session.fresh_dir(s, "x")
    assert a != b and a.startswith("/shared/ledgerlake/x-")


def test_batch_id_from_clock():
    assert session.batch_id_for("2026-04-23 04:22:19") == "20260423_042219"
