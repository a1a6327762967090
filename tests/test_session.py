"""Session rules: UTC, tuning only when unset, checkpoint folder from the session."""

from __future__ import annotations

import pytest

from tallyspark.session import checkpoint_dir, ensure_session_conf


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


class _Context:
    def __init__(self, master):
        self.master = master
        self.dir = None

    def getCheckpointDir(self):  # noqa: N802 (Spark's name)
        return self.dir

    def setCheckpointDir(self, path):  # noqa: N802
        self.dir = path


class _Session:
    def __init__(self, master, conf):
        self.conf = _Conf(conf)
        self.sparkContext = _Context(master)


def test_cluster_without_shared_checkpoint_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(_Session("yarn", {}))


def test_cluster_folder_is_read_from_the_session():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert s.sparkContext.dir == "hdfs:///shared/ckpt"


def test_required_settings_forced_tuning_only_filled_in():
    s = _Session("local[2]", {"spark.sql.session.timeZone": "America/New_York",
                              "spark.sql.adaptive.enabled": "false",
                              "spark.checkpoint.dir": "/tmp/x"})
    ensure_session_conf(s)
    assert s.conf["spark.sql.session.timeZone"] == "UTC"
    assert s.conf["spark.sql.adaptive.enabled"] == "false"  # the cluster's choice wins
    assert s.conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
