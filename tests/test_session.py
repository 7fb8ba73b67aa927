"""Scratch folder resolution."""

import pytest

from tessera import session


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class _SC:
    master = "local[2]"
    applicationId = "app-test"

    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d + "/uuid"


class _Spark:
    def __init__(self, value):
        self.conf = _Conf(value)
        self.sparkContext = _SC()


def test_uses_the_session_setting():
    assert session.checkpoint_root(_Spark("hdfs://nn/shared/ckpt/")) == "hdfs://nn/shared/ckpt"
    assert session.scratch_path(_Spark("s3a://b/ckpt"), "x").startswith("s3a://b/ckpt/tessera/x-")


def test_local_fallback_registers_once_without_setting_the_conf():
    s = _Spark(None)
    a = session.checkpoint_root(s)
    assert s.sparkContext.dir is not None and a == s.sparkContext.dir
    assert session.checkpoint_root(s) == a


def test_a_cluster_without_a_shared_folder_is_refused():
    assert session.machine_local_is_shared("local") and session.machine_local_is_shared("local[*]")
    for master in ("local-cluster[3,2,1024]", "yarn", "spark://h:7077", "k8s://https://h"):
        assert not session.machine_local_is_shared(master)
    s = _Spark(None)
    s.sparkContext.master = "yarn"
    s.sparkContext.applicationId = "other"
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.checkpoint_root(s)
