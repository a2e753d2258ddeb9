"""The shared folder comes from the session; a local folder only for local masters."""

import pytest

from clinark.session import shared_dir


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class _Context:
    def __init__(self, master, conf=None, checkpoint=None):
        self.master = master
        self._conf = _Conf(conf or {})
        self._checkpoint = checkpoint

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._checkpoint


class _Session:
    def __init__(self, context):
        self.sparkContext = context
        self.conf = _Conf()


def test_cluster_setting_is_used():
    s = _Session(_Context("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ck/"}))
    assert shared_dir(s) == "hdfs://nn/shared/ck"


def test_context_checkpoint_dir_is_used():
    s = _Session(_Context("k8s://x", checkpoint="s3a://bucket/ck/1234-uuid"))
    assert shared_dir(s) == "s3a://bucket/ck"


def test_unset_on_a_cluster_is_an_error():
    with pytest.raises(RuntimeError):
        shared_dir(_Session(_Context("spark://master:7077")))
