"""Scratch-folder rules: the session's checkpoint dir wins; a local one only when unset."""

import pytest

from eventlens import session


class _Conf:
    def __init__(self, value=None, read_only=False):
        self.value, self.read_only = value, read_only

    def get(self, key, default=None):
        return self.value if self.value is not None else default

    def set(self, key, value):
        if self.read_only:
            raise RuntimeError("cannot modify a core config")
        self.value = value


class _Context:
    def __init__(self, ckpt=None, master="local[2]"):
        self.ckpt, self.master = ckpt, master

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.ckpt = path


class _Session:
    def __init__(self, conf, sc):
        self.conf, self.sparkContext = conf, sc


def test_session_setting_wins():
    s = _Session(_Conf("s3a://shared/ckpt"), _Context())
    assert session.ensure_checkpoint_dir(s) == "s3a://shared/ckpt"
    assert s.sparkContext.ckpt == "s3a://shared/ckpt"


def test_context_dir_used_when_conf_unset():
    s = _Session(_Conf(None), _Context("hdfs:///ckpt/abc"))
    assert session.ensure_checkpoint_dir(s) == "hdfs:///ckpt/abc"


def test_local_fallback_only_when_unset_even_if_conf_is_read_only():
    s = _Session(_Conf(None, read_only=True), _Context())
    root = session.ensure_checkpoint_dir(s)
    assert root and s.sparkContext.ckpt == root
    assert session.ensure_checkpoint_dir(_Session(_Conf(None, read_only=True), _Context())) == root


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="share"):
        session.ensure_checkpoint_dir(_Session(_Conf(None), _Context(master=master)))


def test_scratch_paths_are_unique_under_the_root():
    s = _Session(_Conf("s3a://shared/ckpt"), _Context())
    a, b = session.scratch_path(s, "lake"), session.scratch_path(s, "lake")
    assert a != b and a.startswith("s3a://shared/ckpt/eventlens/lake-")
