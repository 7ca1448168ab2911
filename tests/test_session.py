"""Scratch folders: a cluster must name a shared one."""

import pytest

from strata.session import checkpoint_root


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def getConf(self):
        return {}


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), {}


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://h"])
def test_cluster_without_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session(master))


def test_local_session_gets_a_folder():
    assert checkpoint_root(_Session("local[2]"))
