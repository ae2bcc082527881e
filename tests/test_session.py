import pytest

from careledger import session


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Context(master)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1000]", "k8s://x"])
def test_unset_folder_on_a_cluster_raises(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session(master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_unset_folder_in_local_mode_is_made(master):
    spark = _Session(master)
    assert session.ensure_checkpoint_dir(spark) == spark.sparkContext.dir
