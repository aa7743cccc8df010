from types import SimpleNamespace

import pytest

from chainsight.llm import common


def session(master, conf=None, folder=None):
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: folder, setCheckpointDir=lambda path: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: conf or default), sparkContext=context)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://host"])
def test_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(session(master))


def test_the_named_folder_is_taken():
    assert common.shared_dir(session("yarn", conf="s3://b/x/")).startswith("s3://b/x/chainsight-llm/app-1/")
    assert common.shared_dir(session("yarn", folder="hdfs://n/y")).startswith("hdfs://n/y/chainsight-llm/app-1/")
    assert common.shared_dir(session("local[4]")).startswith("/")


def test_work_column_beside_any_names():
    df = SimpleNamespace(columns=["a", "_Work", "_work_"])
    assert common.beside(df) == "_work__" and common.beside(df, "_work__") == "_work___"
