from types import SimpleNamespace

import pytest

from corpusflow.sources import scratch


def session(master, warehouse, configured=None, folder=None):
    set_to = [folder]
    context = SimpleNamespace(
        master=master,
        getConf=lambda: {scratch.CHECKPOINT_CONF: configured} if configured else {},
        getCheckpointDir=lambda: set_to[0],
        setCheckpointDir=lambda path: set_to.__setitem__(0, path),
    )
    conf = {"spark.sql.warehouse.dir": warehouse}
    get = SimpleNamespace(get=lambda key, *default: conf.get(key, *default))
    return SimpleNamespace(sparkContext=context, conf=get)


def test_the_configured_folder_comes_first():
    spark = session("spark://a:7077", "file:/w", configured="hdfs://a/scratch")
    assert scratch.checkpoint_root(spark) == "hdfs://a/scratch"
    assert spark.sparkContext.getCheckpointDir() == "hdfs://a/scratch"


@pytest.mark.parametrize(
    "master, warehouse", [("local[8]", "file:/w/"), ("yarn", "hdfs://a/w"), ("yarn", "/w")]
)
def test_the_warehouse_serves_otherwise(master, warehouse):
    found = scratch.checkpoint_root(session(master, warehouse))
    assert found == warehouse.rstrip("/") + "/corpusflow-scratch"


def test_a_cluster_never_uses_a_local_warehouse():
    with pytest.raises(ValueError, match="shared folder"):
        scratch.checkpoint_root(session("yarn", "file:/w"))
    assert scratch.checkpoint_root(session("yarn", "file:/w", folder="s3a://b/c")) == "s3a://b/c"
