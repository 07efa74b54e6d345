from strata.session import cluster_conf, scratch_path, shared_root


def test_shared_root_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root.rstrip("/")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and a != b


def test_cluster_conf_scales_with_cores():
    conf = cluster_conf(1000, 8)
    assert conf["spark.sql.shuffle.partitions"] == "24000"
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    assert "RocksDB" in conf["spark.sql.streaming.stateStore.providerClass"]


def test_cluster_session_without_shared_folder_is_an_error(spark):
    import pytest

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())
