import pytest

from ontime import session


class _Cluster:
    """A session of a cluster without a shared folder."""
    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(_Cluster)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Cluster)


def test_local_masters():
    assert session._is_local("local") and session._is_local("local[8]")
    assert not session._is_local("local-cluster[3,2,1024]") and not session._is_local("yarn")


def test_queries_keep_generated_methods_small(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "65535")
        assert session.tuned(spark).conf.get(limit) == "8000"
        spark.conf.set(limit, "4000")
        assert session.tuned(spark).conf.get(limit) == "4000"
    finally:
        spark.conf.set(limit, before)
