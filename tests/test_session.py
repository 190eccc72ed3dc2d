import pytest

from tessera import session as S


def test_cluster_conf_bounds():
    small = S.cluster_conf(10 * 1024 ** 3, executors_cores=100)
    huge = S.cluster_conf(100 * 1024 ** 4, executors_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 200          # two waves of the cores
    assert int(huge["spark.sql.shuffle.partitions"]) == 81_920         # ~128 MiB per shuffled partition
    assert int(S.cluster_conf(10 * 1024 ** 5)["spark.sql.shuffle.partitions"]) == 8_388_608  # no upper bound
    assert huge["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_checkpoint_dir_from_session(spark):
    path = S.ensure_checkpoint_dir(spark)
    assert path and spark.sparkContext.getCheckpointDir()
    assert S.ensure_checkpoint_dir(spark) == path


class _Ctx:
    master = "yarn"

    def getCheckpointDir(self):
        return None


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    sparkContext = _Ctx()
    conf = _Conf()


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError):
        S.ensure_checkpoint_dir(_Session())
