import pytest

from tallycast import session


class Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = Context(master), Conf(conf)


def test_shared_folder_of_the_cluster_is_used():
    spark = Session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/cp/"})
    assert session.shared_folder(spark) == "hdfs://shared/cp"
    assert session.work_path(spark, "x").startswith("hdfs://shared/cp/tallycast/x-")


def test_local_session_gets_one_temporary_folder():
    spark = Session("local[2]")
    assert session.shared_folder(spark) == session.shared_folder(spark)


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        session.shared_folder(Session("yarn"))


def test_shuffle_partitions_grow_with_the_input():
    assert session.shuffle_partitions(0) == 200
    assert session.shuffle_partitions(100 * 2**40) == 819200


def test_cut_lineage_keeps_rows(spark):
    frame = session.cut_lineage(spark.range(10).repartition(3))
    assert frame.count() == 10 and "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
