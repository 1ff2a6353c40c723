import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cohortlens import session


def test_materialised_tables_are_read_back_and_dropped(spark):
    written = session.materialise(spark.range(10).withColumn("x", F.rand(1)), "probe")
    assert written.count() == 10
    # rows no longer depend on how they were made
    assert rows(written, "x") == rows(written, "x")
    path = written.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    assert session.drop_materialised(spark) > 0
    assert not os.path.exists(path)
    assert session.drop_materialised(spark) == 0


class _Cluster:
    """Stands for a session on a cluster without a checkpoint folder, or with one."""

    def __init__(self, folder):
        self.sparkContext = self
        self.master = "spark://somewhere:7077"
        self.folder = folder

    def getConf(self):
        return self

    def get(self, key):
        assert key == "spark.checkpoint.dir"
        return self.folder

    def getCheckpointDir(self):
        return None


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        session.checkpoint_root(_Cluster(None))
    assert session.checkpoint_root(_Cluster("hdfs:///shared/ck")) == "hdfs:///shared/ck"
