"""Stage storage: shared folders on clusters, ownership of written stages."""

import os
import time

import pytest

from affinity import session


class _Context:
    def __init__(self, master, conf=None, current=None):
        self.master, self._conf, self._current, self.set = master, conf or {}, current, []

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._current

    def setCheckpointDir(self, path):
        self.set.append(path)


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(_Session(_Context(master)))
    sc = _Context(master, {"spark.checkpoint.dir": "hdfs://shared/x"})
    assert session.ensure_checkpoint_dir(_Session(sc)) == "hdfs://shared/x" and sc.set == ["hdfs://shared/x"]


def test_released_stage_is_deleted(spark):
    df = session.materialize(spark.range(5).toDF("x"), "t")
    path = df._affinity_path
    assert session.materialize(df) is df and df.count() == 5
    assert os.path.isdir(path.removeprefix("file:"))
    session.release(df)
    assert not os.path.exists(path.removeprefix("file:"))


def test_active_session_keeps_its_settings(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert session.get_spark(shuffle_partitions=99).conf.get("spark.sql.shuffle.partitions") == "8"


def test_a_written_stage_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles())
                     if f.getName().startswith("shuffle_")}
    before, setting = files(), spark.conf.get(session.DROP_SHUFFLES)
    df = session.materialize(spark.range(1000).repartition(3, "id"), "t")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before and df.count() == 1000
    assert spark.conf.get(session.DROP_SHUFFLES) == setting
