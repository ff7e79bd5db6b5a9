import time
from types import SimpleNamespace

import pytest

from sendgate import session


class Context:
    def __init__(self, master):
        self.master = master
        self.applicationId = "app-1"
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake(master, configured=None):
    return SimpleNamespace(
        sparkContext=Context(master), conf=SimpleNamespace(get=lambda key, default: configured)
    )


def test_configured_folder_is_used_everywhere():
    for master in ("local[4]", "yarn", "spark://host:7077"):
        spark = fake(master, "hdfs://shared/")
        assert session.shared_dir(spark) == "hdfs://shared"
        assert session.new_path(spark, "keys").startswith("hdfs://shared/sendgate-app-1/keys-")


@pytest.mark.parametrize("master", ["local", "local[*]", "local[8]"])
def test_local_session_gets_a_folder_of_its_own_once(master):
    spark = fake(master)
    assert session.shared_dir(spark) == session.shared_dir(spark)


@pytest.mark.parametrize("master", ["yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError):
        session.shared_dir(fake(master))


def test_kept_table_is_a_scan_with_the_same_rows(spark):
    frame = spark.range(10).selectExpr("id", "cast(id as string) s")
    kept = session.keep(frame, "kept")
    assert kept.schema.names == ["id", "s"] and kept.inputFiles()
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, frame.collect()))


def test_scratch_tables_are_dropped(spark):
    with session.scratch(spark):
        kept = session.keep(spark.range(3), "scratch")
        path = kept.inputFiles()[0]
        with session.scratch(spark):
            inner = session.keep(kept, "scratch").inputFiles()[0]
        assert kept.count() == 3
        with pytest.raises(Exception):
            spark.read.parquet(inner)
    with pytest.raises(Exception):
        spark.read.parquet(path)
    session.drop(spark, path)


def test_plans_set_what_they_rely_on(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    session.settle(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    spark.conf.set("spark.sql.session.timeZone", before)


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = blocks.getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffle_files_go_as_a_table_is_kept(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(key, None), shuffle_files(spark)
    held = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
    kept = session.keep(held, "kept")
    deadline = time.time() + 10
    while shuffle_files(spark) - files and time.time() < deadline:
        time.sleep(0.1)
    assert not shuffle_files(spark) - files
    assert spark.conf.get(key, None) == before
    assert sorted(map(tuple, kept.collect())) == [(k, 143 if k < 6 else 142) for k in range(7)]
    # Other jobs of the session keep theirs.
    assert held.count() == held.count() == 7
