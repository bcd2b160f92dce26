"""The shared folder comes from the session."""

from types import SimpleNamespace

import os

import pytest

from rowloom.plans.skew import stored
from rowloom.session import release, shared_dir


class Context:
    path, master = None, "local[2]"

    def setCheckpointDir(self, path):  # noqa: N802
        self.path = f"file:{path}/id"

    def getCheckpointDir(self):  # noqa: N802
        return self.path


def test_named_folder_is_used(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "a"), shared_dir(spark, "a")
    assert first.startswith(f"{root}/a-") and first != second


def test_folder_is_made_only_where_none_is_set():
    session = SimpleNamespace(sparkContext=Context(), conf=SimpleNamespace(get=lambda key, default: default))
    first, second = shared_dir(session, "a"), shared_dir(session, "b")
    assert first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0] == session.sparkContext.path


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_no_folder_of_one_machine_on_a_cluster(master):
    session = SimpleNamespace(sparkContext=Context(), conf=SimpleNamespace(get=lambda key, default: default))
    session.sparkContext.master = master
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session, "a")


def test_stored_results_are_removed(spark):
    release(spark)
    (path,) = {os.path.dirname(f.removeprefix("file://")) for f in stored(spark.range(5)).inputFiles()}
    assert os.path.isdir(path)
    assert release(spark) == 1 and not os.path.exists(path)
