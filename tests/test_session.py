from __future__ import annotations

import os

import pytest

from stacklore import session


def test_scratch_is_written_and_dropped(spark):
    table = session.materialise(spark.range(10), "numbers")
    path = table.inputFiles()[0].removeprefix("file://")
    assert table.count() == 10 and os.path.exists(path)
    assert spark.sparkContext.applicationId in path
    other = session.scratch_path(spark, "numbers")
    assert other != session.scratch_path(spark, "numbers")
    session.drop_scratch(spark)
    assert not os.path.exists(path) and not session.has_files(spark, other)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_configured_folder_is_used(spark):
    class Conf:
        def get(self, key, default):
            return "s3a://shared/checkpoints/"

    class Cluster:
        conf, sparkContext = Conf(), spark.sparkContext

    assert session.shared_dir(Cluster()) == "s3a://shared/checkpoints"
