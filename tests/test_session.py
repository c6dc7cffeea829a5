"""The shared checkpoint folder is read from the session, never overridden."""

from cabflow.session import ensure_checkpoint_dir, scratch_path


def test_checkpoint_dir_is_kept_and_scratch_lives_under_it(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before
    assert ensure_checkpoint_dir(spark) == before == spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(before.rstrip("/") + "/") and a != b


def test_cluster_without_shared_folder_is_refused(spark, monkeypatch):
    import pytest

    from cabflow import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
