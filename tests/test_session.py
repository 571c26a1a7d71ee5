from linewise.session import scratch_path, shared_dir


def test_shared_dir_uses_the_session_checkpoint_dir(spark):
    configured = spark.sparkContext.getCheckpointDir()
    assert configured, "the test session always has a checkpoint folder"
    assert shared_dir(spark) == configured
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(configured) and first != second  # a new folder per use


def test_shared_dir_must_be_set_on_a_cluster():
    import pytest

    from linewise.session import shared_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
