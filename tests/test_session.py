from ledgerline.session import build_session, checkpoint_root, default_parallelism, scratch_path


def test_scratch_folders_live_under_the_checkpoint_dir_and_never_repeat(spark):
    root = checkpoint_root(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root + "/ledgerline/x-") and b.startswith(root + "/ledgerline/x-")


def test_default_parallelism_and_session_settings(spark):
    assert default_parallelism(spark) >= 1
    same = build_session(extra_conf={"spark.sql.shuffle.partitions": "8"})   # returns the active session
    assert same.conf.get("spark.sql.adaptive.enabled") == "true"
    assert same.conf.get("spark.ui.showConsoleProgress") == "false"


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    import pytest

    from ledgerline import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(Session())
