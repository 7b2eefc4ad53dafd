"""Checkpoint folder: read from the session, never written into its conf."""

from arrears.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if self.value is not None else default

    def set(self, key, value):  # pragma: no cover - must never be called
        raise AssertionError("spark.checkpoint.dir must not be modified at run time")


class _Context:
    applicationId = "app-test"

    def __init__(self, checkpoint=None):
        self.checkpoint = checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, path):
        self.checkpoint = path


class _Session:
    def __init__(self, conf_value, context):
        self.conf = _Conf(conf_value)
        self.sparkContext = context


def test_cluster_setting_is_used_as_is():
    ctx = _Context()
    assert ensure_checkpoint_dir(_Session("hdfs:///shared/ckpt", ctx)) == "hdfs:///shared/ckpt"
    assert ctx.checkpoint == "hdfs:///shared/ckpt"


def test_unset_setting_falls_back_once_per_application():
    ctx = _Context()
    first = ensure_checkpoint_dir(_Session(None, ctx))
    assert first and ctx.checkpoint == first
    assert ensure_checkpoint_dir(_Session(None, _Context())) == first


def test_real_session(spark):
    assert ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def test_run_folder_holds_the_copies_and_is_cleared(spark):
    import os

    from arrears.session import clear_run_folder, materialize, run_folder

    assert materialize(spark.range(3), "kept").count() == 3
    folder = run_folder(spark).removeprefix("file:")
    assert any(name.startswith("kept-") for name in os.listdir(folder))
    # another folder in its place, so that the copies of other tests stay
    old = spark.conf.get("spark.checkpoint.dir", None)
    spark.conf.set("spark.checkpoint.dir", folder + "-apart") if old is None else None
    try:
        if old is None:
            materialize(spark.range(2), "apart")
            assert clear_run_folder(spark) and not clear_run_folder(spark)
    finally:
        spark.conf.unset("spark.checkpoint.dir") if old is None else None


def test_wide_writes_keep_methods_compilable_and_give_the_setting_back(spark, tmp_path, monkeypatch):
    from arrears.plans import preprocess
    from arrears.session import materialize
    from arrears.sources import io
    from fixtures import hand_invoices

    key, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(key, None)
    plans = __import__("arrears.plans.preprocess", fromlist=["x"])
    monkeypatch.setattr(plans, "materialize", lambda df, name: (seen.append(spark.conf.get(key)), materialize(df, name))[1])
    rows = preprocess(hand_invoices(spark), as_of="2024-01-01")
    assert seen == ["8000"] and spark.conf.get(key, None) == before
    io.write_training_set(rows, f"{tmp_path}/ts")
    assert io.read_training_set(spark, f"{tmp_path}/ts").count() == rows.count() and spark.conf.get(key, None) == before
