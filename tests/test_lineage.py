import pytest
from pyspark.sql import functions as F

from conftest import rows
from ripplekit.plans import lineage
from ripplekit.plans.lineage import ensure_checkpoint_dir, materialize, scratch_path


def test_checkpoint_folder_is_kept(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.rsplit("/", 1)[0] == b.rsplit("/", 1)[0]
    assert a.startswith(first.rstrip("/") + "/ripplekit-")


def test_materialize_keeps_rows(spark):
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("k"), F.col("id"))
    assert rows(materialize(df, "lineage-test")) == rows(df)


def test_no_folder_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    if not spark.conf.get("spark.checkpoint.dir", None):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            lineage.scratch_path(spark, "x")


def test_only_a_local_session_gets_a_folder_of_its_own(spark, monkeypatch):
    sc = type(spark.sparkContext)
    monkeypatch.setattr(sc, "getCheckpointDir", lambda self: None)
    made = []
    monkeypatch.setattr(sc, "setCheckpointDir", lambda self, folder: made.append(folder))
    if spark.conf.get("spark.checkpoint.dir", None):
        pytest.skip("the session names a folder")
    monkeypatch.setattr(sc, "master", "spark://somewhere:7077", raising=False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lineage.own_checkpoint_dir(spark)
    assert not made
    monkeypatch.setattr(sc, "master", "local[2]", raising=False)
    with pytest.raises(RuntimeError):   # the folder is made, then not found by the stub
        lineage.own_checkpoint_dir(spark)
    assert len(made) == 1
