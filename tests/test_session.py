"""Scratch folders and who deletes them."""

from pathlib import Path

import pytest

from isobar import session
from isobar import schema as S
from isobar.operators import features, split
from isobar.plans import report, train
from isobar.sources.artifacts import ArtifactStore


def folders(spark):
    return set(Path(session.shared_dir(spark).removeprefix("file:")).iterdir())


def test_a_scope_leaves_no_folder(spark, table):
    before = folders(spark)
    with session.scratch_scope(spark):
        sample = split.capped_sample(table, S.MODEL_KEY, 0.5, 50, ["split"])
        assert sample.count() == 100 and features.standard_scale(table, ["DEW_C"]).count() > 0
        assert len(folders(spark) - before) >= 2
    assert folders(spark) == before


def test_a_scope_cleans_up_after_an_error_and_nests(spark):
    before = folders(spark)
    with pytest.raises(RuntimeError):
        with session.scratch_scope(spark):
            outer = session.scratch_path(spark, "outer")
            spark.range(3).write.parquet(outer)
            with session.scratch_scope(spark):
                spark.range(3).write.parquet(session.scratch_path(spark, "inner"))
            assert len(folders(spark) - before) == 1 and spark.read.parquet(outer).count() == 3
            raise RuntimeError
    assert folders(spark) == before


def test_without_a_scope_folders_stay(spark):
    path = session.scratch_path(spark, "kept")
    spark.range(1).write.parquet(path)
    assert spark.read.parquet(path).count() == 1
    session.delete_path(spark, path)
    session.delete_path(spark, path)  # no error if it is gone


def test_jobs_clean_up_after_themselves(spark, table, tmp_path):
    store = ArtifactStore(spark, str(tmp_path / "store"))
    before = folders(spark)
    train.train_family(table, store, "lr", features=["DEW_C"], grid={"regParam": [0.0], "elasticNetParam": [0.0]}, sample_cap=20)
    report.export_tidy(store, str(tmp_path / "tidy"), cap=10)
    assert folders(spark) == before
