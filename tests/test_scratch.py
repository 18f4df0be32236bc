"""Intermediate tables go when the scope that wrote them ends."""

import os

import pytest
from conftest import SF, rows

from runlens.plans import runner
from runlens.session import scratch, shared_dir, written


def files(spark):
    return set(os.listdir(shared_dir(spark)))


def test_query_leaves_nothing_behind(spark, tmp_path):
    before = files(spark)
    with scratch(spark):
        runner("running_counts")(spark, SF).write.parquet(str(tmp_path / "out"))
        assert files(spark) > before
    assert files(spark) == before
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(runner("running_counts")(spark, SF))


def test_inner_scope_ends_first_and_errors_clean_up(spark, tmp_path):
    before, own = files(spark), str(tmp_path / "own")
    with pytest.raises(ValueError), scratch(spark):
        outer = written(spark.range(3), "outer")
        with scratch(spark):
            written(spark.range(5), "inner")
            written(spark.range(7), "own", own)
        assert outer.count() == 3 and len(files(spark) - before) == 1
        raise ValueError
    assert files(spark) == before
    assert spark.read.parquet(own).count() == 7


def test_tables_outside_a_scope_stay(spark):
    kept = written(spark.range(4), "kept")
    with scratch(spark):
        written(spark.range(2), "gone")
    assert kept.count() == 4
