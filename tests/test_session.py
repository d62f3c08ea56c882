"""Lifetime of staged tables."""

import os

import pytest
from pyspark.sql import functions as F

from peerledger.session import shared_folder, stage, staging


def staged_tables(spark, name):
    folder = shared_folder(spark).removeprefix("file:")
    return [d for d in os.listdir(folder) if d.startswith(name)]


def test_only_kept_tables_remain(spark):
    with staging(spark) as scope:
        first = stage(spark.range(10), "scope-a")
        second = stage(first.groupBy(F.col("id") % 3).count(), "scope-a")
        scope.release(first)
        assert len(staged_tables(spark, "scope-a")) == 1
        scope.keep(second)
    assert second.count() == 3
    assert len(staged_tables(spark, "scope-a")) == 1


def test_inner_scopes_hand_on(spark):
    with staging(spark):
        with staging(spark) as inner:
            kept = stage(spark.range(5), "scope-b")
            stage(spark.range(5), "scope-b")
            inner.keep(kept)
        assert kept.count() == 5
        assert len(staged_tables(spark, "scope-b")) == 1
    assert staged_tables(spark, "scope-b") == []


def test_a_failure_leaves_nothing(spark):
    with pytest.raises(ZeroDivisionError), staging(spark) as scope:
        scope.keep(stage(spark.range(5), "scope-d"))
        stage(spark.range(5), "scope-c")
        raise ZeroDivisionError
    assert staged_tables(spark, "scope-c") == []
