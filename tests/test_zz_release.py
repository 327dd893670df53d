"""Runs last: releases every scratch path the test session created."""

import pytest
from pyspark.errors import AnalysisException

from fundcast.session import release_scratch, scratch_path, scratch_paths
from fundcast.sinks import write_parquet
from fundcast.sources import read_parquet


def test_release_scratch_removes_created_paths(spark):
    p = scratch_path(spark, "release-check")
    write_parquet(spark.range(2), p)
    assert p in scratch_paths(spark)
    assert release_scratch(spark) >= 1
    assert scratch_paths(spark) == []
    with pytest.raises(AnalysisException):
        read_parquet(spark, p).count()
