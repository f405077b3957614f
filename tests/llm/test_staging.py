"""Steps whose Python functions get whole texts: bounded Arrow batches, and the session as it was."""

import pyarrow as pa
import pytest

from skymetrics.llm import staging

SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])


def test_batches_of_a_step_are_bounded(spark):
    before = spark.conf.get(SETTING)
    sizes = staging.stage(spark.range(0, 3500, 1, 1).mapInArrow(_sizes, "n long"), "sizes", staging.TEXT_ROWS)
    assert sorted(r.n for r in sizes.collect()) == [500, 1000, 1000, 1000]
    assert spark.conf.get(SETTING) == before


def test_a_smaller_setting_and_errors_keep_the_session(spark):
    before = spark.conf.get(SETTING)
    spark.conf.set(SETTING, "700")
    try:
        sizes = staging.stage(spark.range(0, 1400, 1, 1).mapInArrow(_sizes, "n long"), "sizes", staging.TEXT_ROWS)
        assert [r.n for r in sizes.collect()] == [700, 700]
    finally:
        spark.conf.set(SETTING, before)
    with pytest.raises(RuntimeError), staging._batches_of(spark, 10):
        raise RuntimeError
    assert spark.conf.get(SETTING) == before
