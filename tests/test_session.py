"""What stored stages leave behind."""

from __future__ import annotations

from corpusmill.session import spill


def test_a_stored_stage_leaves_no_shuffle_files(spark):
    """The files are counted by the driver's tracker of map outputs; the setting is as it was afterwards."""
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = tracker.shuffleStatuses().size(), spark.conf.get(key)
    stored = spill(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count())
    assert tracker.shuffleStatuses().size() <= before
    assert stored.count() == 7
    assert spark.conf.get(key) == setting
