import pytest

from tidewire import schemas
from tidewire.operators import layout


@pytest.fixture
def desired(spark):
    return spark.createDataFrame(
        [("user-actions", 12, 3, None), ("content-interactions", 6, 3, None)], schemas.TOPIC_SPEC
    )


def observed(spark, *rows):
    return spark.createDataFrame(list(rows), "topic string, partitions int")


def result(audited):
    return {r.name: (r.status, r.detail) for r in audited.collect()}


def test_first_run_finds_everything_missing(spark, desired):
    nothing = observed(spark)
    assert {r.name for r in layout.missing(desired, nothing).collect()} == {"user-actions", "content-interactions"}
    assert result(layout.audit(desired, nothing)) == {
        "user-actions": ("missing", None), "content-interactions": ("missing", None)
    }


def test_second_run_finds_nothing_to_create(spark, desired):
    there = observed(spark, ("user-actions", 12), ("content-interactions", 6), ("other", 1))
    assert layout.missing(desired, there).isEmpty()
    audited = layout.audit(desired, there)
    assert {status for status, _ in result(audited).values()} == {"verified"}
    assert not layout.has_mismatches(audited)


def test_mismatch_is_reported_with_both_counts(spark, desired):
    audited = layout.audit(desired, observed(spark, ("user-actions", 4)))
    assert result(audited) == {
        "user-actions": ("mismatched", "user-actions (expected 12 partitions, found 4)"),
        "content-interactions": ("missing", None),
    }
    assert layout.has_mismatches(audited)


def test_presence_is_by_name_only(spark, desired):
    there = observed(spark, ("user-actions", 4))
    assert [r.name for r in layout.present(desired, there).collect()] == ["user-actions"]
    assert [r.name for r in layout.name_intersection(desired, there).collect()] == ["user-actions"]
    assert [r.name for r in layout.name_difference(desired, there).collect()] == ["content-interactions"]


def test_names_to_create_are_distinct(spark, desired):
    assert layout.missing(desired.unionByName(desired), observed(spark)).count() == 2


def test_observed_layout_counts_partitions_and_takes_declared_ones(spark):
    records = spark.createDataFrame([("a", 0), ("a", 0), ("a", 3), ("b", 1)], "topic string, partition int")
    seen = {r.topic: r.partitions for r in layout.observed_layout(records).collect()}
    assert seen == {"a": 2, "b": 1}
    declared = observed(spark, ("a", 4), ("c", 2))
    merged = {r.topic: r.partitions for r in layout.observed_layout(records, declared).collect()}
    assert merged == {"a": 4, "b": 1, "c": 2}
