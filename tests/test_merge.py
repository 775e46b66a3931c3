from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import apply_model
from tidemark.operators.changes import latest_changes
from tidemark.operators.merge import (
    delete_keys,
    merge_changes,
    merge_metrics,
    merge_plan,
    newer_than_applied,
    update_where,
    upsert,
)
from tidemark.operators.slices import replace_slices

TARGET = "k int, v string"
CHANGES = "k int, v string, change_type int, lsn decimal(38,0), seq string"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def merged(spark, target, changes, mode="ignore"):
    latest = latest_changes(spark.createDataFrame(changes, CHANGES), ["k"], ("lsn", "seq"))
    return merge_plan(spark.createDataFrame(target, TARGET), latest, ["k"], mode)


def change(k, v, kind, lsn, seq="0"):
    return (k, v, kind, None if lsn is None else Decimal(lsn), seq)


def test_truth_table(spark):
    target = [(1, "t1"), (2, "t2"), (3, "t3"), (4, "t4")]
    changes = [change(1, "s1", 1, 1), change(2, "s2", 2, 1), change(3, None, 4, 1)]
    changes += [change(11, "s11", 1, 1), change(12, "s12", 2, 1), change(13, "s13", 4, 1)]
    plan = merged(spark, target, changes)
    kept = plan.filter(F.col("_action").isin("keep", "update", "insert")).drop("_action")
    assert rows(kept) == rows(spark.createDataFrame([(2, "t2"), (3, None), (4, "t4"), (12, "s12"), (13, "s13")], TARGET))
    assert merge_metrics(plan).first().asDict() == {"inserted": 2, "updated": 1, "deleted": 1}
    actions = {r.k: r._action for r in plan.collect()}
    assert actions == {1: "delete", 2: "keep", 3: "update", 4: "keep", 11: "skip", 12: "insert", 13: "insert"}


def test_insert_over_existing_row_can_replace(spark):
    plan = merged(spark, [(2, "t2")], [change(2, "s2", 2, 1)], "update")
    assert [tuple(r) for r in plan.collect()] == [(2, "s2", "update")]
    with pytest.raises(ValueError):
        merged(spark, [], [], "whatever")


def test_newest_change(spark):
    changes = [
        change(1, "old", 4, 2**80),
        change(1, "new", 4, 2**80 + 1),
        change(1, "before", 3, 2**81),  # a before-image never wins
        change(2, "none", 4, None),
        change(2, "some", 4, 0),  # a missing number is last
        change(3, "a", 4, 5, "1"),
        change(3, "b", 4, 5, "2"),
        change(4, "odd", 7, 9),
    ]
    latest = latest_changes(spark.createDataFrame(changes, CHANGES), ["k"], ("lsn", "seq"))
    assert rows(latest.select("k", "v")) == [(1, "new"), (2, "some"), (3, "b")]


def test_null_keys_match_nothing(spark):
    target = [(None, "t"), (1, "x")]
    plan = merged(spark, target, [change(None, "s", 4, 1), change(1, "y", 4, 1)])
    assert rows(plan) == rows(
        spark.createDataFrame([(None, "t", "keep"), (None, "s", "insert"), (1, "y", "update")], "k int, v string, a string")
    )


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.integers(0, 8), st.sampled_from("ab"), max_size=6),
    st.lists(st.tuples(st.integers(0, 8), st.sampled_from([1, 2, 3, 4]), st.sampled_from("cde")), max_size=15),
    st.sampled_from(["ignore", "update"]),
)
def test_merge_agrees_with_the_model_and_is_idempotent(spark, target, events, mode):
    changes = [change(k, v, kind, lsn) for lsn, (k, kind, v) in enumerate(events)]
    model = apply_model(target, [(k, kind, lsn, v) for lsn, (k, kind, v) in enumerate(events)], mode)
    start = spark.createDataFrame(list(target.items()), TARGET)
    latest = latest_changes(spark.createDataFrame(changes[::-1], CHANGES), ["k"], ("lsn", "seq"))
    once = merge_changes(start, latest, ["k"], mode)
    assert rows(once) == sorted(model.items(), key=repr)
    assert rows(merge_changes(once, latest, ["k"], mode)) == sorted(model.items(), key=repr)


def test_upsert_modes(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, v string, w int")
    source = spark.createDataFrame([(2, None), (3, "c")], TARGET)
    assert rows(upsert(target, source, ["k"])) == [(1, "a", 1), (2, None, 2), (3, "c", None)]
    assert rows(upsert(target, source, ["k"], when_not_matched="ignore")) == [(1, "a", 1), (2, None, 2)]
    assert rows(upsert(target, source, ["k"], when_matched="ignore")) == [(1, "a", 1), (2, "b", 2), (3, "c", None)]
    assert upsert(target, source, ["k"], "ignore", "ignore") is target
    with pytest.raises(ValueError):
        upsert(target, source, ["k"], "replace")


def test_update_and_delete_leave_null_conditions_alone(spark):
    target = spark.createDataFrame([(1, "a"), (2, None)], TARGET)
    assert rows(update_where(target, F.col("v") == "a", {"v": F.lit("z")})) == [(1, "z"), (2, None)]
    assert rows(delete_keys(target, "v", ["a"])) == [(2, None)]
    assert rows(delete_keys(target, "v", spark.createDataFrame([("a",)], "v string"))) == [(2, None)]


def test_replaced_slices_may_end_up_empty(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "t string, k int")
    incoming = spark.createDataFrame([("a", 9), ("c", 8)], "t string, k int")
    slices = spark.createDataFrame([("a",), ("b",)], "t string")
    assert rows(replace_slices(target, incoming, "t", slices)) == [("a", 9), ("c", 3)]


def test_guard_keeps_only_newer_changes(spark):
    latest = spark.createDataFrame(
        [change(1, "same", 4, 5), change(2, "newer", 4, 6), change(3, "new key", 4, 1), change(4, "late", 4, None)], CHANGES
    )
    applied = spark.createDataFrame([(k, Decimal(5), "0") for k in (1, 2, 4)], "k int, lsn decimal(38,0), seq string")
    assert sorted(r.v for r in newer_than_applied(latest, applied, ["k"]).collect()) == ["new key", "newer"]


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    changes = spark.range(1000).select(
        F.when(F.col("id") < 600, 1).otherwise(F.col("id")).alias("k"), F.col("id").cast("decimal(38,0)").alias("lsn"), F.lit(4).alias("change_type")
    )
    plan = latest_changes(changes, ["k"], ("lsn",))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial"), "the group limit must run below the exchange as well"
