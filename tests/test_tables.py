import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.helpers import apply_model, model_rows, record, table_rows
from tidemark.operators.changes import latest_changes
from tidemark.registry import define_table
from tidemark.sinks.scratch import materialize
from tidemark.sinks.tables import RANGE_COLUMN, TargetTable

SPEC = define_table(
    "T",
    "t",
    1,
    (("TID", "decimal(38,0)", None, False, 5), ("Amount", "decimal(18,2)", None, False, 6), ("Note", "string", 10, False, 7)),
    ids_per_range=10,
)
SHARED = define_table(
    "S", "s", 1, (("TID", "decimal(38,0)", None, False, 5), ("Note", "string", 10, False, 6)), multi_tenant=False, ids_per_range=10
)


def frame(spark, spec, rows):
    return spark.createDataFrame([tuple(r[c] for c in spec.column_names) for r in rows], spec.schema)


def load(spark, target, rows, run, tenants=None):
    names = None if tenants is None else spark.createDataFrame([(t,) for t in tenants], "DATABASEPHYSICALNAME string")
    target.replace_slices(frame(spark, target.spec, rows).withColumn("_file", F.lit(f"file-{run}")), run, names)


def merge(spark, target, changes, mode="ignore"):
    """``changes``: (row, kind, lsn)."""
    spec = target.spec
    rows = [tuple(r[c] for c in spec.column_names) + (Decimal(kind), Decimal(lsn), "0") for r, kind, lsn in changes]
    schema = ", ".join(f"{c.name} {c.type}" for c in spec.columns)
    feed = spark.createDataFrame(rows, f"{schema}, change_type decimal(38,0), lsn decimal(38,0), seq string")
    latest = latest_changes(feed, list(spec.keys), ("lsn", "seq"))
    return target.merge(materialize(spark, target.with_range(latest), "latest"), mode).first().asDict()


def partitions(target):
    return {tuple(r) for r in target.read_stored().select(*target.partitions).distinct().collect()}


def test_merge_rewrites_only_partitions_with_an_effect(spark, tmp_path):
    target = TargetTable(spark, str(tmp_path), SPEC)
    rows = {("a", k): record(SPEC, k, 1, "a") for k in (1, 2, 11, 21)} | {("b", 1): record(SPEC, 1, 1, "b")}
    load(spark, target, rows.values(), "r1", ["a", "b"])
    assert partitions(target) == {("a", "0"), ("a", "1"), ("a", "2"), ("b", "0")}

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(target.path) for f in names if f.endswith(".parquet")}

    before = files()
    changes = [(record(SPEC, 1, 2, "a"), 4, 1), (record(SPEC, 11, 2, "a"), 2, 2), (record(SPEC, 31, 2, "a"), 1, 3)]
    changes += [(record(SPEC, 2, 2, "a"), 1, 4), (record(SPEC, 41, 2, "a"), 2, 5)]
    assert merge(spark, target, changes) == {"inserted": 1, "updated": 1, "deleted": 1}
    model = apply_model(rows, [((r["DATABASEPHYSICALNAME"], int(r["TID"])), k, n, r) for r, k, n in changes])
    assert table_rows(target.read(), SPEC) == model_rows(model.values(), SPEC)
    gone = {os.path.relpath(os.path.dirname(f), target.path) for f in before - files()}
    assert gone == {"DATABASEPHYSICALNAME=a/key_range=0"}, "ranges 1 (kept row) and 2, and tenant b, are not rewritten"


def test_a_partition_can_become_empty_and_fill_again(spark, tmp_path):
    target = TargetTable(spark, str(tmp_path), SPEC)
    load(spark, target, [record(SPEC, 1, 1, "a"), record(SPEC, 2, 1, "a"), record(SPEC, 11, 1, "a")], "r1", ["a"])
    deletes = [(record(SPEC, k, 1, "a"), 1, k) for k in (1, 2)]
    assert merge(spark, target, deletes)["deleted"] == 2
    assert [int(r.TID) for r in target.read().collect()] == [11]
    assert merge(spark, target, deletes) == {"inserted": 0, "updated": 0, "deleted": 0}
    assert merge(spark, target, [(record(SPEC, 2, 5, "a"), 4, 9)])["inserted"] == 1
    assert table_rows(target.read(), SPEC) == model_rows([record(SPEC, 2, 5, "a"), record(SPEC, 11, 1, "a")], SPEC)


def test_slices_are_replaced_whole(spark, tmp_path):
    target = TargetTable(spark, str(tmp_path), SPEC)
    load(spark, target, [record(SPEC, k, 1, t) for t in "abc" for k in (1, 11)], "r1", ["a", "b", "c"])
    load(spark, target, [record(SPEC, 25, 2, "a")], "r2", ["a", "b"])
    want = [record(SPEC, 25, 2, "a")] + [record(SPEC, k, 1, "c") for k in (1, 11)]
    assert table_rows(target.read(), SPEC) == model_rows(want, SPEC)
    counts = {(r._file, r.rows_loaded) for r in target.loaded_counts("r2").collect()}
    assert counts == {("file-r2", 1)}
    target.truncate()
    assert target.read().count() == 0


def test_shared_table_is_one_slice(spark, tmp_path):
    target = TargetTable(spark, str(tmp_path), SHARED)
    assert target.partitions == [RANGE_COLUMN]
    load(spark, target, [record(SHARED, k, 1) for k in (1, 11, 21)], "r1")
    load(spark, target, [record(SHARED, 5, 2)], "r2")
    assert table_rows(target.read(), SHARED) == model_rows([record(SHARED, 5, 2)], SHARED)


def test_merge_into_a_table_that_does_not_exist(spark, tmp_path):
    target = TargetTable(spark, str(tmp_path), SPEC)
    assert target.read().count() == 0
    changes = [(record(SPEC, 1, 1, "a"), 4, 1), (record(SPEC, 2, 1, "a"), 1, 2)]
    assert merge(spark, target, changes) == {"inserted": 1, "updated": 0, "deleted": 0}
    assert table_rows(target.read(), SPEC) == model_rows([record(SPEC, 1, 1, "a")], SPEC)


@pytest.mark.parametrize("tenant", ["007", "a b", "x=y%z", "1e5", "null"])
def test_odd_tenant_names_survive_as_partitions(spark, tmp_path, tenant):
    target = TargetTable(spark, str(tmp_path), SPEC)
    load(spark, target, [record(SPEC, 1, 1, tenant)], "r1", [tenant])
    assert merge(spark, target, [(record(SPEC, 1, 2, tenant), 4, 1)])["updated"] == 1
    assert table_rows(target.read(), SPEC) == model_rows([record(SPEC, 1, 2, tenant)], SPEC)


def test_target_scan_is_pruned_to_touched_partitions(spark, tmp_path):
    target = TargetTable(spark, str(tmp_path), SPEC)
    load(spark, target, [record(SPEC, k, 1, "a") for k in range(30)], "r1", ["a"])
    touched = materialize(spark, spark.createDataFrame([("a", "1")], "DATABASEPHYSICALNAME string, key_range string"), "t")
    plan = target.read_stored().join(touched.filter("key_range in ('1', '9')"), target.partitions, "left_semi")
    assert "dynamicpruning" in plan._jdf.queryExecution().executedPlan().toString()
