import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.paths import parse_paths
from tidemark.operators.batches import file_batches
from tidemark.operators.manifest import (
    delta_manifest,
    exclusion_reasons,
    full_manifest,
    latest_snapshot_files,
    listing_counts,
    manifest_counts,
)
from tidemark.operators.slices import clear_plan
from tidemark.operators.summary import completed_folders, delta_run_summary, full_load_state, full_run_summary, run_totals
from tidemark.sinks.logs import AuditLog, StateLog, no_rows

TIME = dt.datetime(2024, 1, 1)
REGISTRY = (
    "table_name string, source_table_id string, load_order int, is_active_full_load boolean, "
    "is_active_delta_load boolean, is_multi_tenant boolean"
)


def registry(spark):
    rows = [("ONE", "T-1", 10, True, True, True), ("TWO", "t-2", 20, True, False, True)]
    rows += [("OFF", "t-3", 30, False, True, True), ("SHARED", "t-4", 5, True, True, False)]
    return spark.createDataFrame(rows, REGISTRY)


def listing(spark, *files):
    """Files as (client, table, folder, name, hours)."""
    rows = [(f"/x/LandingZone/{c}/Tables/{t}/{f}/{n}", TIME + dt.timedelta(hours=h)) for c, t, f, n, h in files]
    return spark.createDataFrame(rows, "full_file_path string, last_modified timestamp")


def audit(spark, *lines):
    """Lines as (client, table, folder, name, status)."""
    rows = [(f"/x/LandingZone/{c}/Tables/{t}/{f}/{n}", s, t, 5, 1, "r") for c, t, f, n, s in lines]
    return spark.createDataFrame(
        rows, "full_stage_path string, load_status string, table_id string, rows_loaded int, load_id int, run_id string"
    )


def names(frame):
    return sorted((r.client_id, r.table_id, r.filename) for r in frame.collect())


FILES = [
    ("a", "T-1", "TableData_01", "old", 0),
    ("a", "T-1", "TableData_02", "new-0", 1),
    ("a", "T-1", "TableData_02", "new-1", 1),
    ("b", "t-1", "TableData_01", "b-0", 1),
    ("b", "t-2", "TableData_01", "b-2", 1),
    ("b", "t-3", "TableData_01", "off", 1),
    ("a", "t-4", "TableData_01", "shared-a", 1),
    ("b", "t-4", "TableData_01", "shared-b", 1),
    ("a", "t-9", "TableData_01", "unknown", 1),
    ("a", "T-1", "other", "no folder", 1),
]


def test_all_files_of_the_latest_folder(spark):
    got = names(latest_snapshot_files(parse_paths(listing(spark, *FILES))))
    assert ("a", "t-1", "new-0") in got and ("a", "t-1", "new-1") in got and ("a", "t-1", "old") not in got


def test_an_older_folder_never_stands_in(spark):
    done = audit(spark, *[("a", "T-1", "TableData_02", n, "SUCCESS") for n in ("new-0", "new-1")])
    got = names(full_manifest(listing(spark, *FILES), registry(spark), done))
    assert not [g for g in got if g[:2] == ("a", "t-1")]


def test_failed_files_come_back_alone_or_with_their_slice(spark):
    done = audit(
        spark,
        ("a", "T-1", "TableData_02", "new-0", "SUCCESS"),
        ("a", "T-1", "TableData_02", "new-1", "FAILED"),
        ("b", "t-1", "TableData_01", "b-0", "SUCCESS"),
        ("a", "t-4", "TableData_01", "shared-a", "SUCCESS"),
    )
    files, reg = listing(spark, *FILES), registry(spark)
    plain, whole = (names(full_manifest(files, reg, done, whole_slices=w)) for w in (False, True))
    assert plain == [("a", "t-1", "new-1"), ("b", "t-2", "b-2"), ("b", "t-4", "shared-b")]
    # A shared table is one slice over all clients.
    assert whole == sorted(plain + [("a", "t-1", "new-0"), ("a", "t-4", "shared-a")])


def test_scope(spark):
    files, reg, none = listing(spark, *FILES), registry(spark), audit(spark).limit(0)
    assert names(full_manifest(files, reg, none, clients="b , zz", tables="one,Shared")) == [("b", "t-1", "b-0"), ("b", "t-4", "shared-b")]
    assert names(full_manifest(files, reg, none, clients=["b"], tenant_tables_only=True)) == [("b", "t-1", "b-0"), ("b", "t-2", "b-2")]
    assert len(names(full_manifest(files, reg, none, clients=" , "))) == 6


def test_delta_gate(spark):
    state = spark.createDataFrame(
        [("a", "T-1", "TableData_02", TIME + dt.timedelta(hours=1))],
        "client_id string, table_id string, tabledata_folder string, full_load_last_modified timestamp",
    )
    files = listing(
        spark,
        ("a", "T-1", "TableData_02", "same time", 1),
        ("a", "T-1", "TableData_02", "newer", 2),
        ("a", "T-1", "TableData_02", "done", 3),
        ("a", "T-1", "TableData_01", "other folder", 4),
        ("b", "t-1", "TableData_02", "no state", 5),
    )
    done = audit(spark, ("a", "T-1", "TableData_02", "done", "SUCCESS"))
    assert names(delta_manifest(files, state, registry(spark), done)) == [("a", "t-1", "newer")]
    assert names(delta_manifest(files, state, registry(spark), done, clients="b")) == []


def test_counts_and_reasons(spark):
    files, reg = listing(spark, *FILES), registry(spark)
    done = audit(spark, ("b", "t-2", "TableData_01", "b-2", "SUCCESS"))
    manifest = full_manifest(files, reg, done, clients="b")
    assert manifest_counts(manifest).first().asDict() == {"files": 2, "clients": 1, "tables": 2}
    assert listing_counts(files, manifest).first().asDict() == {"files_listed": 10, "files_inserted": 2, "files_skipped": 8}
    reasons = {r.filename: r.reason for r in exclusion_reasons(files, reg, done, clients="b").collect()}
    assert reasons == {
        "old": "older folder",
        "new-0": "out of scope",
        "new-1": "out of scope",
        "b-0": "loaded now",
        "b-2": "already loaded",
        "off": "table not active",
        "shared-a": "out of scope",
        "shared-b": "loaded now",
        "unknown": "table not active",
        "no folder": "path not recognised",
    }


def test_clear_plan(spark):
    files, reg = listing(spark, *FILES), registry(spark)
    manifest = full_manifest(files, reg, audit(spark, ("b", "t-2", "TableData_01", "b-2", "SUCCESS")))
    plan = {r.table_name: (r.files, r.action) for r in clear_plan(reg, manifest).collect()}
    assert plan == {"SHARED": (2, "clear table"), "ONE": (3, "clear table"), "TWO": (0, "skip: no files")}
    scoped = {r.table_name: r.action for r in clear_plan(reg, manifest, clients="a", tables="one,shared").collect()}
    assert scoped == {"SHARED": "skip: not per tenant", "ONE": "delete tenants", "TWO": "skip: not asked for"}


def test_batches_number_every_file_once(spark):
    hot = [("a", "t-1", "TableData_01", f"f{i}", i % 3 * 24) for i in range(250)]
    cold = [("a", "t-2", "TableData_01", f"g{i}", 0) for i in range(7)]
    batched = file_batches(parse_paths(listing(spark, *hot, *cold)), size=100)
    sizes = {(r.table_id, r.batch_number): r["count"] for r in batched.groupBy("table_id", "batch_number").count().collect()}
    assert sizes == {("t-1", 1): 100, ("t-1", 2): 100, ("t-1", 3): 50, ("t-2", 1): 7}
    spans = batched.filter("table_id = 't-1'").groupBy("batch_number").agg(F.min("last_modified").alias("lo"), F.max("last_modified").alias("hi"))
    ordered = [(r.lo, r.hi) for r in spans.orderBy("batch_number").collect()]
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:])), "oldest first"


def test_state_summaries_and_logs(spark, tmp_path):
    files, reg = listing(spark, *FILES), registry(spark)
    manifest = full_manifest(files, reg, audit(spark).limit(0))
    lines = audit(
        spark,
        ("a", "T-1", "TableData_02", "new-0", "SUCCESS"),
        ("a", "T-1", "TableData_02", "new-1", "FAILED"),
        ("a", "T-1", "TableData_02", "new-1", "SUCCESS"),
        ("b", "t-2", "TableData_01", "b-2", "SUCCESS"),
        ("b", "t-2", "TableData_01", "elsewhere", "SUCCESS"),
    )
    full = {r.table_name: (int(r.rows_loaded), int(r.files_loaded), int(r.failed_files)) for r in full_run_summary(reg, lines, manifest).collect()}
    assert full == {"SHARED": (0, 0, 0), "ONE": (15, 3, 1), "TWO": (5, 1, 0)}
    delta = {r.table_name: (int(r.rows_affected), int(r.files_ok), int(r.files_failed)) for r in delta_run_summary(reg, lines, manifest).collect()}
    assert delta == {"SHARED": (0, 0, 0), "ONE": (10, 2, 1), "OFF": (0, 0, 0)}
    totals = run_totals(full_run_summary(reg, lines, manifest, run_id="other")).first()
    assert (totals.tables, int(totals.total_files_loaded)) == (3, 0)
    assert ("a", "t-1", "new-1") in names(completed_folders(manifest, lines))

    log = StateLog(spark, str(tmp_path))
    assert log.read().count() == 0
    for day in ("2024-01-01", "2024-01-02"):
        log.append(full_load_state(manifest, F.lit(day).cast("timestamp")))
    state = {(r.client_id, r.table_id): r for r in log.read().collect()}
    assert len(state) == 5 and state["a", "t-1"].full_load_file == "new-1"
    assert {r.state_updated_at.day for r in state.values()} == {2}
    assert AuditLog(spark, str(tmp_path)).read().isEmpty() and no_rows(spark, "a int").count() == 0
