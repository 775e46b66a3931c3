"""Queries about what a run says of its files: empty ones, ones no load reports, and those of a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import feeds, files
from tidemark.operators.batches import file_batches
from tidemark.operators.manifest import MANIFEST_COLUMNS
from tidemark.operators.reports import audit_rows
from tidemark.plans.load import load_snapshot
from tidemark.plans.runs import run_delta_load, run_full_load
from tidemark.session import configure, scratch_path
from tidemark.sinks.logs import AuditLog, no_rows
from tidemark.sinks.tables import TargetTable
from tidemark.sources.listing import snapshot_files, take_listing
from tidemark.streaming.cdc import refused_log, start_cdc_merge

SPEC = files.SPEC


def _touch(spark, path: str) -> None:
    """A file of zero bytes, wherever the path is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(place, True).close()


def _folder(zone: str, tenant: str) -> str:
    return f"{zone}/LandingZone/{tenant}/Tables/{SPEC.source_id}/{files.FOLDER}"


def _by_client(audit):
    """Lines added up per client and kind of file, as the number of parts differs; FAILED if one of them is."""
    made = F.when(F.col("file_name").contains("empty"), "empty").otherwise("written")
    return audit.groupBy("client_id", F.split_part("file_name", F.lit("."), F.lit(-1)).alias("kind"), made.alias("file")).agg(
        F.min("load_status").alias("status"),
        F.sum("rows_loaded").cast("bigint").alias("rows_loaded"),
        F.sum("rows_rejected").cast("bigint").alias("rows_rejected"),
    )


def empty_files(spark, sf):
    """A broken snapshot file of zero bytes, a whole one of zero rows, and a change file of zero bytes beside the written ones."""
    configure(spark)
    zone, store = files.new_zone(spark), scratch_path(spark, "store")
    files.write_snapshots(spark, sf, zone)
    _touch(spark, f"{_folder(zone, 'client_1')}/FullCopyData/empty.parquet")
    files.snapshot_rows(spark, sf).drop("tenant").limit(0).coalesce(1).write.parquet(f"{_folder(zone, 'client_none')}/FullCopyData")
    full = run_full_load(spark, zone, store, run_ts=feeds.run_ts(), strict_state=False)
    files.write_changes(spark, sf, zone)
    _touch(spark, f"{_folder(zone, 'client_2')}/ChangeData/empty.csv")
    delta = run_delta_load(spark, zone, store, run_ts=feeds.run_ts())
    return _by_client(full.audit.unionByName(delta.audit))


def unreported_file(spark, sf):
    """A load that takes all clients but one, held against the whole manifest: the client left out comes back."""
    configure(spark)
    zone, store = files.new_zone(spark), scratch_path(spark, "store")
    files.write_snapshots(spark, sf, zone)
    manifest = snapshot_files(take_listing(spark, zone)).select(*MANIFEST_COLUMNS, "length")
    load = load_snapshot(spark, TargetTable(spark, store, SPEC), manifest.where("client_id <> 'client_3'"), "r")
    return _by_client(audit_rows(load.report, file_batches(manifest), feeds.run_ts(), "r"))


def stream_audit(spark, sf):
    """The change files as a stream, and a second time under the same name: nothing is added."""
    configure(spark)
    zone, store = files.new_zone(spark), scratch_path(spark, "store")
    files.write_changes(spark, sf, zone)
    target = TargetTable(spark, store, SPEC)
    pattern = f"{zone}/LandingZone/*/Tables/{SPEC.source_id}/{files.FOLDER}/ChangeData"
    for _ in range(2):  # an own checkpoint each, so the second run repeats the batch of the first
        start_cdc_merge(spark, target, pattern, scratch_path(spark, "stream"), stream="changes").awaitTermination()
    refused = refused_log(spark, target).read().groupBy("DATABASEPHYSICALNAME").agg(F.count("*").alias("rows_kept_aside"))
    lines = _by_client(AuditLog(spark, store).read())
    return lines.join(refused.withColumnRenamed("DATABASEPHYSICALNAME", "client_id"), "client_id", "left").drop("kind", "file")


def truncate_table(spark, sf):
    """A table filled and cleared, then given one client's snapshot: no other client has rows."""
    configure(spark)
    zone, store = files.new_zone(spark), scratch_path(spark, "store")
    files.write_snapshots(spark, sf, zone)
    run_full_load(spark, zone, store, run_ts=feeds.run_ts())
    target = TargetTable(spark, store, SPEC)
    target.truncate()
    manifest = snapshot_files(take_listing(spark, zone)).where("client_id = 'client_1'")
    load_snapshot(spark, target, manifest, "again")
    return target.read().select(F.col("DATABASEPHYSICALNAME").alias("tenant"), F.col("USERINFOISSALARYID").cast("bigint").alias("id"))


QUERIES = {
    "empty_files": empty_files,
    "unreported_file": unreported_file,
    "stream_audit": stream_audit,
    "truncate_table": truncate_table,
}

_SNAPSHOT = f"""{files.SNAPSHOT_SQL},
        whole AS (
          SELECT tenant AS client_id, 'parquet' AS kind, 'written' AS file, CASE WHEN count(ended) < count(*) THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                 count(ended) AS rows_loaded, count(*) - count(ended) AS rows_rejected FROM snapshot GROUP BY 1)"""
_CHANGES = f"""{files.CHANGES_SQL},
        taken AS (SELECT tenant, count(*) AS n FROM good GROUP BY tenant),
        changed AS (
          SELECT tenant AS client_id, 'csv' AS kind, 'written' AS file, CASE WHEN any_value(coalesce(n, 0)) < count(*) THEN 'FAILED' ELSE 'SUCCESS' END AS status,
                 any_value(coalesce(n, 0)) AS rows_loaded, count(*) - any_value(coalesce(n, 0)) AS rows_rejected
          FROM texts LEFT JOIN taken USING (tenant) GROUP BY tenant)"""
SQL = {
    "empty_files": f"""WITH {_SNAPSHOT},{_CHANGES}
        SELECT * FROM whole UNION ALL SELECT * FROM changed
        UNION ALL SELECT 'client_1', 'parquet', 'empty', 'FAILED', 0, 1
        UNION ALL SELECT 'client_none', 'parquet', 'written', 'SUCCESS', 0, 0
        UNION ALL SELECT 'client_2', 'csv', 'empty', 'SUCCESS', 0, 0""",
    "unreported_file": f"""WITH {_SNAPSHOT}
        SELECT * FROM whole WHERE client_id <> 'client_3' UNION ALL SELECT 'client_3', 'parquet', 'written', 'FAILED', 0, 0""",
    "stream_audit": f"""WITH {_CHANGES}
        SELECT client_id, status, rows_loaded, rows_rejected, nullif(rows_rejected, 0) AS rows_kept_aside FROM changed""",
    "truncate_table": f"WITH {files.SNAPSHOT_SQL} SELECT tenant, id FROM loaded WHERE tenant = 'client_1'",
}
