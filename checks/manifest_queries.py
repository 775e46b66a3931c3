"""Paths, listings, manifests, batches, state and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import feeds
from tidemark.functions.paths import listing_time, parse_paths
from tidemark.functions.values import list_items
from tidemark.operators.batches import file_batches
from tidemark.operators.manifest import (
    delta_manifest,
    exclusion_reasons,
    full_manifest,
    in_scope,
    latest_snapshot_files,
    listing_counts,
    located,
    manifest_counts,
    unprocessed_files,
)
from tidemark.operators.merge import upsert
from tidemark.operators.slices import clear_plan
from tidemark.operators.summary import delta_run_summary, full_load_state, full_run_summary, run_totals
from tidemark.registry import TABLES, registry_frame
from tidemark.sources.listing import change_files, snapshot_files

# Fixed arguments of the scoped queries.
CLIENTS = " client_1, client_2 ,,client_7"
SCOPED_TABLES = "nation_1, NATION_2,nation_12 ,"
_CLIENTS_SQL = "('client_1', 'client_2', 'client_7')"
_TABLES_SQL = "('NATION_1', 'NATION_2', 'NATION_12')"


def _plain_time(frame, *columns):
    return frame.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def path_parse(spark, sf):
    return _plain_time(parse_paths(feeds.listing(spark, sf)), "last_modified")


def rfc1123_parse(spark, sf):
    rows = feeds.listing(spark, sf)
    return rows.select("last_modified", listing_time(F.col("last_modified")).cast("timestamp_ntz").alias("parsed"))


def _both_listings(spark, sf):
    return feeds.listing(spark, sf).unionByName(feeds.listing(spark, sf, feeds.CHANGE_PATH))


def list_full_files(spark, sf):
    return snapshot_files(_both_listings(spark, sf))


def list_delta_files(spark, sf):
    return change_files(_both_listings(spark, sf))


def scope_filter(spark, sf):
    files = located(parse_paths(feeds.listing(spark, sf)))
    scoped = in_scope(files, feeds.registry(spark, sf), CLIENTS, SCOPED_TABLES)
    asked = F.array_join(list_items(F.lit(SCOPED_TABLES), upper=True), "|")
    return scoped.select("full_file_path", "client_id", "table_id", asked.alias("asked_for"))


def latest_snapshots(spark, sf):
    files = latest_snapshot_files(parse_paths(feeds.listing(spark, sf)))
    return files.select("full_file_path", "client_id", "table_id", "tabledata_folder")


def unprocessed(spark, sf):
    files = parse_paths(feeds.listing(spark, sf))
    return unprocessed_files(files, feeds.audit(spark, sf)).select("full_file_path", "client_id", "table_id")


def _manifest(spark, sf, **scope):
    return full_manifest(
        snapshot_files(feeds.listing(spark, sf)), feeds.registry(spark, sf), feeds.audit(spark, sf), **scope
    )


def manifest(spark, sf):
    return _plain_time(_manifest(spark, sf), "last_modified")


def manifest_whole_slices(spark, sf):
    whole = _manifest(spark, sf, clients=CLIENTS, whole_slices=True, tenant_tables_only=True)
    return _plain_time(whole, "last_modified")


def _state(spark, sf):
    """State from the latest folders, with the oldest file's time, so part of the change files are newer."""
    files = latest_snapshot_files(parse_paths(feeds.listing(spark, sf)))
    return files.groupBy("client_id", "table_id").agg(
        F.max("tabledata_folder").alias("tabledata_folder"), F.min("last_modified").alias("full_load_last_modified")
    )


def _delta_manifest(spark, sf):
    return delta_manifest(
        change_files(feeds.listing(spark, sf, feeds.CHANGE_PATH)),
        _state(spark, sf),
        feeds.registry(spark, sf),
        feeds.audit(spark, sf, feeds.CHANGE_PATH),
    )


def deltas(spark, sf):
    return _plain_time(_delta_manifest(spark, sf), "last_modified")


def counts(spark, sf):
    listing = feeds.listing(spark, sf)
    taken = _manifest(spark, sf)
    one = F.lit(1).alias("_one")
    return (
        manifest_counts(taken).select("*", one).join(listing_counts(listing, taken).select("*", one), "_one").drop("_one")
    )


def exclusions(spark, sf):
    rows = exclusion_reasons(
        feeds.listing(spark, sf), feeds.registry(spark, sf), feeds.audit(spark, sf), CLIENTS, None
    )
    return rows.groupBy("reason").agg(F.count("*").alias("files"))


def clear(spark, sf):
    plan = clear_plan(feeds.registry(spark, sf), _manifest(spark, sf), CLIENTS, None)
    return plan.withColumn("load_order", F.col("load_order").cast("int"))


def batches(spark, sf):
    files = parse_paths(feeds.listing(spark, sf)).filter(F.col("table_id").isNotNull())
    return file_batches(files, size=50).select("table_id", "full_file_path", "batch_number")


def table_registry(spark, sf):
    """Files per registered table: orders spread over the 15 real tables."""
    orders = feeds.load(spark, sf, "orders")
    files = orders.select((F.col("o_orderkey") % len(TABLES)).alias("n")).groupBy("n").agg(F.count("*").alias("files"))
    numbered = registry_frame(spark).withColumn(
        "n",
        F.array_position(F.array(*[F.lit(t.name) for t in TABLES]), F.col("table_name")) - 1,
    )
    return numbered.join(files, "n").select(
        "table_name", "source_table_id", F.col("load_order").cast("int").alias("load_order"), "is_multi_tenant", "files"
    )


def _registry_values() -> str:
    return ",\n".join(
        f"({i}, '{t.name}', '{t.source_id}', {t.load_order}, {str(t.multi_tenant).lower()})" for i, t in enumerate(TABLES)
    )


def load_state(spark, sf):
    state = full_load_state(_manifest(spark, sf), feeds.run_ts())
    return _plain_time(state, "full_load_last_modified")


def state_upsert(spark, sf):
    """Old state: every client and table ever listed, at their oldest folder; new state: the manifest's."""
    files = located(parse_paths(feeds.listing(spark, sf)))
    old = files.groupBy("client_id", "table_id").agg(
        F.min("tabledata_folder").alias("tabledata_folder"),
        F.min("filename").alias("full_load_file"),
        F.min("last_modified").alias("full_load_last_modified"),
    )
    new = full_load_state(_manifest(spark, sf), feeds.run_ts()).drop("state_updated_at")
    return _plain_time(upsert(old, new, ["client_id", "table_id"]), "full_load_last_modified")


def _as_long(frame, *columns):
    return frame.withColumns({c: F.col(c).cast("bigint") for c in columns})


def _summary(spark, sf):
    whole = located(parse_paths(feeds.listing(spark, sf)))
    return full_run_summary(feeds.registry(spark, sf), feeds.audit(spark, sf), whole)


def full_summary(spark, sf):
    return _as_long(_summary(spark, sf), "load_order", "rows_loaded", "files_loaded", "failed_files")


def delta_summary(spark, sf):
    summary = delta_run_summary(
        feeds.registry(spark, sf), feeds.audit(spark, sf, feeds.CHANGE_PATH), _delta_listing(spark, sf)
    )
    return _as_long(summary, "load_order", "rows_affected", "files_ok", "files_failed")


def _delta_listing(spark, sf):
    return located(parse_paths(feeds.listing(spark, sf, feeds.CHANGE_PATH)))


def totals(spark, sf):
    return _as_long(run_totals(_summary(spark, sf)), "tables", "total_rows_loaded", "total_files_loaded", "total_failed_files")


QUERIES = {
    "path_parse": path_parse,
    "rfc1123_parse": rfc1123_parse,
    "list_full_files": list_full_files,
    "list_delta_files": list_delta_files,
    "scope_filter": scope_filter,
    "latest_snapshot_files": latest_snapshots,
    "unprocessed_files": unprocessed,
    "full_manifest": manifest,
    "full_manifest_slices": manifest_whole_slices,
    "full_load_state": load_state,
    "delta_manifest": deltas,
    "manifest_counts": counts,
    "exclusion_reasons": exclusions,
    "clear_plan": clear,
    "file_batches": batches,
    "table_registry": table_registry,
    "state_upsert": state_upsert,
    "full_run_summary": full_summary,
    "delta_run_summary": delta_summary,
    "run_totals": totals,
}

_SUMMARY_SQL = f"""{feeds.PARSED_SQL},{feeds.REGISTRY_SQL},{feeds.AUDIT_SQL},
summary AS (
  SELECT r.table_name, r.load_order::BIGINT AS load_order,
         sum(coalesce(a.rows_loaded, 0))::BIGINT AS rows_loaded, count(a.load_id)::BIGINT AS files_loaded,
         sum(CASE WHEN a.load_status = 'FAILED' THEN 1 ELSE 0 END)::BIGINT AS failed_files
  FROM registry r
  LEFT JOIN (SELECT * FROM audit WHERE full_stage_path IN (
               SELECT full_file_path FROM parsed
               WHERE client_id IS NOT NULL AND table_id IS NOT NULL AND tabledata_folder IS NOT NULL)) a
    ON upper(a.table_id) = upper(r.source_table_id) AND a.load_status IN ('SUCCESS', 'FAILED')
  WHERE r.is_active_full_load GROUP BY 1, 2)"""

SQL = {
    "path_parse": f"WITH {feeds.PARSED_SQL} SELECT * FROM parsed",
    "rfc1123_parse": f"WITH {feeds.LISTING_SQL} SELECT last_modified, strptime(substr(last_modified, 6, 20), '%d %b %Y %H:%M:%S') AS parsed FROM listing",
    "list_full_files": f"WITH {feeds.LISTING_SQL} SELECT * FROM listing",
    "list_delta_files": f"WITH {feeds._listing_sql('listing', feeds.CHANGE_PATH)} SELECT * FROM listing",
    "scope_filter": f"""WITH {feeds.PARSED_SQL},{feeds.REGISTRY_SQL}
        SELECT full_file_path, client_id, table_id, 'NATION_1|NATION_2|NATION_12' AS asked_for FROM parsed
        WHERE client_id IN {_CLIENTS_SQL} AND tabledata_folder IS NOT NULL
          AND upper(table_id) IN (SELECT upper(source_table_id) FROM registry WHERE upper(table_name) IN {_TABLES_SQL})""",
    "latest_snapshot_files": f"""WITH {feeds.PARSED_SQL},{feeds.LATEST_SQL}
        SELECT full_file_path, client_id, table_id, tabledata_folder FROM latest_files""",
    "unprocessed_files": f"""WITH {feeds.PARSED_SQL},{feeds.AUDIT_SQL}
        SELECT full_file_path, client_id, table_id FROM parsed
        WHERE full_file_path NOT IN (SELECT full_stage_path FROM audit WHERE load_status = 'SUCCESS')""",
    "full_manifest": f"WITH {feeds.MANIFEST_SQL} SELECT * FROM manifest",
    "full_manifest_slices": f"""WITH {feeds.PARSED_SQL},{feeds.REGISTRY_SQL},{feeds.AUDIT_SQL},{feeds.LATEST_SQL},
        files AS (
          SELECT f.* FROM latest_files f
          JOIN registry r ON upper(r.source_table_id) = upper(f.table_id) AND r.is_active_full_load AND r.is_multi_tenant
          WHERE f.client_id IN {_CLIENTS_SQL}),
        pending AS (
          SELECT DISTINCT client_id, table_id FROM files
          WHERE full_file_path NOT IN (SELECT full_stage_path FROM audit WHERE load_status = 'SUCCESS'))
        SELECT full_file_path, client_id, table_id, tabledata_folder, filename, last_modified
        FROM files JOIN pending USING (client_id, table_id)""",
    "full_load_state": f"""WITH {feeds.MANIFEST_SQL}
        SELECT client_id, table_id, max(tabledata_folder) AS tabledata_folder, max(filename) AS full_load_file,
               max(last_modified) AS full_load_last_modified, TIMESTAMP '{feeds.RUN_TS}' AS state_updated_at
        FROM manifest GROUP BY client_id, table_id""",
    "delta_manifest": f"""WITH {feeds.PARSED_SQL},{feeds.CHANGE_PARSED_SQL},{feeds.REGISTRY_SQL},
        {feeds.CHANGE_AUDIT_SQL},{feeds.LATEST_SQL},{feeds.STATE_SQL}
        SELECT c.full_file_path, c.client_id, c.table_id, c.tabledata_folder, c.filename, c.last_modified
        FROM change_parsed c
        JOIN state s ON s.client_id = c.client_id AND s.table_id = c.table_id
        JOIN registry r ON upper(r.source_table_id) = upper(c.table_id) AND r.is_active_delta_load
        WHERE c.tabledata_folder = s.tabledata_folder AND c.last_modified > s.full_load_last_modified
          AND NOT EXISTS (SELECT 1 FROM change_audit a
                          WHERE a.full_stage_path = c.full_file_path AND a.load_status = 'SUCCESS')""",
    "manifest_counts": f"""WITH {feeds.MANIFEST_SQL}
        SELECT count(*) AS files, count(DISTINCT client_id) AS clients, count(DISTINCT table_id) AS tables,
               (SELECT count(*) FROM listing) AS files_listed, count(*) AS files_inserted,
               (SELECT count(*) FROM listing) - count(*) AS files_skipped
        FROM manifest""",
    "exclusion_reasons": f"""WITH {feeds.PARSED_SQL},{feeds.REGISTRY_SQL},{feeds.AUDIT_SQL},{feeds.LATEST_SQL}
        SELECT CASE
                 WHEN client_id IS NULL OR table_id IS NULL OR tabledata_folder IS NULL THEN 'path not recognised'
                 WHEN full_file_path NOT IN (SELECT full_file_path FROM latest_files) THEN 'older folder'
                 WHEN upper(table_id) NOT IN (SELECT source_table_id FROM registry WHERE is_active_full_load) THEN 'table not active'
                 WHEN client_id NOT IN {_CLIENTS_SQL} THEN 'out of scope'
                 WHEN full_file_path IN (SELECT full_stage_path FROM audit WHERE load_status = 'SUCCESS') THEN 'already loaded'
                 ELSE 'loaded now' END AS reason, count(*) AS files
        FROM parsed GROUP BY 1""",
    "clear_plan": f"""WITH {feeds.MANIFEST_SQL},
        n AS (SELECT upper(table_id) AS id, count(*) AS files FROM manifest WHERE client_id IN {_CLIENTS_SQL} GROUP BY 1)
        SELECT r.load_order::INTEGER AS load_order, r.table_name, coalesce(n.files, 0) AS files,
               CASE WHEN NOT r.is_multi_tenant THEN 'skip: not per tenant'
                    WHEN coalesce(n.files, 0) = 0 THEN 'skip: no files' ELSE 'delete tenants' END AS action
        FROM registry r LEFT JOIN n ON n.id = upper(r.source_table_id) WHERE r.is_active_full_load""",
    "file_batches": f"""WITH {feeds.PARSED_SQL}
        SELECT table_id, full_file_path, ((row_number() OVER (
                 PARTITION BY table_id
                 ORDER BY last_modified NULLS FIRST, full_file_path) - 1) // 50 + 1)::BIGINT AS batch_number
        FROM parsed WHERE table_id IS NOT NULL""",
    "table_registry": f"""WITH r(n, table_name, source_table_id, load_order, is_multi_tenant) AS (VALUES {_registry_values()})
        SELECT r.table_name, r.source_table_id, r.load_order, r.is_multi_tenant, count(*) AS files
        FROM r JOIN orders ON o_orderkey % {len(TABLES)} = r.n GROUP BY ALL""",
    "state_upsert": f"""WITH {feeds.MANIFEST_SQL},
        old AS (
          SELECT client_id, table_id, min(tabledata_folder) AS tabledata_folder, min(filename) AS full_load_file,
                 min(last_modified) AS full_load_last_modified
          FROM parsed WHERE tabledata_folder IS NOT NULL GROUP BY 1, 2),
        new AS (
          SELECT client_id, table_id, max(tabledata_folder) AS tabledata_folder, max(filename) AS full_load_file,
                 max(last_modified) AS full_load_last_modified
          FROM manifest GROUP BY 1, 2)
        SELECT * FROM new
        UNION ALL
        SELECT * FROM old WHERE (client_id, table_id) NOT IN (SELECT (client_id, table_id) FROM new)""",
    "full_run_summary": f"WITH {_SUMMARY_SQL} SELECT * FROM summary",
    "delta_run_summary": f"""WITH {feeds.CHANGE_PARSED_SQL},{feeds.REGISTRY_SQL},{feeds.CHANGE_AUDIT_SQL}
        SELECT r.table_name, r.load_order::BIGINT AS load_order,
               sum(CASE WHEN a.load_status = 'SUCCESS' THEN a.rows_loaded ELSE 0 END)::BIGINT AS rows_affected,
               count(CASE WHEN a.load_status = 'SUCCESS' THEN 1 END) AS files_ok,
               count(CASE WHEN a.load_status = 'FAILED' THEN 1 END) AS files_failed
        FROM registry r
        LEFT JOIN (SELECT * FROM change_audit WHERE full_stage_path IN (
                     SELECT full_file_path FROM change_parsed WHERE tabledata_folder IS NOT NULL)) a
          ON upper(a.table_id) = upper(r.source_table_id)
        WHERE r.is_active_delta_load GROUP BY 1, 2""",
    "run_totals": f"""WITH {_SUMMARY_SQL}
        SELECT count(*) AS tables, sum(rows_loaded)::BIGINT AS total_rows_loaded,
               sum(files_loaded)::BIGINT AS total_files_loaded, sum(failed_files)::BIGINT AS total_failed_files
        FROM summary""",
}
