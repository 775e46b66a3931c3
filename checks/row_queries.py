"""Typed projection, rejects, reports and audit over dirty text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import feeds
from tidemark.functions.values import csv_field, soft_cast
from tidemark.operators.batches import file_batches
from tidemark.operators.manifest import located
from tidemark.functions.paths import parse_paths
from tidemark.operators.reports import audit_rows, file_load_report, report_totals
from tidemark.operators.rows import accepted, constraint_report, project_changes, project_snapshot, rejected
from tidemark.registry import define_table

# A table shaped like the registry's, for text made from lineitem.
LINES = define_table(
    "LINES",
    "lines",
    1,
    (
        ("OrderID", "decimal(38,0)", None, False, 5),
        ("PartID", "decimal(38,0)", None, False, 6),
        ("LineNo", "decimal(38,0)", None, False, 7),
        ("Quantity", "decimal(18,2)", None, False, 8),
        ("Flag", "boolean", None, False, 9),
        ("SeenDate", "timestamp_ntz", None, False, 10),
        ("Note", "string", 2, False, 11),
    ),
    multi_tenant=False,
)


def _text(name):
    return F.col(name).cast("string")


def _raw_lines(spark, sf):
    """Dirty lines as the reader hands them over: text columns, file and row position."""
    return feeds.dirty_lines(spark, sf).select(
        _text("l_orderkey").alias("ORDERID"),
        _text("l_partkey").alias("PARTID"),
        _text("l_linenumber").alias("LINENO"),
        F.col("number_text").alias("QUANTITY"),
        F.col("flag_text").alias("FLAG"),
        F.col("time_text").alias("SEENDATE"),
        F.when(F.col("l_linenumber") == 5, F.repeat("l_returnflag", F.lit(3))).otherwise(F.col("l_returnflag")).alias("NOTE"),
        "_file",
        F.struct("l_orderkey", "l_linenumber", "l_partkey").alias("_row"),
        F.col("l_returnflag").alias("_flag"),
    )


def typed_cast(spark, sf):
    lines = feeds.dirty_lines(spark, sf)

    def cast(name, kind):
        return F.expr(soft_cast(name, "string", kind))

    return lines.select(
        "l_orderkey",
        "number_text",
        "flag_text",
        cast("number_text", "decimal(38,0)").cast("bigint").alias("whole"),
        (cast("number_text", "decimal(18,2)") * 100).cast("bigint").alias("hundredths"),
        cast("flag_text", "boolean").alias("flag"),
        (F.col("number_text").isNotNull() & cast("number_text", "decimal(38,0)").isNull()).alias("number_refused"),
    )


def try_timestamp(spark, sf):
    lines = feeds.dirty_lines(spark, sf)
    return lines.select("l_orderkey", "time_text", F.expr(soft_cast("time_text", "string", "timestamp_ntz")).alias("at"))


def csv_null_rules(spark, sf):
    """The reader gives NULL for an unquoted empty field; here line 2 keeps it quoted, and short rows end before it."""
    lines = feeds.dirty_lines(spark, sf)
    raw = F.when(F.col("l_linenumber") == 2, F.col("number_text")).otherwise(F.nullif("number_text", F.lit("")))
    return lines.withColumn("raw", raw).select(
        "l_orderkey",
        "l_linenumber",
        F.expr(csv_field("raw")).alias("number_field"),
        F.expr(csv_field("flag_text")).alias("flag_field"),
        F.expr(csv_field("raw", "l_linenumber > 5")).alias("short_row_field"),
    )


def reject_rows(spark, sf):
    rows = project_snapshot(_raw_lines(spark, sf), LINES)
    return rejected(rows).groupBy("_reject").agg(F.count("*").alias("n_rows"), F.count_distinct("_file").alias("n_files"))


def accept_rows(spark, sf):
    rows = accepted(project_snapshot(_raw_lines(spark, sf), LINES))
    return rows.select(
        F.col("ORDERID").cast("bigint").alias("order_id"),
        F.col("PARTID").cast("bigint").alias("part_id"),
        (F.col("QUANTITY") * 100).cast("bigint").alias("hundredths"),
        F.col("FLAG").alias("flag"),
        F.col("SEENDATE").alias("seen"),
        F.col("NOTE").alias("note"),
    )


def change_rejects(spark, sf):
    """The same text as change rows: NULL words are NULL, and what is refused depends on the change type."""
    raw = _raw_lines(spark, sf)
    fields = {c.name: F.expr(csv_field(c.name)) for c in LINES.columns}
    kind = F.when(F.col("_flag") == "A", "4").when(F.col("_flag") == "N", "1").otherwise("3")
    changes = raw.withColumns(
        fields
        | {
            "_type_text": F.when(F.col("PARTID") % 11 == 0, "?").otherwise(kind),
            "_lsn_text": F.when(F.col("PARTID") % 13 == 0, "0xZZ").otherwise(F.concat(F.lit("0x"), F.hex(F.col("PARTID").cast("bigint")))),
            "_seq": F.lit("0"),
        }
    )
    rows = project_changes(changes, LINES)
    return rows.groupBy(
        F.coalesce("_reject", F.lit("accepted")).alias("outcome"), F.col("change_type").cast("int").alias("change_type")
    ).agg(F.count("*").alias("n_rows"))


def _report(spark, sf):
    return file_load_report(project_snapshot(_raw_lines(spark, sf), LINES))


def load_report(spark, sf):
    return _report(spark, sf).withColumnRenamed("_file", "file_name")


def load_totals(spark, sf):
    return report_totals(_report(spark, sf))


def constraints(spark, sf):
    """Violations in the projected rows, rejects included."""
    return constraint_report(project_snapshot(_raw_lines(spark, sf), LINES), LINES)


def _supplier_files(spark, sf):
    """A manifest with a file per supplier, on top one nobody reported."""
    path = F.expr(
        "concat('/stage/LandingZone/client_', s_nationkey, '/Tables/tbl-', s_suppkey % 3, '/TableData_a/ChangeData/supp_', s_suppkey + 5, '.csv')"
    )
    suppliers = feeds.load(spark, sf, "supplier")
    files = suppliers.select(path.alias("full_file_path"), F.lit(feeds.RUN_TS).cast("timestamp").alias("last_modified"))
    return located(parse_paths(files))


def audit(spark, sf):
    """Reports of suppliers' files; those of five suppliers are not in the manifest, five manifest files hold no rows."""
    files = _supplier_files(spark, sf)
    paths = files.select(F.regexp_extract("filename", "^(supp_[0-9]+)", 1).alias("_short"), "relative_path")
    report = _report(spark, sf).join(paths, F.col("_file") == F.col("_short"), "left")
    report = report.withColumn("_file", F.coalesce("relative_path", F.col("_file"))).drop("_short", "relative_path")
    lines = audit_rows(report, file_batches(files, size=10), feeds.run_ts(), "run-1", unreported="SUCCESS")
    return lines.select(
        "file_name",
        "client_id",
        "table_id",
        F.col("rows_loaded").cast("bigint").alias("rows_loaded"),
        "file_load_timestamp",
        F.col("batch_number").cast("bigint").alias("batch_number"),
        "load_status",
        "error_message",
        "full_stage_path",
        F.col("rows_rejected").cast("bigint").alias("rows_rejected"),
        F.col("load_id").isNotNull().alias("has_id"),
    )


QUERIES = {
    "typed_cast": typed_cast,
    "try_timestamp": try_timestamp,
    "csv_null_rules": csv_null_rules,
    "reject_rows": reject_rows,
    "accept_rows": accept_rows,
    "change_rejects": change_rejects,
    "file_load_report": load_report,
    "load_totals": load_totals,
    "constraint_report": constraints,
    "audit_rows": audit,
}

_FLAG_SQL = """CASE WHEN lower(flag_text) IN ('on', 'y', '1') THEN true WHEN lower(flag_text) IN ('off', 'false') THEN false END"""
_NOTE_SQL = "CASE WHEN l_linenumber = 5 THEN repeat(l_returnflag, 3) ELSE l_returnflag END"
_TYPED_SQL = f"""{feeds.DIRTY_SQL},
typed AS (
  SELECT *, try_cast(number_text AS DECIMAL(18,2)) AS quantity, {_FLAG_SQL} AS flag,
         try_cast(time_text AS TIMESTAMP) AS seen, {_NOTE_SQL} AS note
  FROM dirty),
judged AS (
  SELECT *, CASE WHEN quantity IS NULL THEN 'QUANTITY: not a decimal(18,2)' WHEN flag IS NULL THEN 'FLAG: not a boolean'
                 WHEN seen IS NULL THEN 'SEENDATE: not a timestamp_ntz'
                 WHEN length(note) > 2 THEN 'NOTE: longer than 2' END AS reject
  FROM typed)"""
_REPORT_SQL = f"""{_TYPED_SQL},
report AS (
  SELECT _file, count(*) AS rows_parsed, count(*) FILTER (reject IS NULL) AS rows_loaded,
         count(*) FILTER (reject IS NOT NULL) AS errors_seen,
         arg_min(reject, (l_orderkey, l_linenumber, l_partkey)) FILTER (reject IS NOT NULL) AS first_error
  FROM judged GROUP BY _file),
statused AS (
  SELECT *, CASE WHEN errors_seen = 0 THEN 'LOADED' WHEN rows_loaded > 0 THEN 'PARTIALLY_LOADED' ELSE 'LOAD_FAILED' END AS status,
         CASE WHEN errors_seen = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS load_status
  FROM report)"""

SQL = {
    "typed_cast": f"""WITH {feeds.DIRTY_SQL}
        SELECT l_orderkey, number_text, flag_text, try_cast(number_text AS DECIMAL(38,0))::BIGINT AS whole,
               (try_cast(number_text AS DECIMAL(18,2)) * 100)::BIGINT AS hundredths, {_FLAG_SQL} AS flag,
               try_cast(number_text AS DECIMAL(38,0)) IS NULL AS number_refused FROM dirty""",
    "try_timestamp": f"""WITH {feeds.DIRTY_SQL}
        SELECT l_orderkey, time_text, try_cast(time_text AS TIMESTAMP) AS at FROM dirty""",
    "csv_null_rules": f"""WITH {feeds.DIRTY_SQL}
        SELECT l_orderkey, l_linenumber, CASE WHEN number_text <> 'NULL' THEN number_text END AS number_field,
               CASE WHEN flag_text <> 'null' THEN flag_text END AS flag_field,
               CASE WHEN number_text <> 'NULL' AND NOT (number_text = '' AND l_linenumber > 5) THEN number_text END AS short_row_field
        FROM dirty""",
    "reject_rows": f"""WITH {_TYPED_SQL}
        SELECT reject AS _reject, count(*) AS n_rows, count(DISTINCT _file) AS n_files
        FROM judged WHERE reject IS NOT NULL GROUP BY reject""",
    "accept_rows": f"""WITH {_TYPED_SQL}
        SELECT l_orderkey AS order_id, l_partkey AS part_id, (quantity * 100)::BIGINT AS hundredths, flag, seen, note
        FROM judged WHERE reject IS NULL""",
    "change_rejects": f"""WITH {_TYPED_SQL},
        changes AS (
          SELECT *, CASE WHEN l_partkey % 11 <> 0 THEN CASE l_returnflag WHEN 'A' THEN 4 WHEN 'N' THEN 1 ELSE 3 END END AS kind
          FROM typed)
        SELECT CASE WHEN l_partkey % 13 = 0 THEN 'lsn: not a hex number'
                    WHEN kind IS NULL THEN 'change_type: not a number'
                    WHEN quantity IS NULL AND number_text <> 'NULL' THEN 'QUANTITY: not a decimal(18,2)'
                    WHEN flag IS NULL AND flag_text <> 'null' THEN 'FLAG: not a boolean'
                    WHEN length(note) > 2 THEN 'NOTE: longer than 2'
                    WHEN kind = 4 AND quantity IS NULL THEN 'QUANTITY: is null'
                    WHEN kind = 4 AND flag IS NULL THEN 'FLAG: is null'
                    WHEN kind = 4 AND seen IS NULL THEN 'SEENDATE: is null'
                    ELSE 'accepted' END AS outcome, kind AS change_type, count(*) AS n_rows
        FROM changes GROUP BY 1, 2""",
    "file_load_report": f"""WITH {_REPORT_SQL}
        SELECT _file AS file_name, rows_parsed, rows_loaded, errors_seen, first_error, status, load_status FROM statused""",
    "load_totals": f"""WITH {_REPORT_SQL}
        SELECT count(*) AS files, sum(rows_loaded)::BIGINT AS rows_loaded, sum(errors_seen)::BIGINT AS rows_rejected,
               count(*) FILTER (load_status = 'FAILED') AS files_failed FROM statused""",
    "constraint_report": f"""WITH {_TYPED_SQL}
        SELECT 'ORDERID' AS column_name, 'not_null' AS rule, 0::BIGINT AS violations
        UNION ALL SELECT 'PARTID', 'not_null', 0 UNION ALL SELECT 'LINENO', 'not_null', 0
        UNION ALL SELECT 'QUANTITY', 'not_null', count(*) FILTER (quantity IS NULL) FROM typed
        UNION ALL SELECT 'FLAG', 'not_null', count(*) FILTER (flag IS NULL) FROM typed
        UNION ALL SELECT 'SEENDATE', 'not_null', count(*) FILTER (seen IS NULL) FROM typed
        UNION ALL SELECT 'NOTE', 'not_null', count(*) FILTER (note IS NULL) FROM typed
        UNION ALL SELECT 'NOTE', 'length<=2', count(*) FILTER (length(note) > 2) FROM typed""",
    "audit_rows": f"""WITH {_REPORT_SQL},
        files AS (
          SELECT concat('/stage/LandingZone/client_', s_nationkey, '/Tables/tbl-', s_suppkey % 3, '/TableData_a/ChangeData/supp_', s_suppkey + 5, '.csv') AS path,
                 concat('supp_', s_suppkey + 5, '.csv') AS filename, concat('client_', s_nationkey) AS client_id,
                 concat('tbl-', s_suppkey % 3) AS table_id, concat('supp_', s_suppkey + 5) AS short
          FROM supplier),
        batched AS (
          SELECT *, (row_number() OVER (PARTITION BY table_id ORDER BY path) - 1) // 10 + 1 AS batch_number
          FROM files)
        SELECT coalesce(b.filename, r._file) AS file_name, coalesce(b.client_id, 'UNKNOWN') AS client_id,
               coalesce(b.table_id, 'UNKNOWN') AS table_id, coalesce(r.rows_loaded, 0)::BIGINT AS rows_loaded,
               TIMESTAMP '{feeds.RUN_TS}' AS file_load_timestamp, b.batch_number::BIGINT AS batch_number,
               coalesce(r.load_status, 'SUCCESS') AS load_status, r.first_error AS error_message,
               coalesce(b.path, r._file) AS full_stage_path, coalesce(r.errors_seen, 0)::BIGINT AS rows_rejected, true AS has_id
        FROM statused r FULL OUTER JOIN batched b ON b.short = r._file""",
}
