"""The given tables seen as listings, audits, change feeds and dirty text.

Every feed uses its whole table. Next to each feed is the SQL that says the
same, as common table expressions to put in front of a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure

RUN_TS = "2024-06-01 00:00:00"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_ts():
    return F.lit(RUN_TS).cast("timestamp")


# --- listing from orders -----------------------------------------------------------
# Table ids are tbl-0 .. tbl-24; one customer in fifty has no TableData folder in the path.

_FOLDER = "concat('TableData_', lpad(lower(hex(o_custkey % 7)), 20, '0'))"
_PREFIX = "concat('/stage/LandingZone/client_', o_custkey % 20, '/Tables/Tbl-', o_orderkey % 25, '/'"
_PLACE = f"{_PREFIX}, CASE WHEN o_custkey % 50 = 0 THEN 'loose' ELSE {_FOLDER} END, "
FULL_PATH = f"{_PLACE}'/FullCopyData/data-', o_orderkey, '.parquet')"
CHANGE_PATH = f"{_PLACE}'/ChangeData/ChangeData_', o_orderkey, '.csv')"


def listing(spark: SparkSession, sf_dir: str, path: str = FULL_PATH) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    modified = F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)")
    return orders.select(
        F.expr(path).alias("full_file_path"),
        F.date_format(modified, "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("last_modified"),
    )


def _listing_sql(name: str, path: str) -> str:
    return f"""
{name} AS (
  SELECT {path} AS full_file_path,
         strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%a, %d %b %Y %H:%M:%S GMT') AS last_modified
  FROM orders)"""


# Fixed values, restated for DuckDB: the path patterns, the anchor and the time format of the landing zone.
def _parsed_sql(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT full_file_path,
         strptime(substr(last_modified, 6, 20), '%d %b %Y %H:%M:%S') AS last_modified,
         nullif(regexp_extract(full_file_path, '/([^/]+)/Tables/', 1), '') AS client_id,
         lower(nullif(regexp_extract(full_file_path, '/Tables/([^/]+)/', 1), '')) AS table_id,
         nullif(regexp_extract(full_file_path, '/(TableData_[^/]+)/', 1), '') AS tabledata_folder,
         regexp_extract(full_file_path, '[^/]*$') AS filename,
         substr(full_file_path, greatest(strpos(full_file_path, '/LandingZone/'), 1)) AS relative_path
  FROM {source})"""


LISTING_SQL = _listing_sql("listing", FULL_PATH)
PARSED_SQL = LISTING_SQL + "," + _parsed_sql("parsed", "listing")
CHANGE_PARSED_SQL = _listing_sql("change_listing", CHANGE_PATH) + "," + _parsed_sql("change_parsed", "change_listing")


# --- registry from nation ----------------------------------------------------------


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = load(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_name").alias("table_name"),
        F.concat(F.lit("TBL-"), F.col("n_nationkey")).alias("source_table_id"),
        (F.col("n_nationkey") % 7 * 10).cast("decimal(10,0)").alias("load_order"),
        (F.col("n_regionkey") != 3).alias("is_active_full_load"),
        (F.col("n_regionkey") != 1).alias("is_active_delta_load"),
        (F.col("n_regionkey") != 0).alias("is_multi_tenant"),
    )


REGISTRY_SQL = """
registry AS (
  SELECT n_name AS table_name, concat('TBL-', n_nationkey) AS source_table_id, n_nationkey % 7 * 10 AS load_order,
         n_regionkey <> 3 AS is_active_full_load, n_regionkey <> 1 AS is_active_delta_load,
         n_regionkey <> 0 AS is_multi_tenant
  FROM nation)"""


# --- audit from orders: F loaded, P failed, O never tried ----------------------------


def audit(spark: SparkSession, sf_dir: str, path: str = FULL_PATH) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "F", "SUCCESS").when(F.col("o_orderstatus") == "P", "FAILED")
    return orders.select(
        F.col("o_orderkey").cast("decimal(38,0)").alias("load_id"),
        F.concat(F.lit("tbl-"), F.col("o_orderkey") % 25).alias("table_id"),
        F.floor("o_totalprice").cast("decimal(38,0)").alias("rows_loaded"),
        status.alias("load_status"),
        F.expr(path).alias("full_stage_path"),
    ).filter(F.col("load_status").isNotNull())


def _audit_sql(name: str, path: str) -> str:
    return f"""
{name} AS (
  SELECT o_orderkey AS load_id, concat('tbl-', o_orderkey % 25) AS table_id, floor(o_totalprice)::BIGINT AS rows_loaded,
         CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS load_status, {path} AS full_stage_path
  FROM orders WHERE o_orderstatus IN ('F', 'P'))"""


AUDIT_SQL = _audit_sql("audit", FULL_PATH)
CHANGE_AUDIT_SQL = _audit_sql("change_audit", CHANGE_PATH)

LATEST_SQL = """
latest_folder AS (
  SELECT client_id, table_id, max(tabledata_folder) AS tabledata_folder FROM parsed
  WHERE client_id IS NOT NULL AND table_id IS NOT NULL AND tabledata_folder IS NOT NULL
  GROUP BY client_id, table_id),
latest_files AS (
  SELECT p.* FROM parsed p
  JOIN latest_folder USING (client_id, table_id, tabledata_folder))"""

MANIFEST_SQL = f"""{PARSED_SQL},{REGISTRY_SQL},{AUDIT_SQL},{LATEST_SQL},
manifest AS (
  SELECT f.full_file_path, f.client_id, f.table_id, f.tabledata_folder, f.filename, f.last_modified
  FROM latest_files f
  JOIN registry r ON upper(r.source_table_id) = upper(f.table_id) AND r.is_active_full_load
  WHERE NOT EXISTS (SELECT 1 FROM audit a
                    WHERE a.full_stage_path = f.full_file_path AND a.load_status = 'SUCCESS'))"""

# State from every latest folder; newer change files are then those of later orders.
STATE_SQL = """
state AS (
  SELECT client_id, table_id, max(tabledata_folder) AS tabledata_folder, max(filename) AS full_load_file,
         min(last_modified) AS full_load_last_modified
  FROM latest_files GROUP BY client_id, table_id)"""


# --- change feed from events, target from customer -----------------------------------


def event_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes by user; one log number in 97 is missing."""
    return load(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"),
        F.expr("CASE WHEN event_id % 97 <> 0 THEN concat('0x', lpad(hex(event_id), 20, '0')) END").alias("lsn_text"),
        F.lpad(F.col("event_id").cast("string"), 20, "0").alias("seq"),
        F.expr(
            "CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END"
        ).alias("change_type"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("note"),
    )


EVENT_CHANGES_SQL = """
changes AS (
  SELECT user_id AS id, CASE WHEN event_id % 97 <> 0 THEN event_id END AS lsn, event_id AS seq,
         CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS change_type,
         value AS amount, event_type AS note
  FROM events),
latest AS (
  SELECT * FROM changes WHERE change_type IN (1, 2, 4)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY lsn DESC NULLS LAST, seq DESC) = 1)"""


def customer_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers under even ids, so odd ids are free for inserts."""
    return load(spark, sf_dir, "customer").select(
        (F.col("c_custkey") * 2).alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("note")
    )


CUSTOMER_TARGET_SQL = """
target AS (SELECT c_custkey * 2 AS id, c_acctbal AS amount, c_mktsegment AS note FROM customer)"""

MERGED_SQL = """
joined AS (
  SELECT coalesce(t.id, s.id) AS id, t.id IS NOT NULL AS in_target, s.change_type,
         t.amount AS t_amount, t.note AS t_note, s.amount AS s_amount, s.note AS s_note
  FROM target t FULL OUTER JOIN latest s ON t.id = s.id)"""


# --- composite-key feed from lineitem, target from orders ----------------------------

LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "amount", "note", "change_type")
_LINE_TYPE = "CASE l_returnflag WHEN 'A' THEN 4 WHEN 'N' THEN 2 WHEN 'R' THEN CASE l_linestatus WHEN 'F' THEN 1 ELSE 3 END END"


def line_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.expr(_LINE_TYPE).alias("change_type"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_linestatus").alias("note"),
        "l_shipdate",
        "l_partkey",
        "l_suppkey",
        "l_quantity",
    )


def order_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of every order."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        (F.col("o_orderkey") % 7 + 1).cast("int").alias("line_no"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("note"),
    )


LINE_SQL = f"""
changes AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, {_LINE_TYPE} AS change_type,
         l_extendedprice AS amount, l_linestatus AS note, l_shipdate, l_partkey, l_suppkey, l_quantity
  FROM lineitem),
latest AS (
  SELECT * FROM changes WHERE change_type IN (1, 2, 4)
  QUALIFY row_number() OVER (PARTITION BY order_id, line_no
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
             l_quantity DESC NULLS LAST, amount DESC NULLS LAST, note DESC NULLS LAST, change_type DESC NULLS LAST) = 1),
target AS (
  SELECT o_orderkey AS order_id, (o_orderkey % 7 + 1)::INTEGER AS line_no, o_totalprice AS amount, o_orderstatus AS note
  FROM orders),
joined AS (
  SELECT coalesce(t.order_id, s.order_id) AS order_id, coalesce(t.line_no, s.line_no) AS line_no,
         t.order_id IS NOT NULL AS in_target, s.change_type,
         t.amount AS t_amount, t.note AS t_note, s.amount AS s_amount, s.note AS s_note
  FROM target t FULL OUTER JOIN latest s ON t.order_id = s.order_id AND t.line_no = s.line_no)"""

# --- dirty text from lineitem: one file per supplier ----------------------------------

_DIRTY_NUMBER = (
    "CASE WHEN l_partkey % 10 = 0 THEN 'abc' WHEN l_partkey % 10 = 1 THEN '' WHEN l_partkey % 10 = 2 THEN 'NULL' "
    "WHEN l_partkey % 10 = 3 THEN concat(cast(l_linenumber AS {text}), '.5') "
    "ELSE cast(cast(l_quantity AS {int}) AS {text}) END"
)
_DIRTY_FLAG = (
    "CASE l_linenumber WHEN 1 THEN 'on' WHEN 2 THEN 'OFF' WHEN 3 THEN 'Y' WHEN 4 THEN 'false' WHEN 5 THEN '1' "
    "WHEN 6 THEN 'maybe' ELSE 'null' END"
)
_DIRTY_TIME = "CASE WHEN l_suppkey % 5 = 0 THEN 'soon' WHEN l_suppkey % 5 = 1 THEN '' ELSE concat('2024-01-', lpad(cast(l_suppkey % 28 + 1 AS {text}), 2, '0'), ' 10:20:30.5') END"


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = {"text": "string", "int": "int"}
    return load(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("supp_"), F.col("l_suppkey")).alias("_file"),
        F.expr(_DIRTY_NUMBER.format(**types)).alias("number_text"),
        F.expr(_DIRTY_FLAG).alias("flag_text"),
        F.expr(_DIRTY_TIME.format(**types)).alias("time_text"),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_returnflag",
    )


_DUCK = {"text": "VARCHAR", "int": "INTEGER"}
DIRTY_SQL = f"""
dirty AS (
  SELECT concat('supp_', l_suppkey) AS _file, {_DIRTY_NUMBER.format(**_DUCK)} AS number_text,
         {_DIRTY_FLAG} AS flag_text, {_DIRTY_TIME.format(**_DUCK)} AS time_text,
         l_orderkey, l_partkey, l_linenumber, l_returnflag
  FROM lineitem)"""
