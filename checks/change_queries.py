"""Log numbers, newest changes, merges and mutations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import feeds
from tidemark.functions.values import lsn_number
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
from tidemark.operators.rows import duplicate_keys
from tidemark.operators.slices import replace_slices

KEY = ["id"]
LINE_KEY = ["order_id", "line_no"]


def lsn_decode(spark, sf):
    """96-bit numbers: the low 64 bits from the event, the high ones from its user."""
    events = feeds.load(spark, sf, "events")
    text = F.expr("concat('0x', lpad(hex(user_id + 1), 8, '0'), lpad(hex(event_id), 16, '0'))")
    wide = events.select("event_id", text.alias("lsn_text"), F.expr("concat('0x', hex(event_id))").alias("short_text"))
    return wide.select(
        "event_id",
        lsn_number(F.col("lsn_text")).cast("string").alias("lsn"),
        lsn_number(F.col("short_text")).cast("string").alias("short_lsn"),
        lsn_number(F.concat(F.col("lsn_text"), F.lit("0"))).cast("string").alias("too_long"),
        lsn_number(F.concat(F.lit("0x"), F.col("lsn_text"))).cast("string").alias("not_hex"),
    )


def _event_feed(spark, sf):
    return feeds.event_changes(spark, sf).withColumn("lsn", lsn_number(F.col("lsn_text"))).drop("lsn_text")


def _latest_events(spark, sf):
    return latest_changes(_event_feed(spark, sf), KEY, ("lsn", "seq"))


def cdc_latest(spark, sf):
    latest = _latest_events(spark, sf)
    return latest.select("id", F.col("lsn").cast("string").alias("lsn"), "change_type", "amount", "note")


def cdc_merge(spark, sf):
    return merge_changes(feeds.customer_target(spark, sf), _latest_events(spark, sf), KEY)


def cdc_merge_replace(spark, sf):
    return merge_changes(feeds.customer_target(spark, sf), _latest_events(spark, sf), KEY, on_insert_match="update")


def merge_counts(spark, sf):
    return merge_metrics(merge_plan(feeds.customer_target(spark, sf), _latest_events(spark, sf), KEY))


def merge_actions(spark, sf):
    plan = merge_plan(feeds.customer_target(spark, sf), _latest_events(spark, sf), KEY)
    return plan.groupBy(F.col("_action").alias("action")).agg(F.count("*").alias("n_rows"))


def cdc_merge_composite(spark, sf):
    latest = latest_changes(feeds.line_changes(spark, sf), LINE_KEY, feeds.LINE_ORDER)
    return merge_changes(feeds.order_target(spark, sf), latest, LINE_KEY)


def lsn_guard(spark, sf):
    """Events not older than the last purchase of their user, which counts as applied."""
    feed = _event_feed(spark, sf).filter(F.col("lsn").isNotNull())
    applied = feed.groupBy("id").agg(F.max(F.when(F.col("change_type") == 3, F.col("lsn"))).alias("lsn"))
    applied = applied.filter(F.col("lsn").isNotNull()).withColumn("seq", F.lit(""))
    kept = newer_than_applied(feed, applied.select("id", "lsn", "seq"), KEY)
    return kept.select("id", F.col("lsn").cast("string").alias("lsn"), "change_type")


def _supplier_updates(spark, sf):
    """Suppliers under every third id: even ones meet a target row, odd ones are new."""
    return feeds.load(spark, sf, "supplier").select(
        (F.col("s_suppkey") * 3).alias("id"), F.col("s_acctbal").alias("amount")
    )


def merge_upsert(spark, sf):
    return upsert(feeds.customer_target(spark, sf), _supplier_updates(spark, sf), KEY)


def merge_update_only(spark, sf):
    return upsert(feeds.customer_target(spark, sf), _supplier_updates(spark, sf), KEY, when_not_matched="ignore")


def merge_insert_missing(spark, sf):
    return upsert(feeds.customer_target(spark, sf), _supplier_updates(spark, sf), KEY, when_matched="ignore")


def update_rows(spark, sf):
    target = feeds.customer_target(spark, sf)
    return update_where(
        target, F.col("note").isin("MACHINERY", "BUILDING"), {"amount": F.lit(None).cast("double"), "note": F.lower("note")}
    )


def tenant_delete(spark, sf):
    orders = feeds.load(spark, sf, "orders").select(
        F.concat(F.lit("client_"), F.col("o_custkey") % 20).alias("tenant"), "o_orderkey", "o_totalprice"
    )
    return delete_keys(orders, "tenant", ["client_3", "client_4", "client_99"])


def slice_replacement(spark, sf):
    """Orders by priority, two priorities replaced by lineitem rows; one of them gets none."""
    target = feeds.load(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("tenant"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount")
    )
    incoming = feeds.load(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") == "A", "1-URGENT").otherwise("3-MEDIUM").alias("tenant"),
        F.col("l_orderkey").alias("id"),
        F.col("l_extendedprice").alias("amount"),
    )
    names = feeds.load(spark, sf, "orders").select(F.col("o_orderpriority").alias("tenant")).distinct()
    slices = names.filter(F.col("tenant").isin("1-URGENT", "5-LOW"))
    return replace_slices(target, incoming, "tenant", slices)


def duplicates(spark, sf):
    return duplicate_keys(feeds.load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


QUERIES = {
    "lsn_decode": lsn_decode,
    "cdc_latest": cdc_latest,
    "cdc_merge": cdc_merge,
    "cdc_merge_replace": cdc_merge_replace,
    "merge_metrics": merge_counts,
    "merge_actions": merge_actions,
    "cdc_merge_composite": cdc_merge_composite,
    "lsn_guard": lsn_guard,
    "merge_upsert": merge_upsert,
    "merge_update_only": merge_update_only,
    "merge_insert_missing": merge_insert_missing,
    "update_where": update_rows,
    "tenant_delete": tenant_delete,
    "slice_replacement": slice_replacement,
    "duplicate_keys": duplicates,
}

_EVENT_SQL = f"{feeds.EVENT_CHANGES_SQL},{feeds.CUSTOMER_TARGET_SQL},{feeds.MERGED_SQL}"


def _merged(key: str, source: str, replacing: str) -> str:
    """The merge as three disjoint parts: kept, replaced, added."""
    return f"""WITH {source}
        SELECT {key}, t_amount AS amount, t_note AS note FROM joined
        WHERE in_target AND (change_type IS NULL OR change_type NOT IN (1, {replacing}))
        UNION ALL
        SELECT {key}, s_amount, s_note FROM joined WHERE in_target AND change_type IN ({replacing})
        UNION ALL
        SELECT {key}, s_amount, s_note FROM joined WHERE NOT in_target AND change_type IN (2, 4)"""


_SUPPLIER_SQL = f"{feeds.CUSTOMER_TARGET_SQL}, source AS (SELECT s_suppkey * 3 AS id, s_acctbal AS amount FROM supplier)"

SQL = {
    "lsn_decode": """SELECT event_id, ((user_id + 1)::HUGEINT * 18446744073709551616::HUGEINT + event_id)::VARCHAR AS lsn,
        event_id::VARCHAR AS short_lsn, NULL::VARCHAR AS too_long, NULL::VARCHAR AS not_hex FROM events""",
    "cdc_latest": f"WITH {feeds.EVENT_CHANGES_SQL} SELECT id, lsn::VARCHAR AS lsn, change_type, amount, note FROM latest",
    "cdc_merge": _merged("id", _EVENT_SQL, "4"),
    "cdc_merge_replace": _merged("id", _EVENT_SQL, "2, 4"),
    "merge_metrics": f"""WITH {_EVENT_SQL}
        SELECT count(*) FILTER (NOT in_target AND change_type IN (2, 4)) AS inserted,
               count(*) FILTER (in_target AND change_type = 4) AS updated,
               count(*) FILTER (in_target AND change_type = 1) AS deleted FROM joined""",
    "merge_actions": f"""WITH {_EVENT_SQL}
        SELECT CASE WHEN in_target AND change_type = 1 THEN 'delete' WHEN in_target AND change_type = 4 THEN 'update'
                    WHEN in_target THEN 'keep' WHEN change_type IN (2, 4) THEN 'insert' ELSE 'skip' END AS action,
               count(*) AS n_rows FROM joined GROUP BY 1""",
    "cdc_merge_composite": _merged("order_id, line_no", feeds.LINE_SQL, "4"),
    "lsn_guard": f"""WITH {feeds.EVENT_CHANGES_SQL},
        applied AS (SELECT id, max(lsn) AS last FROM changes WHERE change_type = 3 GROUP BY id)
        SELECT c.id, c.lsn::VARCHAR AS lsn, c.change_type FROM changes c LEFT JOIN applied a ON a.id = c.id
        WHERE c.lsn IS NOT NULL AND (a.last IS NULL OR c.lsn >= a.last)""",
    "merge_upsert": f"""WITH {_SUPPLIER_SQL}
        SELECT id, CASE WHEN s.id IS NOT NULL THEN s.amount ELSE t.amount END AS amount, t.note
        FROM target t FULL OUTER JOIN source s USING (id)""",
    "merge_update_only": f"""WITH {_SUPPLIER_SQL}
        SELECT t.id, CASE WHEN s.id IS NOT NULL THEN s.amount ELSE t.amount END AS amount, t.note
        FROM target t LEFT JOIN source s ON s.id = t.id""",
    "merge_insert_missing": f"""WITH {_SUPPLIER_SQL}
        SELECT id, amount, note FROM target
        UNION ALL SELECT id, amount, NULL FROM source WHERE id NOT IN (SELECT id FROM target)""",
    "update_where": f"""WITH {feeds.CUSTOMER_TARGET_SQL}
        SELECT id, CASE WHEN note IN ('MACHINERY', 'BUILDING') THEN NULL ELSE amount END AS amount,
               CASE WHEN note IN ('MACHINERY', 'BUILDING') THEN lower(note) ELSE note END AS note FROM target""",
    "tenant_delete": """SELECT concat('client_', o_custkey % 20) AS tenant, o_orderkey, o_totalprice FROM orders
        WHERE concat('client_', o_custkey % 20) NOT IN ('client_3', 'client_4', 'client_99')""",
    "slice_replacement": """SELECT o_orderpriority AS tenant, o_orderkey AS id, o_totalprice AS amount FROM orders
        WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW')
        UNION ALL SELECT '1-URGENT', l_orderkey, l_extendedprice FROM lineitem WHERE l_returnflag = 'A'""",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
}
