"""Applying changes to a table as rewrites, since file tables have no MERGE.

``_action`` of a row: ``keep`` (target row as it is), ``update``, ``insert``,
``delete``, or ``skip`` (a change without effect).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import DELETE, INSERT, UPDATE

KEEP, SKIP = "keep", "skip"
WRITTEN = (KEEP, "update", "insert")


def change_action(in_target: Column, change_type: Column, on_insert_match: str = "ignore") -> Column:
    """What a key's newest change does.

    An insert for a key that exists leaves the row as it is; with
    ``on_insert_match="update"`` it replaces the row.
    """
    if on_insert_match not in ("ignore", "update"):
        raise ValueError(f"on_insert_match: {on_insert_match!r}")
    replaces = (UPDATE,) if on_insert_match == "ignore" else (INSERT, UPDATE)
    return (
        F.when(in_target & (change_type == DELETE), "delete")
        .when(in_target & change_type.isin(*replaces), "update")
        .when(in_target, KEEP)
        .when(change_type.isin(INSERT, UPDATE), "insert")
        .otherwise(SKIP)
    )


def _side(frame: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    """Keys as they are, other columns prefixed, and a marker that the side has the row."""
    others = [F.col(c).alias(prefix + c) for c in frame.columns if c not in keys]
    return frame.select(*keys, *others, F.lit(True).alias(prefix + "there"))


def merge_plan(target: DataFrame, latest: DataFrame, keys: list[str], on_insert_match: str = "ignore") -> DataFrame:
    """The target's columns plus ``_action``, for every key of either side.

    One full outer join; with ``latest`` from a window on the same keys, its
    side is already partitioned for it. ``latest`` has one row per key and
    ``change_type``. NULL keys match nothing.
    """
    joined = _side(target, keys, "_t_").join(
        _side(latest.select(*target.columns, "change_type"), keys, "_s_"), keys, "full_outer"
    )
    changed = F.col("_s_there").isNotNull()
    action = F.when(
        changed, change_action(F.col("_t_there").isNotNull(), F.col("_s_change_type"), on_insert_match)
    ).otherwise(KEEP)
    with_action = joined.withColumn("_action", action)
    from_change = F.col("_action").isin("update", "insert")
    columns = [
        F.col(c) if c in keys else F.when(from_change, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c)
        for c in target.columns
    ]
    return with_action.select(*columns, "_action")


def merged_rows(plan: DataFrame) -> DataFrame:
    """The table after the merge."""
    return plan.filter(F.col("_action").isin(*WRITTEN)).drop("_action")


def merge_changes(target: DataFrame, latest: DataFrame, keys: list[str], on_insert_match: str = "ignore") -> DataFrame:
    return merged_rows(merge_plan(target, latest, keys, on_insert_match))


def merge_metrics(plan: DataFrame) -> DataFrame:
    """Rows inserted, updated and deleted; only keys and the change type are read for it."""
    counted = {"inserted": "insert", "updated": "update", "deleted": "delete"}
    return plan.agg(*[F.count_if(F.col("_action") == a).cast("bigint").alias(n) for n, a in counted.items()])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    when_matched: str = "update",
    when_not_matched: str = "insert",
) -> DataFrame:
    """The plain merges; ``source`` has one row per key.

    ``when_matched``: ``update`` (the source's columns replace the target's,
    NULLs included; columns the source lacks stay) or ``ignore``.
    ``when_not_matched``: ``insert`` (columns the source lacks are NULL) or ``ignore``.
    """
    if when_matched not in ("update", "ignore") or when_not_matched not in ("insert", "ignore"):
        raise ValueError(f"when_matched {when_matched!r}, when_not_matched {when_not_matched!r}")
    if when_matched == "ignore":
        if when_not_matched == "ignore":
            return target
        return target.unionByName(source.join(target.select(*keys), keys, "left_anti"), allowMissingColumns=True)
    joined = _side(target, keys, "_t_").join(
        _side(source, keys, "_s_"), keys, "full_outer" if when_not_matched == "insert" else "left"
    )
    in_source = F.col("_s_there").isNotNull()
    columns = []
    for c in target.columns:
        if c in keys:
            columns.append(F.col(c))
        elif c in source.columns:
            columns.append(F.when(in_source, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            columns.append(F.col(f"_t_{c}").alias(c))
    return joined.select(*columns)


def update_where(target: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """Set columns where the condition is true; a NULL condition leaves the row."""
    return target.withColumns(
        {c: F.when(condition, value).otherwise(F.col(c)) for c, value in assignments.items()}
    )


def delete_keys(target: DataFrame, column: str, values: list[str] | DataFrame) -> DataFrame:
    """Rows whose column is not among the values (a list, or a DataFrame with that column); NULL stays."""
    if isinstance(values, DataFrame):
        return target.join(values.select(column), column, "left_anti").select(*target.columns)
    return target.filter(~F.coalesce(F.col(column).isin(values), F.lit(False)))


def newer_than_applied(latest: DataFrame, applied: DataFrame, keys: list[str]) -> DataFrame:
    """Changes past the last one applied to their key.

    ``applied`` has ``keys, lsn, seq``, one row per key, deleted keys included.
    Without it a file that arrives late, or a failed one tried again, would put
    older values over newer ones.
    """

    def place(lsn: Column, seq: Column) -> Column:
        return F.struct(F.coalesce(lsn, F.lit(-1).cast("decimal(38,0)")), F.coalesce(seq, F.lit("")))

    last = applied.select(*keys, F.col("lsn").alias("_lsn"), F.col("seq").alias("_seq"), F.lit(True).alias("_seen"))
    joined = latest.join(last, keys, "left")
    newer = F.col("_seen").isNull() | (place(F.col("lsn"), F.col("seq")) > place(F.col("_lsn"), F.col("_seq")))
    return joined.filter(newer).select(*latest.columns)
