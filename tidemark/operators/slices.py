"""Replacing the slices of a table a snapshot covers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import scope_items
from tidemark.operators.manifest import Scope
from tidemark.operators.merge import delete_keys


def replace_slices(target: DataFrame, incoming: DataFrame, column: str, slices: DataFrame) -> DataFrame:
    """``target`` with the rows of the named slices replaced by the incoming ones.

    A slice without incoming rows ends up empty; slices not named stay untouched.
    """
    return delete_keys(target, column, slices).unionByName(incoming.join(slices.select(column), column, "left_semi"))


def clear_plan(
    registry: DataFrame, manifest: DataFrame, clients: Scope = None, tables: Scope = None
) -> DataFrame:
    """Per active table: its files in the manifest and what a full load clears first."""
    scoped = bool(scope_items(clients))
    names = scope_items(tables, upper=True)
    files = manifest
    if scoped:
        files = files.filter(F.col("client_id").isin(scope_items(clients)))
    counts = files.groupBy(F.upper("table_id").alias("_id")).agg(F.count("*").alias("_n"))
    active = registry.filter(F.col("is_active_full_load"))
    n_files = F.coalesce(F.col("_n"), F.lit(0))
    asked = F.upper("table_name").isin(names) if names else F.lit(True)
    action = (
        F.when(~asked, "skip: not asked for")
        .when(F.lit(scoped) & ~F.col("is_multi_tenant"), "skip: not per tenant")
        .when(n_files == 0, "skip: no files")
        .otherwise("delete tenants" if scoped else "clear table")
    )
    return active.join(counts, F.upper(active.source_table_id) == counts._id, "left").select(
        "load_order", "table_name", n_files.alias("files"), action.alias("action")
    )
