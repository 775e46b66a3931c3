"""Which files a run loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import parse_paths, unschemed
from tidemark.functions.values import scope_items

MANIFEST_COLUMNS = ("full_file_path", "client_id", "table_id", "tabledata_folder", "filename", "last_modified")
Scope = str | list[str] | None


def located(files: DataFrame) -> DataFrame:
    """Files whose client, table and folder could all be read from the path."""
    return files.filter(
        F.col("client_id").isNotNull() & F.col("table_id").isNotNull() & F.col("tabledata_folder").isNotNull()
    )


def latest_snapshot_files(files: DataFrame) -> DataFrame:
    """All files of the newest folder (greatest as text) of each client and table.

    An aggregate and a join rather than a window: folders are reduced to their
    names before the shuffle, so a tenant with most of the files is not one
    task, and the text maximum (which Spark sorts for) sees only those names.
    """
    files = located(files)
    folders = files.select("client_id", "table_id", "tabledata_folder").distinct()
    newest = folders.groupBy("client_id", "table_id").agg(F.max("tabledata_folder").alias("tabledata_folder"))
    return files.join(newest, ["client_id", "table_id", "tabledata_folder"])


def succeeded(audit: DataFrame) -> DataFrame:
    return audit.filter(F.col("load_status") == "SUCCESS").select(F.col("full_stage_path").alias("full_file_path"))


def unprocessed_files(files: DataFrame, audit: DataFrame) -> DataFrame:
    """Files without a successful load; failed ones come back."""
    done = succeeded(audit).select(unschemed(F.col("full_file_path")).alias("_done"))
    return files.join(done, unschemed(F.col("full_file_path")) == F.col("_done"), "left_anti")


def unprocessed_slices(files: DataFrame, audit: DataFrame, registry: DataFrame) -> DataFrame:
    """All files of every slice with at least one file left to load.

    A slice is what a snapshot replaces whole: one client of a tenant table, or
    a shared table. Loading only the files left would drop the rows of the others.
    """
    tenant_ids = _registry_ids(registry, F.col("is_multi_tenant")).withColumn("_tenant", F.lit(True))
    sliced = files.join(tenant_ids, F.upper(files.table_id) == tenant_ids._id, "left").select(
        *files.columns, F.when(F.col("_tenant"), F.col("client_id")).otherwise("").alias("_slice")
    )
    pending = unprocessed_files(sliced, audit).select("table_id", "_slice").distinct()
    return sliced.join(pending, ["table_id", "_slice"], "left_semi").select(*files.columns)


def _registry_ids(registry: DataFrame, keep: Column) -> DataFrame:
    return registry.filter(keep).select(F.upper("source_table_id").alias("_id")).distinct()


def active_tables(files: DataFrame, registry: DataFrame, flag: str) -> DataFrame:
    """Files of tables the registry has switched on; ids compare without case."""
    ids = _registry_ids(registry, F.col(flag))
    return files.join(ids, F.upper(files.table_id) == ids._id, "left_semi")


def in_scope(files: DataFrame, registry: DataFrame, clients: Scope = None, tables: Scope = None) -> DataFrame:
    """Files of the named clients and tables; a scope that names nothing is no scope."""
    client_ids = scope_items(clients)
    if client_ids:
        files = files.filter(F.col("client_id").isin(client_ids))
    names = scope_items(tables, upper=True)
    if names:
        ids = _registry_ids(registry, F.upper("table_name").isin(names))
        files = files.join(ids, F.upper(files.table_id) == ids._id, "left_semi")
    return files


def full_manifest(
    listing: DataFrame,
    registry: DataFrame,
    audit: DataFrame,
    clients: Scope = None,
    tables: Scope = None,
    whole_slices: bool = False,
    tenant_tables_only: bool = False,
) -> DataFrame:
    """Snapshot files to load.

    The newest folder is chosen before the audit and scope filters, so an older
    folder never stands in for it. ``whole_slices`` reloads a partly loaded
    slice whole; ``tenant_tables_only`` leaves shared tables out of a
    client-scoped run, whose slices it could not clear.
    """
    files = latest_snapshot_files(parse_paths(listing))
    files = in_scope(active_tables(files, registry, "is_active_full_load"), registry, clients, tables)
    if tenant_tables_only and scope_items(clients):
        files = active_tables(files, registry, "is_multi_tenant")
    files = unprocessed_slices(files, audit, registry) if whole_slices else unprocessed_files(files, audit)
    return _manifest(files)


def _manifest(files: DataFrame) -> DataFrame:
    """The manifest's columns, with the sizes where the listing knows them."""
    return files.select(*MANIFEST_COLUMNS, *(c for c in files.columns if c == "length"))


def after_snapshot(files: DataFrame, state: DataFrame) -> DataFrame:
    """Change files in the folder of the client's and table's last full load and newer than it."""
    gate = state.select(
        "client_id",
        F.lower("table_id").alias("table_id"),
        "tabledata_folder",
        F.col("full_load_last_modified").alias("_cutoff"),
    )
    gated = located(files).join(gate, ["client_id", "table_id", "tabledata_folder"])
    return gated.filter(F.col("last_modified") > F.col("_cutoff")).drop("_cutoff")


def delta_manifest(
    listing: DataFrame,
    state: DataFrame,
    registry: DataFrame,
    audit: DataFrame,
    clients: Scope = None,
    tables: Scope = None,
) -> DataFrame:
    """Change files to apply."""
    files = after_snapshot(parse_paths(listing), state)
    files = in_scope(active_tables(files, registry, "is_active_delta_load"), registry, clients, tables)
    return _manifest(unprocessed_files(files, audit))


def manifest_counts(manifest: DataFrame) -> DataFrame:
    """Files, clients and tables of a manifest."""
    return manifest.agg(
        F.count("*").alias("files"),
        F.count_distinct("client_id").alias("clients"),
        F.count_distinct("table_id").alias("tables"),
    )


def listing_counts(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files listed, taken into the manifest, and left out."""
    listed = listing.agg(F.count("*").alias("files_listed"))
    taken = manifest.agg(F.count("*").alias("files_inserted"))
    # Two one-row aggregates side by side.
    both = listed.withColumn("_one", F.lit(1)).join(taken.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return both.withColumn("files_skipped", F.col("files_listed") - F.col("files_inserted"))


def exclusion_reasons(
    listing: DataFrame, registry: DataFrame, audit: DataFrame, clients: Scope = None, tables: Scope = None
) -> DataFrame:
    """Every listed snapshot file with the first rule that leaves it out, or ``loaded now``.

    Plain ``files_skipped`` also counts filtered files; this tells them apart.
    """
    files = parse_paths(listing)
    path = "full_file_path"

    def mark(kept: DataFrame, name: str) -> DataFrame:
        return kept.select(path, F.lit(True).alias(name)).distinct()

    newest = latest_snapshot_files(files)
    active = active_tables(files, registry, "is_active_full_load")
    scoped = in_scope(files, registry, clients, tables)
    done = succeeded(audit).distinct().withColumn("_done", F.lit(True))
    marked = files
    for kept, name in ((newest, "_newest"), (active, "_active"), (scoped, "_scoped")):
        marked = marked.join(mark(kept, name), path, "left")
    marked = marked.join(done, path, "left")
    reason = (
        F.when(
            F.col("client_id").isNull() | F.col("table_id").isNull() | F.col("tabledata_folder").isNull(),
            "path not recognised",
        )
        .when(F.col("_newest").isNull(), "older folder")
        .when(F.col("_active").isNull(), "table not active")
        .when(F.col("_scoped").isNull(), "out of scope")
        .when(F.col("_done").isNotNull(), "already loaded")
        .otherwise("loaded now")
    )
    return marked.select(*MANIFEST_COLUMNS, reason.alias("reason"))
