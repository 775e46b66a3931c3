"""Typed projection with per-row reject reasons, and constraint checks.

A bad row never fails the job: every cast is a soft one, and ``_reject`` holds
the first reason (NULL for a good row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import client_of
from tidemark.functions.values import computed_once, lsn_number, soft_cast
from tidemark.registry import TENANT_COLUMN, TableSpec

CHANGE_COLUMNS = ("lsn", "seq", "change_type")


def _first_reason(reasons: list[str]) -> str:
    """The first reason that is not NULL, as SQL text."""
    return f"coalesce({', '.join([*reasons, 'CAST(NULL AS string)'])})"


def _reason(condition: str, text: str) -> str:
    return f"CASE WHEN {condition} THEN '{text}' END"


def _typed(raw: DataFrame, spec: TableSpec, extra: list[Column]) -> DataFrame:
    """Cast every column, keeping the raw value beside it for the reject checks."""
    types = dict(raw.dtypes)
    typed = [F.expr(f"{soft_cast(f'`{c.name}`', types[c.name], c.type)} AS `{c.name}`") for c in spec.file_columns]
    if spec.multi_tenant:
        typed.insert(0, client_of(F.col("_file")).alias(TENANT_COLUMN))
    kept = [F.expr(f"`{c.name}` AS `_raw_{c.name}`") for c in spec.file_columns if types[c.name] != c.type]
    return raw.select(*typed, *kept, *extra, "_file", "_row")


def _cast_reasons(typed: DataFrame, columns, lenient_times: bool) -> list[str]:
    present = set(typed.columns)
    reasons = []
    for c in columns:
        lenient = lenient_times and c.type == "timestamp_ntz"
        if f"_raw_{c.name}" in present and not lenient:
            reasons.append(_reason(f"`_raw_{c.name}` IS NOT NULL AND `{c.name}` IS NULL", f"{c.name}: not a {c.type}"))
        if c.max_length:
            reasons.append(_reason(f"length(`{c.name}`) > {c.max_length}", f"{c.name}: longer than {c.max_length}"))
    return reasons


def _null_reasons(columns) -> list[str]:
    return [_reason(f"`{c.name}` IS NULL", f"{c.name}: is null") for c in columns if not c.nullable]


def project_snapshot(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Snapshot rows as the spec's columns plus ``_file, _row, _reject``."""
    typed = _typed(raw, spec, [])
    reasons = _cast_reasons(typed, spec.columns, lenient_times=False) + _null_reasons(spec.columns)
    reject = F.expr(_first_reason(reasons)).alias("_reject")
    return computed_once(typed.select(*spec.column_names, "_file", "_row", reject))


def project_changes(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Change rows as the spec's columns plus ``lsn, seq, change_type, _file, _row, _reject``.

    Timestamps that do not parse are NULL, everything else that does not is a
    reject. NULLs are refused where the row would be written: an insert or
    update needs all columns, a delete its key, other types nothing.
    """
    extra = [
        lsn_number(F.col("_lsn_text")).alias("lsn"),
        F.col("_lsn_text"),
        F.col("_seq").alias("seq"),
        F.col("_type_text").try_cast("decimal(38,0)").alias("change_type"),
        F.col("_type_text"),
    ]
    typed = _typed(raw, spec, extra)
    keys = [c for c in spec.columns if c.name in spec.keys]
    payload = [c for c in spec.columns if c.name not in spec.keys]
    envelope = [
        _reason("_lsn_text IS NOT NULL AND lsn IS NULL", "lsn: not a hex number"),
        _reason("_type_text IS NOT NULL AND change_type IS NULL", "change_type: not a number"),
    ]
    casts = _cast_reasons(typed, spec.columns, lenient_times=True)
    key_nulls = f"CASE WHEN change_type IN (1, 2, 4) THEN {_first_reason(_null_reasons(keys))} END"
    payload_nulls = f"CASE WHEN change_type IN (2, 4) THEN {_first_reason(_null_reasons(payload))} END"
    reject = F.expr(_first_reason([*envelope, *casts, key_nulls, payload_nulls])).alias("_reject")
    return computed_once(typed.select(*CHANGE_COLUMNS, *spec.column_names, "_file", "_row", reject))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_reject").isNull())


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("_reject").isNotNull())


def constraint_report(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that break each declared constraint, one line per constraint, in one pass."""
    checks = {}
    for c in spec.columns:
        if not c.nullable:
            checks[c.name, "not_null"] = F.col(c.name).isNull()
        if c.max_length:
            checks[c.name, f"length<={c.max_length}"] = F.length(c.name) > c.max_length
    counts = rows.agg(
        *[F.count_if(broken).alias(f"n{i}") for i, broken in enumerate(checks.values())]
    )
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.lit(rule).alias("rule"), F.col(f"n{i}").alias("violations"))
            for i, (name, rule) in enumerate(checks)
        ]
    )
    return counts.select(F.inline(lines))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)
