"""Small landing zones, and a plain-Python model of what the loads must do."""

from __future__ import annotations

import csv
import datetime as dt
import os
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq

START = dt.datetime(2024, 1, 1)


def value(column, key: int, version: int):
    """A value for a column that differs by key and version and fits the type."""
    if column.type == "boolean":
        return (key + version) % 2 == 0
    if column.type == "timestamp_ntz":
        return START + dt.timedelta(days=key, hours=version)
    if column.type == "string":
        return f"{version}{key}"[: column.max_length or 20]
    scale = int(column.type.rstrip(")").split(",")[1])
    return Decimal(key * 10 + version if scale == 0 else f"{key}.{version}").quantize(Decimal(1).scaleb(-scale))


def record(spec, key: int, version: int, tenant: str | None = None) -> dict:
    """A whole row by column name."""
    row = {c.name: value(c, key, version) for c in spec.file_columns}
    row[spec.id_column] = Decimal(key)
    if spec.multi_tenant:
        row["DATABASEPHYSICALNAME"] = tenant
    return row


def folder(zone, client: str, spec, name: str = "TableData_01") -> str:
    return f"{zone}/LandingZone/{client}/Tables/{spec.source_id}/{name}"


def _set_time(path: str, when: float | None) -> None:
    if when is not None:
        os.utime(path, (when, when))


def write_snapshot(zone, client: str, spec, rows: list[dict], name="TableData_01", file="data-0", when=None, drop=()):
    """A Parquet snapshot file under the export's field names."""
    path = f"{folder(zone, client, spec, name)}/FullCopyData/{file}.parquet"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    columns = {}
    for c in spec.file_columns:
        if c.name in drop:
            continue
        values = [r[c.name] for r in rows]
        if c.type.startswith("decimal") and c.type.endswith(",0)"):
            columns[c.field] = pa.array([None if v is None else int(v) for v in values], pa.int64())
        elif c.type == "timestamp_ntz":
            columns[c.field] = pa.array(values, pa.timestamp("us"))
        else:
            columns[c.field] = pa.array(values)
    columns["NotInTheTable"] = pa.array(["x"] * len(rows))
    pq.write_table(pa.table(columns), path)
    _set_time(path, when)
    return path


def change_fields(spec, row: dict, kind: int, lsn: int, seq: str = "0") -> list[str]:
    """A change row as fields by position; unread positions hold a filler."""
    fields = ["filler"] * max(c.position for c in spec.file_columns)
    fields[0:4] = [f"0x{lsn:020X}", seq, str(kind), "mask"]
    for c in spec.file_columns:
        v = row[c.name]
        fields[c.position - 1] = "NULL" if v is None else str(v)
    return fields


def write_changes(zone, client: str, spec, rows: list[list[str]], file: str, name="TableData_01", when=None) -> str:
    path = f"{folder(zone, client, spec, name)}/ChangeData/{file}.csv"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as handle:
        csv.writer(handle, lineterminator="\n").writerows(rows)
    _set_time(path, when)
    return path


def apply_model(rows: dict, changes: list[tuple], on_insert_match: str = "ignore") -> dict:
    """Newest change per key onto ``rows``; a change is (key, kind, lsn, row)."""
    newest: dict = {}
    for key, kind, lsn, row in changes:
        if kind in (1, 2, 4) and (key not in newest or lsn > newest[key][1]):
            newest[key] = (kind, lsn, row)
    result = dict(rows)
    for key, (kind, _, row) in newest.items():
        if kind == 1:
            result.pop(key, None)
        elif kind == 4 or key not in result or on_insert_match == "update":
            result[key] = row
    return result


def table_rows(frame, spec) -> list[tuple]:
    """A table's rows as sorted tuples in declared column order."""
    return sorted((tuple(r[c] for c in spec.column_names) for r in frame.collect()), key=repr)


def model_rows(rows, spec) -> list[tuple]:
    return sorted((tuple(r[c] for c in spec.column_names) for r in rows), key=repr)
