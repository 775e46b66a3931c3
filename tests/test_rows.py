import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tests.helpers import change_fields, folder, record, write_changes, write_snapshot
from tidemark.operators.reports import file_load_report
from tidemark.operators.rows import accepted, constraint_report, project_changes, project_snapshot, rejected
from tidemark.registry import table
from tidemark.sources.change_csv import read_changes
from tidemark.sources.snapshots import read_snapshot

SALARY, USERS, REQUESTS, PAYTYPE = (table(n) for n in ("USERINFOISSALARY", "USERINFO", "TIMEOFFREQUEST", "PAYTYPE"))


def parsed(spark, spec, path, **options):
    return project_changes(read_changes(spark, spec, [path], **options), spec)


def write_text(zone, spec, text, file="c"):
    path = write_changes(zone, "acme", spec, [], file)
    with open(path, "w", newline="") as handle:
        handle.write(text)
    return path


def test_csv_dialect(spark, tmp_path):
    lines = [
        '0x01,0,4,m,1,7,on,2024-01-01 00:00:00,2024-01-02,3,2024-01-03\r',
        '"0x02",0,"2",m,"2",7,"TRUE",2024-01-01T05:06:07.123,2024-01-02,3,"2024-01-03"',
        '0x03,0,1,m,3,NULL,null,,,NULL,',
        '0x04,0,4,m,4,7,no,soon,2024-01-02,3,2024-01-03',
        '0x05,0,4,m,,7,no,2024-01-01,2024-01-02,3,2024-01-03',
        '0x06,0,4,m,6,7,no,2024-01-01,2024-01-02,3,2024-01-03,more,fields',
        '0x07,0,4,m,7,7,no,2024-01-01',
        '0xXY,0,4,m,8,7,no,2024-01-01,2024-01-02,3,2024-01-03',
        'NULL,0,4,m,9,7,no,2024-01-01,2024-01-02,3,2024-01-03',
        '0x0A,0,3,m,10,NULL,NULL,NULL,NULL,NULL,NULL',
    ]
    rows = parsed(spark, SALARY, write_text(tmp_path, SALARY, "\n".join(lines) + "\n")).orderBy("_row").collect()
    assert len(rows) == 10 and {r.DATABASEPHYSICALNAME for r in rows} == {"acme"}
    assert [r._reject for r in rows] == [
        None,
        None,
        None,  # a delete needs its key only
        "STARTDATETIME: is null",
        "USERINFOISSALARYID: not a decimal(38,0)",  # an empty field is text, not NULL
        None,  # fields past the last position are ignored
        "ENDDATETIME: is null",  # fields a short row lacks are NULL
        "lsn: not a hex number",
        None,  # without a log number it is the oldest change
        None,  # a before-image is not written
    ]
    first = rows[0]
    assert first.ISSALARY is True and first.MODIFIEDON == dt.datetime(2024, 1, 3)
    assert rows[1].STARTDATETIME == dt.datetime(2024, 1, 1, 5, 6, 7, 123000) and rows[8].lsn is None


def test_quotes_line_breaks_and_empty_text(spark, tmp_path):
    fields = change_fields(REQUESTS, record(REQUESTS, 1, 1, "acme"), 4, 1)
    note = next(c.position for c in REQUESTS.file_columns if c.name == "EMPNOTES") - 1
    texts = ['say "hi", then\nleave', "", " padded ", "x" * 500, "x" * 501, "NULL"]
    rows = []
    for i, t in enumerate(texts):
        row = list(fields)
        row[4], row[note] = str(i), t
        rows.append(row)
    path = write_changes(tmp_path, "acme", REQUESTS, rows, "c")
    got = parsed(spark, REQUESTS, path).orderBy("TIMEOFFREQUESTID").collect()
    assert [r.EMPNOTES for r in got] == texts[:5] + [None]
    assert [r._reject for r in got] == [None] * 4 + ["EMPNOTES: longer than 500", "EMPNOTES: is null"]


def test_wide_rows_are_read_by_position(spark, tmp_path):
    want = record(USERS, 5, 1, "acme")
    fields = change_fields(USERS, want, 2, 1) + ["tail"] * 10
    fields[87] = ""  # the last position read is empty, and the row goes on
    row = parsed(spark, USERS, write_changes(tmp_path, "acme", USERS, [fields], "c")).first()
    assert row._reject is None and row.PNGUSERNAME == "" and row.WEID == want["WEID"]
    assert row.MODIFIEDON == want["MODIFIEDON"] and row.PAYROLLEMPLOYEEID == want["PAYROLLEMPLOYEEID"]


def test_report_of_files(spark, tmp_path):
    good = [change_fields(SALARY, record(SALARY, k, 1), 4, k) for k in range(3)]
    bad = [list(good[0]), list(good[1])]
    bad[0][4], bad[1][5] = "x", "y"
    for name, rows in (("good", good), ("mixed", good + bad), ("bad", bad)):
        write_changes(tmp_path, "acme", SALARY, rows, name)
    rows = parsed(spark, SALARY, f"{folder(tmp_path, 'acme', SALARY)}/ChangeData")
    report = {r._file.split("/")[-1]: r for r in file_load_report(rows).collect()}
    assert {n: (r.status, r.load_status, r.rows_loaded, r.errors_seen) for n, r in report.items()} == {
        "good.csv": ("LOADED", "SUCCESS", 3, 0),
        "mixed.csv": ("PARTIALLY_LOADED", "FAILED", 3, 2),
        "bad.csv": ("LOAD_FAILED", "FAILED", 0, 2),
    }
    assert report["mixed.csv"].first_error == "USERINFOISSALARYID: not a decimal(38,0)"


def test_snapshot_fields_by_name(spark, tmp_path):
    rows = [record(PAYTYPE, k, 1, "acme") for k in range(3)]
    whole = write_snapshot(tmp_path, "acme", PAYTYPE, rows)
    got = accepted(project_snapshot(read_snapshot(spark, PAYTYPE, [whole]), PAYTYPE))
    assert sorted(got.select(*PAYTYPE.column_names).collect(), key=lambda r: r.ID)[2].asDict() == rows[2]
    # Files may lack a field: its column is NULL, and refused where the table needs it.
    lacking = write_snapshot(tmp_path, "acme", PAYTYPE, rows, file="data-1", drop=("COLORCODE",))
    both = project_snapshot(read_snapshot(spark, PAYTYPE, [whole, lacking]), PAYTYPE)
    assert {r._file.split("/")[-1]: r._reject for r in both.collect()} == {
        "data-0.parquet": None,
        "data-1.parquet": "COLORCODE: is null",
    }


def test_snapshot_rejects_and_constraints(spark, tmp_path):
    rows = [record(PAYTYPE, k, 1, "acme") for k in range(4)]
    rows[1]["COLORCODE"], rows[2]["PAYTYPENAME"], rows[3]["STARTDATETIME"] = "xy", None, None
    path = write_snapshot(tmp_path, "acme", PAYTYPE, rows)
    projected = project_snapshot(read_snapshot(spark, PAYTYPE, [path]), PAYTYPE)
    assert sorted(r._reject for r in rejected(projected).collect()) == [
        "COLORCODE: longer than 1",
        "PAYTYPENAME: is null",
        "STARTDATETIME: is null",
    ]
    broken = {(r.column_name, r.rule): r.violations for r in constraint_report(projected, PAYTYPE).collect() if r.violations}
    assert broken == {("COLORCODE", "length<=1"): 1, ("PAYTYPENAME", "not_null"): 1, ("STARTDATETIME", "not_null"): 1}


def test_nullable_columns_stay_null(spark, tmp_path):
    spec = table("TIMEOFFDATA")
    row = record(spec, 1, 1, "acme") | {"LASTPROCESSEDEVENTID": None, "LASTPROCESSEDEVENTDATETIME": None}
    got = parsed(spark, spec, write_changes(tmp_path, "acme", spec, [change_fields(spec, row, 2, 1)], "c")).first()
    assert got._reject is None and got.LASTPROCESSEDEVENTID is None and got.USEDSECS == Decimal(11)


def test_only_read_columns_reach_the_scan(spark, tmp_path):
    path = write_snapshot(tmp_path, "acme", SALARY, [record(SALARY, 1, 1, "acme")])
    frame = project_snapshot(read_snapshot(spark, SALARY, [path]), SALARY).select(F.col("USERID"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "UserID#" in plan and "NotInTheTable" not in plan
