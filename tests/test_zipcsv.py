import csv
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from ontime.sources import zipcsv


def write_zip(path, members):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in members.items():
            zf.writestr(name, data)
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def test_zip_edge_cases(spark, scratch):
    write_zip(f"{scratch}/year=2019/month=1/a.zip", {
        "one.CSV": "A,B,C\n1,2,3\n\n4,5\n",                       # upper-case name, blank line, short row
        "two.csv": b"C,A\n7,x\xffy\n",                           # other header order, bad byte, B missing
        "readme.html": "<html></html>",                            # ignored
    })
    with open(f"{scratch}/year=2019/month=1/broken.zip", "wb") as f:
        f.write(b"this is not a zip archive")
    rows = sorted(tuple(r) for r in zipcsv.read_zip_csv(spark, scratch, ["A", "B", "C"]).collect())
    assert rows == sorted([("1", "2", "3"), ("4", "5", None), ("x�y", "", "7")])
    st = {os.path.basename(r.path): r for r in zipcsv.archive_status(spark, scratch).collect()}
    assert st["a.zip"].error is None and (st["a.zip"].members, st["a.zip"].csv_members, st["a.zip"].rows) == (3, 2, 3)
    assert st["broken.zip"].error is not None and st["broken.zip"].rows == 0


def test_writer_round_trip(spark, scratch):
    df = spark.createDataFrame([("2019-01-05", "AA"), ("2019-02-01", None), ("", "BB")],
                               "FlightDate string, Reporting_Airline string")
    written = zipcsv.write_zip_archives(df, scratch, ["FlightDate", "Reporting_Airline"]).collect()
    assert sum(r.rows for r in written) == 3
    back = sorted(tuple(r) for r in zipcsv.read_zip_csv(spark, scratch, ["FlightDate", "Reporting_Airline"]).collect())
    assert back == sorted([("2019-01-05", "AA"), ("2019-02-01", ""), ("", "BB")])


def test_writer_keeps_rows_with_malformed_dates(spark, scratch):
    # two different malformed months of one year land in the same 'unknown' directory
    rows = [("2019-1-5", "AA"), ("2019-2-7", "BB"), ("2019-03-01", "CC"), ("", "DD"), ("x", "EE")]
    df = spark.createDataFrame(rows, "FlightDate string, Reporting_Airline string").coalesce(1)
    written = zipcsv.write_zip_archives(df, scratch, ["FlightDate", "Reporting_Airline"]).collect()
    assert sum(r.rows for r in written) == 5
    assert zipcsv.read_zip_csv(spark, scratch, ["FlightDate", "Reporting_Airline"]).count() == 5


COLUMNS = ["A", "B", "C"]


def stdlib_rows(content):
    """What a streaming csv.DictReader gets before it fails."""
    out = []
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as zf:
            for name in zf.namelist():
                if name.lower().endswith(".csv"):
                    with zf.open(name) as f:
                        for r in csv.DictReader(io.TextIOWrapper(f, "utf-8", "replace")):
                            out.append(tuple(r.get(c, "") for c in COLUMNS))
    except Exception:  # noqa: BLE001  any fault ends the archive
        pass
    return out


def packed(data, compression=zipfile.ZIP_DEFLATED):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression) as zf:
        zf.writestr("a.csv", data)
    return buf.getvalue()


def ours(content):
    archive = zipcsv.Archive(content)
    rows = [tuple(r.values()) for b in archive.batches(COLUMNS) for r in b.to_pylist()]
    assert archive.rows == len(rows)
    return rows, archive.error


LINES = "A,B,C\n" + "".join(f"{i},x{i},\"q,{i}\"\n" for i in range(50_000))


def test_rows_before_a_bad_checksum_are_kept():
    content = bytearray(packed(LINES, zipfile.ZIP_STORED))
    at = content.find(b"49999,")
    content[at] ^= 1
    rows, error = ours(bytes(content))
    whole = stdlib_rows(packed(LINES))
    assert "CRC" in error and rows[:49_000] == whole[:49_000] and len(rows) == 50_000


def test_rows_before_a_truncation_are_kept():
    content = bytearray(packed(LINES))
    middle = len(content) // 2
    content[middle:middle + 50] = bytes(50)
    rows, error = ours(bytes(content))
    assert error and rows[:20_000] == stdlib_rows(bytes(content))[:20_000] == stdlib_rows(packed(LINES))[:20_000]


@pytest.mark.parametrize("data", [
    "A,B,A\n1,2,3\n4,5\n", "\nA,B\n1,2\n", "", "A,B,C", "A,B,C\n", "A\n\n1\n", 'A,B\n"x\ny",2\n3,4\n', 'A,B\n5"x,6\n7,8\n',
    "A,B\r\n1,2\r\n\r\n3,4,5\r\n", 'A,B\n1,"never closed\n2,3\n', '"A\n",B\n1,2\n', "B,C\n1,2\n"])
def test_rows_equal_the_stdlib_reader(data):
    rows, error = ours(packed(data))
    assert sorted(rows, key=str) == sorted(stdlib_rows(packed(data)), key=str)
    assert (error is not None) == ("never closed" in data)


def test_a_quote_left_open_over_the_field_limit_is_an_error_not_silence():
    lines = ["A,B,C"] + [f"{i},x{i},y" for i in range(50_000)]
    whole = stdlib_rows(packed("\n".join(lines)))
    lines[30_000] = '29999,"x,y'
    content = packed("\n".join(lines))
    rows, error = ours(content)
    assert "field larger" in error
    assert rows == stdlib_rows(content) == whole[:29_999]


def test_encrypted_members_are_reported():
    content = bytearray(packed("A,B,C\n1,2,3\n"))
    for mark, at in ((b"PK\x03\x04", 6), (b"PK\x01\x02", 8)):
        content[content.find(mark) + at] |= 1  # the flag of an encrypted member
    rows, error = ours(bytes(content))
    assert rows == [] and "encrypted" in error
    assert zipcsv.archive_status_of("p", bytes(content))["error"] == error


def test_members_are_rows_and_big_archives_are_many_tasks(spark, scratch, monkeypatch):
    monkeypatch.setattr(zipcsv, "SPLIT_BYTES", 1000)
    write_zip(f"{scratch}/big.zip", {f"m{i}.csv": "A,B\n" + f"{i},x\n" * 300 for i in range(40)})
    frame = zipcsv.read_zip_csv(spark, scratch, ["A"])
    by_task = frame.groupBy(F.spark_partition_id().alias("task"), "A").count().collect()
    assert sorted((int(r.A), r["count"]) for r in by_task) == [(i, 300) for i in range(40)]
    assert len({r.task for r in by_task}) > 8


def test_rows_and_status_come_from_one_read(spark, scratch, monkeypatch):
    content = bytearray(packed("A,B,C\n" + "1,2,3\n" * 10, zipfile.ZIP_STORED))
    content[content.find(b"1,2,3")] ^= 1                       # the checksum no longer fits
    write_zip(f"{scratch}/raw/good.zip", {"a.csv": "A\n1\n2\n", "b.csv": "A\n3\n", "c.txt": ""})
    write_zip(f"{scratch}/raw/none.zip", {"c.txt": "x"})
    with open(f"{scratch}/raw/crc.zip", "wb") as f:
        f.write(content)
    with open(f"{scratch}/raw/junk.zip", "wb") as f:
        f.write(b"junk")
    status = f"{scratch}/status"
    frame = zipcsv.read_zip_csv(spark, f"{scratch}/raw", ["A"], status_to=status)
    for _ in range(2):                                          # a repeated run replaces its status
        frame.write.mode("overwrite").parquet(f"{scratch}/rows")
    got = {os.path.basename(r.path): r for r in zipcsv.read_status(spark, status).collect()}
    assert spark.read.parquet(f"{scratch}/rows").count() == sum(r.rows for r in got.values())
    assert {k: (r.members, r.csv_members, r.rows, (r.error or "").split(":")[0]) for k, r in got.items()} == {
        "good.zip": (3, 2, 3, ""), "none.zip": (1, 0, 0, ""), "crc.zip": (1, 1, 10, "BadZipFile"), "junk.zip": (0, 0, 0, "BadZipFile")}
    alone = sorted(map(tuple, zipcsv.archive_status(spark, f"{scratch}/raw").collect()))
    assert alone == sorted(map(tuple, got.values()))


def test_a_fault_ends_its_member_only(spark, scratch):
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as zf:
        zf.writestr("a.csv", "A\n1\n")
        zf.writestr("b.csv", "A\n2\n")
    raw = bytearray(content.getvalue())
    raw[raw.find(b"A\n1") + 2] = ord("9")
    os.makedirs(f"{scratch}/raw")
    with open(f"{scratch}/raw/x.zip", "wb") as f:
        f.write(raw)
    assert sorted(r.A for r in zipcsv.read_zip_csv(spark, f"{scratch}/raw", ["A"]).collect()) == ["2", "9"]
    assert "CRC" in zipcsv.archive_status(spark, f"{scratch}/raw").first().error
    assert sorted(r["A"] for b in zipcsv.Archive(bytes(raw)).batches(["A"]) for r in b.to_pylist()) == ["2", "9"]


def test_one_month_lists_and_reads_that_month_only(spark, scratch):
    for m in (1, 2, 11):
        write_zip(f"{scratch}/year=2019/month={m}/a.zip", {"a.csv": f"A\n{m}\n"})
    with open(f"{scratch}/year=2019/month=2/bad.zip", "wb") as f:
        f.write(b"junk")
    listed = zipcsv.list_archives(spark, scratch, months=[(2019, 1), (2019, 1), (2020, 1)])
    assert listed.count() == 1 and len(listed.inputFiles()) == 1
    assert [r.A for r in zipcsv.read_zip_csv(spark, scratch, ["A"], months=[(2019, 1), (2020, 1)]).collect()] == ["1"]
    assert sorted(r.A for r in zipcsv.read_zip_csv(spark, scratch, ["A"], months=[(2019, 2), (2019, 11)]).collect()) == ["11", "2"]
    assert zipcsv.read_zip_csv(spark, scratch, ["A"], months=[(2031, 1)]).collect() == []
    assert zipcsv.archive_status(spark, scratch, months=[(2019, 2)]).count() == 2


def test_a_store_that_only_spark_opens(spark, scratch, monkeypatch):
    write_zip(f"{scratch}/small.zip", {"a.csv": "A\n1\n", "b.csv": "A\n2\n"})
    write_zip(f"{scratch}/large.zip", {"a.csv": "A\n" + "12345\n" * 1000})
    monkeypatch.setattr(zipcsv, "_DIRECT", {})
    rows = zipcsv.read_zip_csv(spark, scratch, ["A"], status_to=f"{scratch}/status")
    assert sorted(r.A for r in rows.collect())[:2] == ["1", "12345"]
    assert sorted(r.rows for r in zipcsv.read_status(spark, f"{scratch}/status").collect()) == [2, 1000]
    monkeypatch.setattr(zipcsv, "MAX_CONTENT", 1000)
    with pytest.raises(ValueError, match="too large"):
        zipcsv.read_zip_csv(spark, scratch, ["A"])
    status = {os.path.basename(r.path): (r.rows, r.error) for r in zipcsv.archive_status(spark, scratch).collect()}
    assert status == {"small.zip": (2, None), "large.zip": (0, "too large to be read")}


def test_an_archive_beyond_two_gib_is_read_in_bounded_memory(scratch):
    """A sparse file: one small member behind 2 GiB of nothing."""
    path = f"{scratch}/big.zip"
    small = packed("A,B,C\n1,2,3\n", zipfile.ZIP_STORED)
    with open(path, "wb") as f:
        f.seek((1 << 31) + 10)
        f.write(small)
    with zipcsv._open(path) as f:
        n, infos = zipcsv._csv_members(f)
    found = {}
    with zipcsv._open(path) as f:
        rows = [r for b in zipcsv._member_rows(f, infos[0], COLUMNS, found) for r in b.to_pylist()]
    assert n == 1 and infos[0].header_offset > 1 << 31
    assert rows == [{"A": "1", "B": "2", "C": "3"}] and found == {"rows": 1, "error": None}


def test_the_writer_never_holds_a_directory(spark, scratch, monkeypatch):
    """Each batch goes to its archive as it comes: one open writer, no batch kept."""
    monkeypatch.setattr(zipcsv.TaskContext, "get", staticmethod(lambda: type("T", (), {
        "attemptNumber": lambda self: 0, "partitionId": lambda self: 3})()))
    schema = zipcsv.pa.schema([("a", zipcsv.pa.string())])
    writer = zipcsv._ArchiveWriter(*zipcsv.filesystem(str(scratch)), ("2024", "1"), "00003", schema)
    before = zipcsv.pa.total_allocated_bytes()
    for i in range(50):
        writer.add(zipcsv.pa.RecordBatch.from_pydict({"a": [f"{i}-{k}" for k in range(2000)]}))
    assert zipcsv.pa.total_allocated_bytes() - before < 4 << 20
    row = writer.close().to_pylist()[0]
    assert row["rows"] == 100_000
    assert zipcsv.archive_status_of(row["path"], open(row["path"], "rb").read())["rows"] == 100_000


def test_an_archive_for_each_directory_and_task(spark, scratch):
    """Rows of a directory lie apart in their partition, and still make one archive of it."""
    raw = spark.createDataFrame([(f"2024-{1 + i % 3:02d}-05", str(i)) for i in range(300)], "FlightDate string, Origin string").coalesce(1)
    root = f"{scratch}/apart"
    written = zipcsv.write_zip_archives(raw, root, ["FlightDate", "Origin"]).collect()
    assert sorted(r["rows"] for r in written) == [100, 100, 100]
    back = zipcsv.read_zip_csv(spark, root, ["FlightDate", "Origin"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, raw.collect()))
