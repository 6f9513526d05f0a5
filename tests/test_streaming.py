from ontime.schema import RAW_COLUMNS
from ontime.streaming.incremental import ingest_new_archives, read_ingested
from tests.test_zipcsv import write_zip


def csv_text(dates):
    lines = [",".join(RAW_COLUMNS)]
    for i, d in enumerate(dates):
        row = {c: "" for c in RAW_COLUMNS}
        row.update(FlightDate=d, Reporting_Airline="AA", Cancelled="0.00", Flight_Number_Reporting_Airline=str(i))
        lines.append(",".join(row[c] for c in RAW_COLUMNS))
    return "\n".join(lines) + "\n"


def test_incremental_ingest_only_new_archives(spark, scratch):
    raw, out, ckpt = f"{scratch}/raw", f"{scratch}/out", f"{scratch}/ckpt"
    write_zip(f"{raw}/year=2019/month=1/a.zip", {"a.csv": csv_text(["2019-01-01", "2019-01-02"])})
    write_zip(f"{raw}/year=2019/month=2/b.zip", {"b.csv": csv_text(["2019-02-01"])})
    assert ingest_new_archives(spark, raw, out, ckpt)["archives"] == 2
    assert read_ingested(spark, out).count() == 3
    assert ingest_new_archives(spark, raw, out, ckpt)["archives"] == 0      # re-run: nothing new
    assert read_ingested(spark, out).count() == 3
    write_zip(f"{raw}/year=2019/month=3/c.zip", {"c.csv": csv_text(["2019-03-01", "2019-03-02"])})
    assert ingest_new_archives(spark, raw, out, ckpt)["archives"] == 1
    df = read_ingested(spark, out)
    assert df.count() == 5 and sorted(r.month for r in df.select("month").distinct().collect()) == [1, 2, 3]
