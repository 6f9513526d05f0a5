from ontime.operators.clean import clean_flights
from ontime.schema import CLEAN_COLUMNS, RAW_COLUMNS, clean_schema


def raw_row(**kw):
    row = {c: "" for c in RAW_COLUMNS}
    row.update(kw)
    return tuple(row[c] for c in RAW_COLUMNS)


def test_clean_schema_and_derivations(spark):
    rows = [
        raw_row(FlightDate="2020-02-03", Reporting_Airline="AA", Origin="JFK", Dest="LAX", CRSDepTime="0555",
                ArrDel15="1.00", Cancelled="0.00", Diverted="0.00", ArrDelayMinutes="17.00", Distance="2475.00"),
        raw_row(FlightDate="2020-02-30", Cancelled="1.00"),           # impossible date -> dropped
        raw_row(FlightDate="", Cancelled="1.00"),                     # missing date -> dropped
        raw_row(FlightDate="2019-12-31", Cancelled="1.00", CRSDepTime="2400"),
    ]
    df = clean_flights(spark.createDataFrame(rows, ",".join(f"{c} string" for c in RAW_COLUMNS)))
    assert df.columns == CLEAN_COLUMNS
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in clean_schema().fields]
    got = sorted(df.collect(), key=lambda r: r.flight_date)
    assert len(got) == 2
    a, b = got
    assert (a.year, a.month, a.dep_hour, a.is_delayed_15) == (2019, 12, 24, 1)
    assert (b.year, b.month, b.crs_dep_time, b.dep_hour, b.is_delayed_15, b.distance) == (2020, 2, 555, 5, 1, 2475)
    assert b.day_of_week == 2  # 2020-02-03 was a Monday


def test_year_month_come_from_the_date_not_the_path(spark):
    # the row would sit under year=2019/month=1 in the archive layout; its date decides
    rows = [raw_row(FlightDate="2020-02-14")]
    df = clean_flights(spark.createDataFrame(rows, ",".join(f"{c} string" for c in RAW_COLUMNS)))
    r = df.first()
    assert (r.year, r.month) == (2020, 2)
