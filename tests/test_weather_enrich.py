import datetime as dt

from ontime.operators.enrich import enrich
from ontime.operators.weather import dedupe_weather, parse_weather
from ontime.schema import CLEAN_COLUMNS, ENRICHED_COLUMNS, clean_schema

RAW_WX = ("stn string, wban string, year string, mo string, da string, temp string, dewp string, slp string, "
          "visib string, wdsp string, mxpsd string, gust string, max string, min string, prcp string, sndp string, "
          "fog string, rain_drizzle string, snow_ice_pellets string, hail string, thunder string, "
          "tornado_funnel_cloud string")


def wx(stn, wban, y, m, d, wdsp="5.0", visib="10.0", prcp="0.00", temp="50.0"):
    return (stn, wban, y, m, d, temp, "40.0", "1010.0", visib, wdsp, "9.0", "999.9", "60.0", "40.0", prcp, "999.9",
            "0", "1", "0", "0", "0", "0")


def test_parse_and_dedupe(spark):
    raw = spark.createDataFrame([
        wx("722", "10001", "2020", "01", "05", temp="50.0"),
        wx("721", "10001", "2020", "01", "05", temp="60.0"),   # lower stn wins
        wx("700", "10001", "2020", "02", "30"),                # impossible date -> dropped
        wx("700", "99999", "2020", "01", "05"),                # sentinel station
        wx("700", "10001", None, "01", "05"),                  # missing year -> no date
    ], RAW_WX)
    w = parse_weather(raw)
    assert w.count() == 4
    d = dedupe_weather(w).collect()
    assert len(d) == 1 and d[0].temp == 60.0 and d[0].weather_date == dt.date(2020, 1, 5)


def test_sentinels_kept_by_default_nulled_on_request(spark):
    raw = spark.createDataFrame([wx("1", "10001", "2020", "01", "05", wdsp="999.9", visib="999.9",
                                    prcp="99.99")], RAW_WX)
    a = parse_weather(raw).first()
    b = parse_weather(raw, nullify_sentinels=True).first()
    assert (a.wdsp, a.visib, a.prcp) == (999.9, 999.9, 99.99)
    assert (b.wdsp, b.visib, b.prcp) == (None, None, None)


def test_enrich_keeps_every_flight(spark):
    def flight(date, origin, dest):
        row = {c: None for c in CLEAN_COLUMNS}
        row.update(flight_date=date, origin=origin, dest=dest, reporting_airline="AA", cancelled=0)
        return tuple(row[c] for c in CLEAN_COLUMNS)

    d1 = dt.date(2020, 1, 5)
    flights = spark.createDataFrame([flight(d1, "AAA", "BBB"), flight(d1, "CCC", "AAA"),
                                     flight(dt.date(2020, 1, 6), "AAA", "AAA")], clean_schema())
    mapping = spark.createDataFrame([("AAA", "10001", 3.0), ("BBB", "10002", 4.0)],
                                    "iata string, station_id string, distance_km double")
    weather = parse_weather(spark.createDataFrame([
        wx("1", "10001", "2020", "01", "05", wdsp="7.0"), wx("2", "10001", "2020", "01", "05", wdsp="9.0"),
        wx("1", "10002", "2020", "01", "05", wdsp="3.0")], RAW_WX))
    out = enrich(flights, mapping, weather)
    assert out.columns == ENRICHED_COLUMNS
    rows = sorted(out.collect(), key=lambda r: (r.flight_date, r.origin))
    assert len(rows) == 3                                   # no fan-out from the duplicate reading
    assert (rows[0].origin_station, rows[0].origin_wdsp, rows[0].dest_wdsp) == ("10001", 7.0, 3.0)
    assert (rows[1].origin_station, rows[1].origin_wdsp, rows[1].dest_wdsp) == (None, None, 7.0)  # CCC unmapped
    assert rows[2].origin_wdsp is None                      # no reading that day


def test_shuffle_path_equals_broadcast_path(spark):
    from ontime.plans import chain
    d = "/root/testdata/sf0.001"
    from ontime.sources import testbed as tb
    args = (tb.flights(spark, d), chain.mapping(spark, d), chain.weather(spark, d))
    a = enrich(*args)
    ra = sorted(map(tuple, a.collect()), key=str)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = enrich(*args, max_broadcast_bytes=0)        # forces the salted shuffle joins
        rb = sorted(map(tuple, b.collect()), key=str)
        plan = b._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert len(ra) == len(rb) > 0 and ra == rb
    assert any(r.origin_station is None for r in a.collect())   # unmatched airports exist
