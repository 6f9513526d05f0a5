import math
import random

from ontime.operators import geo

R = 6371.0


def hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(d) - math.radians(b)) / 2) ** 2
    return 2 * R * math.asin(math.sqrt(h))


ST_SCHEMA = "wban string, usaf string, country string, lat double, lon double, `end` string"
AP_SCHEMA = "faa_identifier string, name string, latitude double, longitude double"


def test_station_filters(spark):
    rows = [("10001", "1", "CA", 40.0, -100.0, "20240101"),
            (None, "2", "US", 40.0, -100.0, "20240101"),
            ("99999", "3", "US", 40.0, -100.0, "20240101"),
            ("10004", "4", "US", 40.0, -100.0, "20181231"),
            ("10005", "5", "US", 40.0, -100.0, "20190101"),
            ("10006", "6", "US", None, -100.0, "20240101")]
    got = geo.active_stations(spark.createDataFrame(rows, ST_SCHEMA)).collect()
    assert [r.station_id for r in got] == ["10005"]


def test_station_duplicate_takes_coordinates_from_latest_row(spark):
    rows = [("10001", "700001", "US", 40.0, -100.0, "20200101"),
            ("10001", "700002", "US", 41.0, -101.0, "20240101"),
            ("10001", "700000", "US", 42.0, -102.0, "20240101")]
    r = geo.active_stations(spark.createDataFrame(rows, ST_SCHEMA)).first()
    assert (r.st_lat, r.st_lon) == (41.0, -101.0)   # latest end, then highest usaf


def _ap(spark, rows):
    from ontime.sources.tables import airports
    return airports(spark.createDataFrame(rows, AP_SCHEMA))


def _st(spark, rows):
    return spark.createDataFrame(rows, "station_id string, st_lat double, st_lon double")


def test_box_is_strict(spark):
    a = _ap(spark, [("AAA", "a", 40.0, -100.0)])
    s = _st(spark, [("S1", 40.75, -100.0), ("S2", 40.5, -100.0), ("S3", 40.0, -99.25)])
    got = {r.station_id for r in geo.box_pairs(a, s, 0.75).collect()}
    assert got == {"S2"}


def test_high_latitude_box_misses_exact_finds(spark):
    # 65N, station 0.9 deg east ~ 42 km: outside the 0.75 deg box, inside 50 km
    a = _ap(spark, [("FAI", "f", 65.0, -147.0)])
    s = _st(spark, [("S1", 65.0, -146.1)])
    assert geo.station_candidates(a, s, 50.0, 0.75, "box").count() == 0
    got = geo.station_candidates(a, s, 50.0, mode="exact").collect()
    assert len(got) == 1 and abs(got[0].distance_km - hav(65.0, -147.0, 65.0, -146.1)) < 1e-6


def test_exact_mode_wraps_the_antimeridian(spark):
    a = _ap(spark, [("DATE", "d", 10.0, 179.9)])
    s = _st(spark, [("W", 10.0, -179.9)])
    assert geo.station_candidates(a, s, 50.0, mode="exact").count() == 1


def test_tie_goes_to_lower_station_id(spark):
    a = _ap(spark, [("AAA", "a", 40.0, -100.0)])
    s = _st(spark, [("S9", 40.1, -100.0), ("S1", 39.9, -100.0)])
    r = geo.nearest(geo.station_candidates(a, s)).first()
    assert r.station_id == "S1"


def test_airport_without_station_is_absent(spark):
    a = _ap(spark, [("AAA", "a", 40.0, -100.0), ("BBB", "b", 10.0, 10.0)])
    s = _st(spark, [("S1", 40.1, -100.0)])
    assert {r.iata for r in geo.nearest(geo.station_candidates(a, s)).collect()} == {"AAA"}


def _random_points(n, seed, lat=(20, 70), lon=(-180, 180)):
    rnd = random.Random(seed)
    return [(f"P{i}", rnd.uniform(*lat), rnd.uniform(*lon)) for i in range(n)]


def test_grid_box_join_equals_brute_force(spark):
    left = _random_points(300, 1, (30, 40), (-100, -90))
    right = _random_points(2000, 2, (30, 40), (-100, -90))
    a = spark.createDataFrame(left, "iata string, ap_lat double, ap_lon double")
    s = _st(spark, right)
    got = {(r.iata, r.station_id) for r in geo.box_pairs(a, s, 0.75).collect()}
    want = {(p, q) for p, pa, po in left for q, qa, qo in right if abs(pa - qa) < 0.75 and abs(po - qo) < 0.75}
    assert got == want and len(want) > 1000


def test_radius_join_equals_brute_force(spark):
    left = _random_points(200, 3, (-89, 89)) + [("N", 89.9, 0.0), ("E", 0.0, 179.95)]
    right = _random_points(3000, 4, (-89.99, 89.99)) + [("n", 89.8, 120.0), ("e", 0.1, -179.95)]
    a = spark.createDataFrame(left, "iata string, ap_lat double, ap_lon double")
    s = _st(spark, right)
    got = {(r.iata, r.station_id) for r in geo.station_candidates(a, s, 500.0, mode="exact").collect()}
    want = {(p, q) for p, pa, po in left for q, qa, qo in right if hav(pa, po, qa, qo) < 500.0}
    assert got == want and ("N", "n") in want and ("E", "e") in want
