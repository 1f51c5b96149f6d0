import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cityweave.functions import bins, geo, times
from cityweave.functions.chisquare import tail_probability


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_timestamps_parse_or_become_null(spark):
    texts = [
        ("03/01/2020 12:00:00 AM", dt.datetime(2020, 3, 1, 0, 0, 0)),
        ("03/01/2020 12:30:15 PM", dt.datetime(2020, 3, 1, 12, 30, 15)),
        ("03/01/2020 01:05:00 PM", dt.datetime(2020, 3, 1, 13, 5, 0)),
        ("02/29/2020 11:59:59 PM", dt.datetime(2020, 2, 29, 23, 59, 59)),
        ("02/29/2021 11:59:59 PM", None),
        ("13/01/2020 01:00:00 AM", None),
        ("03/01/2020 13:00:00 AM", None),
        ("03/01/2020 00:10:00 AM", None),
        ("03/01/2020 01:60:00 AM", None),
        ("03/01/2020 01:00:60 AM", None),
        ("x03/01/2020 01:00:00 AM", None),
        ("03/01/2020 01:00:00 AM ", None),
        ("03/01/2020", None),
        ("unknown", None),
        (None, None),
    ]
    got = values(spark, [(t,) for t, _ in texts], "t string", "t", times.parse_timestamp("t"))
    assert got == texts


def test_local_times_in_a_daylight_saving_gap_stay_as_written(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = values(spark, [("03/08/2020 02:30:00 AM",)], "t string", times.parse_timestamp("t").cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == [("2020-03-08 02:30:00",)]


def test_dates_parse_or_become_null(spark):
    rows = [("01/31/2020",), ("02/30/2020",), ("n/a",), ("1/31/2020",), ("01/31/2020 ",), (None,)]
    got = values(spark, rows, "t string", times.parse_date("t"))
    assert got == [(dt.datetime(2020, 1, 31),), (None,), (None,), (None,), (None,), (None,)]


def test_strict_parsing_fails_on_bad_text(spark):
    strict = times.parse_strict("t", times.parse_date("t"))
    assert values(spark, [("01/31/2020",), (None,)], "t string", strict) == [(dt.datetime(2020, 1, 31),), (None,)]
    with pytest.raises(Exception, match="cannot parse date text: n/a"):
        values(spark, [("n/a",)], "t string", strict)


def test_weekday_hour_and_month(spark):
    rows = [(dt.datetime(2020, 3, 1), 2130), (dt.datetime(2020, 3, 2), 59), (None, None)]
    got = values(
        spark, rows, "d timestamp_ntz, h int", times.weekday_name("d"), times.weekday_rank(times.weekday_name("d")),
        times.military_hour("h"), times.month_start(F.year("d"), F.month("d")),
    )
    assert got == [
        ("Sunday", 7, 21, dt.date(2020, 3, 1)), ("Monday", 1, 0, dt.date(2020, 3, 1)), (None, None, None, None)
    ]


def test_coordinate_text(spark):
    rows = [("(34.05, -118.25)",), ("(34, -118)",), ("(abc, def)",), ("34.05, -118.25",), ("",), (None,)]
    got = values(
        spark, rows, "t string", geo.as_written(geo.narrow_latitude("t")), geo.as_written(geo.narrow_longitude("t")),
        geo.loose_latitude("t"), geo.loose_longitude("t"),
    )
    assert got == [
        (34.05, -118.25, 34.05, -118.25), (None, None, 34.0, -118.0), (None,) * 4, (None,) * 4, (None,) * 4, (None,) * 4
    ]


def test_bands_include_their_upper_edge_and_unknown_is_far(spark):
    rows = [(0.0,), (10.0,), (10.000001,), (20.0,), (20.000001,), (None,)]
    got = [r[0] for r in values(spark, rows, "d double", geo.distance_band("d"))]
    assert got == ["0-10km", "0-10km", "10-20km", "10-20km", ">20km", ">20km"]


def test_distances(spark):
    rows = [(geo.CENTRE_LAT, geo.CENTRE_LON), (geo.CENTRE_LAT + 1, geo.CENTRE_LON), (None, None), (float("nan"), 0.0)]
    got = values(spark, rows, "lat double, lon double", geo.planar_km("lat", "lon"), geo.haversine_km("lat", "lon"))
    assert got[0] == (0.0, 0.0)
    assert got[1][0] == pytest.approx(111) and got[1][1] == pytest.approx(6371 * math.pi / 180)
    assert got[2] == (None, None)
    assert all(math.isnan(v) for v in got[3])


def test_metres_are_cut_and_opposite_points_stay_finite(spark):
    rows = [(0.0, 0.0, 0.01, 0.0), (0.0, 0.0, 180.0, 0.0), (None, 0.0, 0.0, 0.0)]
    got = values(spark, rows, "a double, b double, c double, d double", geo.haversine_m("a", "b", "c", "d"))
    assert got == [(1111,), (20015086,), (None,)]


def test_cells(spark):
    rows = [(34.0567, -118.2437), (-0.005, 0.005), (None, 1.0)]
    got = values(
        spark, rows, "lat double, lon double", geo.cell_index("lat", 0.01), geo.cell_index("lon", 0.01), geo.cell_name("lat", "lon")
    )
    assert got == [(3405, -11825, "3405,-11824"), (-1, 0, "0,0"), (None, 100, None)]


def test_bins_are_right_closed_and_drop_the_lowest_edge(spark):
    hours = [r[0] for r in values(spark, [(h,) for h in (0, 1, 6, 7, 12, 18, 19, 24, 25, None)], "h int", bins.HOURS.rank("h"))]
    assert hours == [None, 1, 1, 2, 2, 3, 4, 4, None, None]
    far = values(spark, [(d,) for d in (0.0, 5.0, 20.0, 1e9, float("nan"), None)], "d double", bins.DISTANCES.label("d"))
    assert [r[0] for r in far] == [None, "0-5 km", "15-20 km", "20+ km", None, None]


def test_chi_square_tail(spark):
    # Published critical values of the chi-square distribution.
    table = [(3.841458820694124, 1, 0.05), (6.634896601021213, 1, 0.01), (5.991464547107979, 2, 0.05),
             (11.070497693516351, 5, 0.05), (21.02606981748307, 12, 0.05), (24.99579013972863, 15, 0.05),
             (10.827566170662733, 1, 0.001), (124.34211340400407, 100, 0.05)]
    got = values(spark, [(x, d) for x, d, _ in table], "x double, d int", tail_probability(F.col("x"), F.col("d")))
    assert [g[0] for g in got] == pytest.approx([p for _, _, p in table], rel=1e-10)
    ends = values(spark, [(0.0, 3), (5000.0, 3), (2000.0, 2000), (1.0, 0)], "x double, d int", tail_probability(F.col("x"), F.col("d")))
    assert ends[0][0] == 1.0 and ends[1][0] == pytest.approx(0, abs=1e-300) and 0.49 < ends[2][0] < 0.51 and ends[3][0] is None


def test_chi_square_tail_of_very_many_degrees_of_freedom(spark):
    """Against the finite sum of Poisson terms, and where the sum meets the expansion."""

    def summed(x, dof):
        h = x / 2
        return math.fsum(math.exp(i * math.log(h) - h - math.lgamma(i + 1)) for i in range(dof // 2))

    rows = [(float(d + k * math.sqrt(2 * d)), d) for d in (2000, 2002, 5000, 100_000) for k in (-3, -1, -0.01, 0, 0.3, 2, 4)]
    got = values(spark, rows, "x double, d long", tail_probability(F.col("x"), F.col("d")))
    assert [r[0] for r in got] == pytest.approx([summed(x, d) for x, d in rows], abs=1e-6)
    huge = values(spark, [(4.2e9, 4_200_000_000)], "x double, d long", tail_probability(F.col("x"), F.col("d")))
    assert huge[0][0] == pytest.approx(0.5, abs=1e-4)
