import pytest
from pyspark.sql import functions as F

from fleetpulse.functions import timecols as tc
from fleetpulse.functions.geo import COUNTRY, SERVICE_AREA, haversine_m, in_box
from fleetpulse.functions.keys import natural_key

NOW = 1_774_345_000


def column(spark, values, expr, dtype="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v"))).collect()]


CLOCKS = [1_599_999_999, NOW - 3601, NOW - 3600, NOW, NOW + 300, NOW + 301, None]


def test_status_of_every_bound(spark):
    got = column(spark, CLOCKS, lambda c: tc.ts_status(c, NOW), "bigint")
    assert got == ["dropped_invalid", "clamped_past", "ok", "ok", "ok", "clamped_future", "missing"]


def test_clamp_of_every_bound(spark):
    got = column(spark, CLOCKS, lambda c: tc.ts_clamped(c, NOW), "bigint")
    assert got == [NOW - 3600, NOW - 3600, NOW - 3600, NOW, NOW + 300, NOW + 300, None]


def test_clock_defaults_to_now(spark):
    got = spark.range(1).select(tc.ts_status(F.unix_timestamp() - 10)).first()[0]
    assert got == "ok"


def test_clock_seconds_accepts_late_hours_and_survives_junk(spark):
    texts = ["08:00:00", "24:10:00", "27:59:59", "08:00", "", "a:b:c", None, "99999999:00:00"]
    got = column(spark, texts, tc.clock_seconds)
    assert got == [28_800, 87_000, 100_799, None, None, None, None, 99_999_999 * 3600]


def test_local_date_follows_daylight_saving(spark):
    got = spark.sql("select timestamp'2026-03-27 12:30:00' a, timestamp'2026-06-27 12:30:00' b").select(
        tc.local_date(F.col("a")).cast("string"), tc.local_hour(F.col("a")), tc.local_hour(F.col("b"))
    ).first()
    assert tuple(got) == ("2026-03-28", 1, 0)


def test_flexible_ts(spark):
    got = column(spark, ["1704067200", "2024-01-01T00:00:00.000Z", "2024-01-01 00:00:00", "soon", None],
                 lambda c: tc.flexible_ts(c).cast("string"))
    assert got == ["2024-01-01 00:00:00"] * 3 + [None, None]


def test_display_time_keeps_naive_text_as_local(spark):
    got = column(spark, ["1704067200", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00", "x", None], tc.display_time)
    assert got == ["2024-01-01 13:00:00", "2024-01-01 13:00:00", "2024-01-01 00:00:00", None, None]


@pytest.mark.parametrize("clock,tier", [
    ("05:59", "offpeak"), ("06:00", "peak"), ("08:59", "peak"), ("09:00", "shoulder"), ("14:59", "shoulder"),
    ("15:00", "peak"), ("18:29", "peak"), ("18:30", "shoulder"), ("21:59", "shoulder"), ("22:00", "offpeak"),
    ("00:00", "offpeak"),
])
def test_service_period_bounds(spark, clock, tier):
    got = spark.range(1).select(tc.service_period(F.lit(f"2024-05-05 {clock}:00").cast("timestamp"))).first()[0]
    assert got == tier


def test_rounding_ignores_float_noise(spark):
    got = column(spark, [0.125, 1.005, 2.675, -0.125, None], lambda c: tc.rounded(c, 2), "double")
    assert got == [0.13, 1.01, 2.68, -0.13, None]


def test_haversine(spark):
    def metres(*p):
        return spark.range(1).select(haversine_m(*[F.lit(float(x)) for x in p])).first()[0]

    assert metres(-36.84, 174.76, -36.84, 174.76) == 0.0
    assert 100 < metres(-36.840, 174.760, -36.839, 174.760) < 120
    assert metres(-36.84, 174.76, -36.83995, 174.76) < 15
    assert metres(0, 0, 0, 180) == pytest.approx(3.141592653589793 * 6_371_000)


def test_box_includes_its_edges(spark):
    def inside(lat, lon, box):
        return spark.range(1).select(in_box(F.lit(lat), F.lit(lon), box)).first()[0]

    assert inside(-37.05, 174.62, SERVICE_AREA) and inside(-36.60, 174.95, SERVICE_AREA)
    assert not inside(-37.06, 174.7, SERVICE_AREA) and not inside(-36.8, 174.96, SERVICE_AREA)
    assert inside(-34.0, 166.0, COUNTRY)


def test_natural_key_separates_kinds_and_nulls(spark):
    row = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    one, same, other = row.select(
        natural_key("k", "x", "y", "z"), natural_key("k", "x", "y", "z"), natural_key("l", "x", "y", "z")
    ).first()
    assert one == same != other and len(one) == 64


def test_natural_keys_do_not_collide(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ('a","b', None)], "x string, y string")
    assert rows.select(natural_key("k", "x", "y").alias("id")).distinct().count() == 5
