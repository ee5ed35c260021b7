import pytest
from pyspark.sql import functions as F

from fleetpulse import contracts
from fleetpulse.operators.delay import detect_delays, severity, tier_names


def updates(spark, *delays):
    schema = "id string, trip_id string, route_id string, direction_id int, start_time string, start_date string, " \
             "schedule_relationship int, delay int, timestamp bigint, is_deleted boolean"
    return spark.createDataFrame(
        [(f"trip-{i}", "T100", "R200", 0, "08:00:00", "20260327", 0, d, 1774345000, False) for i, d in enumerate(delays)],
        schema,
    )


@pytest.mark.parametrize("delay,tier", [(301, "MODERATE"), (600, "MODERATE"), (601, "HIGH"), (1200, "HIGH"),
                                        (1201, "SEVERE"), (5000, "SEVERE")])
def test_tiers(spark, delay, tier):
    assert detect_delays(updates(spark, delay)).first().severity == tier


def test_threshold_is_strict_and_drops_early_and_unknown(spark):
    assert detect_delays(updates(spark, -120, 0, 300, None)).count() == 0
    assert detect_delays(updates(spark, -120, 300, 301, 400)).count() == 2


def test_columns_match_the_contract(spark):
    got = detect_delays(updates(spark, 400))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in contracts.DELAY_ALERT]
    assert got.first().event_timestamp == 1774345000


def test_same_update_same_id(spark):
    one = {r.event_id for r in detect_delays(updates(spark, 400, 500)).collect()}
    assert one == {r.event_id for r in detect_delays(updates(spark, 400, 500)).collect()} and len(one) == 2


def test_own_threshold_and_tiers(spark):
    rows = detect_delays(updates(spark, 100), threshold_s=60, tiers=((90, "A"), (120, "B")))
    assert rows.first().severity == "B"
    assert tier_names() == ["MODERATE", "HIGH", "SEVERE"]
    assert spark.range(1).select(severity(F.lit(7), ((9, "X"),), "Y")).first()[0] == "X"
