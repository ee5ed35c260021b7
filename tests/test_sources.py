import json

import pytest
from pyspark.sql import functions as F

from fleetpulse import contracts
from fleetpulse.config import Settings
from fleetpulse.operators.live import latest_messages
from fleetpulse.sources import feed_json as fj
from fleetpulse.sources import messages as ms
from fleetpulse.sources import tables


def test_local_and_managed_settings():
    local, cloud = Settings(), Settings(connection_string="Endpoint=sb://x/")
    assert local.topic("alerts") == "at.alerts" and cloud.topic("alerts") == "alerts"
    assert local.header_bytes == 5 and cloud.header_bytes == 0 and Settings(payload_codec="json").header_bytes == 0
    assert ms.broker_options(local) == {"kafka.bootstrap.servers": "localhost:9092"}
    opts = ms.broker_options(cloud)
    assert opts["kafka.security.protocol"] == "SASL_SSL" and opts["kafka.sasl.mechanism"] == "PLAIN"
    assert 'password="Endpoint=sb://x/"' in opts["kafka.sasl.jaas.config"]


def test_settings_from_environment():
    got = Settings.from_env({"OUTPUT_PATH": "/data/", "BRONZE_MAX_OFFSETS_PER_TRIGGER": "7", "OUTPUT_FORMAT": ""})
    assert got.table_path("alerts") == "/data/alerts" and got.bronze_rows_per_trigger == 7
    assert got.output_format == "delta" and got.trip_rows_per_trigger is None
    with pytest.raises(ValueError):
        got.checkpoint("q")


def test_kafka_reader_options():
    spec = ms.SourceSpec.kafka(Settings(), "trip_updates", 2000)
    stream, batch = spec.reader_options(True), spec.reader_options(False)
    assert (stream["subscribe"], stream["startingOffsets"], stream["maxOffsetsPerTrigger"]) == ("at.trip_updates", "earliest", "2000")
    assert batch["startingOffsets"] == "earliest" and "maxOffsetsPerTrigger" not in batch
    wide = ms.SourceSpec.kafka(Settings(min_read_partitions=64), "trip_updates").reader_options(True)
    assert wide["minPartitions"] == "64" and "minPartitions" not in stream


def test_file_spec_reads_as_batch_and_stream(spark, tmp_path):
    spark.createDataFrame([("k", "v")], "key string, value string").write.json(str(tmp_path / "t"))
    spec = ms.SourceSpec.files("json", str(tmp_path / "t"), files_per_trigger=1)
    assert ms.read_batch(spark, spec).collect()[0].value == "v"
    assert ms.read_stream(spark, spec).isStreaming
    assert spec.reader_options(True)["maxFilesPerTrigger"] == "1"


def test_decode_skips_the_header_and_keeps_the_raw_body(spark):
    body = json.dumps({"id": "a", "trip_id": "t", "route_id": "r", "delay": 5, "timestamp": 1, "is_deleted": False})
    framed = bytes([0, 0, 0, 0, 9]) + body.encode()
    raw = spark.createDataFrame([(bytearray(framed),), (bytearray(b"\0\0\0\0\1{broken"),)], "value binary")
    flat = ms.flatten(ms.decode(raw, contracts.TRIP_UPDATE, "json", header_bytes=5), contracts.TRIP_UPDATE)
    assert flat.columns == contracts.TRIP_UPDATE.fieldNames() + ["_raw_payload"]
    good, bad = flat.collect()
    assert (good.id, good.delay, good.direction_id) == ("a", 5, None) and bad.id is None
    assert flat.select(F.unbase64("_raw_payload")).first()[0] == framed
    head = ms.header_bytes(raw).first()
    assert (head.magic_byte, head.schema_id, head.body_bytes) == ("00", 9, len(framed))


def test_unknown_codec_is_refused(spark):
    with pytest.raises(ValueError):
        ms.decode(spark.createDataFrame([("x",)], "value string"), contracts.TRIP_UPDATE, "xml")


def test_avro_schema_text_follows_the_contract():
    schema = json.loads(contracts.avro_schema(contracts.TRIP_UPDATE, "TripUpdate"))
    types = {f["name"]: f["type"] for f in schema["fields"]}
    assert types["id"] == "string" and types["direction_id"] == ["null", "int"]
    assert types["timestamp"] == "long" and types["is_deleted"] == "boolean"
    assert [f["name"] for f in schema["fields"]] == contracts.TRIP_UPDATE.fieldNames()


def test_messages_drop_null_fields(spark):
    row = ms.to_messages(spark.createDataFrame([(1, None, "k")], "a int, b string, c string"), F.col("c")).first()
    assert row.key == "k" and json.loads(row.value) == {"a": 1, "c": "k"}
    assert spark.createDataFrame([(bytearray(b"hi"),)], "value binary").select(ms.payload_text()).first()[0] == "hi"


def test_newest_raw_messages(spark):
    df = spark.range(30).select(F.col("id").alias("offset"), F.lit("x").alias("value"))
    got = [r.offset for r in latest_messages(df).collect()]
    assert got == list(range(29, 9, -1))


RESPONSE = {"response": {"entity": [
    {"id": "v1", "vehicle": {"position": {"latitude": -36.8, "longitude": 174.7, "speed": 12}, "timestamp": 100,
                             "occupancy_status": 2}},
    {"id": "v2", "vehicle": {"position": {"latitude": 1, "longitude": 2}, "trip": {"trip_id": "t"}, "timestamp": 101}},
    {"id": "u1", "trip_update": {"trip": {"trip_id": "t"}, "timestamp": 5}},
    {"id": "u2", "is_deleted": True, "trip_update": {"trip": {"trip_id": "t", "route_id": "r", "start_time": "24:01:00"},
                                                     "delay": -7, "timestamp": 6}},
    {"id": "a1", "alert": {"informed_entity": [], "header_text": {"translation": [{"text": "hi"}, {"text": "no"}]}}},
    {"id": "a2", "timestamp": 9, "alert": {"informed_entity": [{"route_id": "r1"}, {"route_id": "r2"}],
                                           "active_period": [{"start": 1, "end": 2}, {"start": 3}], "cause": "C"}},
]}}


@pytest.fixture(scope="module")
def responses(spark):
    return spark.createDataFrame([(json.dumps(RESPONSE),), ("{oops",), ('{"response":{}}',)], "value string")


def test_feed_positions(responses):
    a, b = fj.positions_from_feed(fj.feed_entities(responses, "vehicle")).orderBy("vehicle_id").collect()
    assert (a.trip_id, a.route_id, a.speed, a.bearing, a.occupancy_status, a.timestamp) == ("", "", 12.0, None, "2", 100)
    assert (b.trip_id, b.route_id, b.occupancy_status) == ("t", "", None)


def test_feed_trip_updates(responses):
    a, b = fj.trip_updates_from_feed(fj.feed_entities(responses)).orderBy("id").collect()
    assert (a.delay, a.is_deleted, a.route_id, a.start_time) == (0, False, "", None)
    assert (b.delay, b.is_deleted, b.start_time) == (-7, True, "24:01:00")


def test_feed_service_alerts(responses):
    a, b = fj.service_alerts_from_feed(fj.feed_entities(responses, "alert"), now=77).orderBy("id").collect()
    assert (a.route_id, a.header_text, a.active_period_start, a.timestamp) == (None, "hi", None, 77)
    assert (b.route_id, b.active_period_start, b.active_period_end, b.timestamp, b.cause) == ("r1", 1, 2, 9, "C")


def test_feed_records_fit_the_contracts(responses):
    for fn, contract in ((fj.positions_from_feed, contracts.VEHICLE_POSITION),
                         (fj.trip_updates_from_feed, contracts.TRIP_UPDATE),
                         (fj.service_alerts_from_feed, contracts.SERVICE_ALERT)):
        got = fn(fj.feed_entities(responses)).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in contract]


def test_bronze_from_folder_and_catalog(spark, tmp_path):
    df = spark.range(4).select("id", F.lit("2024-01-01").cast("date").alias("event_date"), F.lit(3).alias("event_hour"))
    df.write.partitionBy("event_date", "event_hour").parquet(str(tmp_path / "bronze" / "trip_updates"))
    got = tables.read_bronze(spark, "trip_updates", str(tmp_path / "bronze"))
    assert got.count() == 4 and {"event_date", "event_hour"} <= set(got.columns)
    got.createOrReplaceTempView("some_bronze")
    assert tables.read_bronze(spark, "some_bronze").count() == 4
    assert tables.read_if_present(spark, str(tmp_path / "none")) is None


def test_schedule_files(spark, tmp_path):
    (tmp_path / "routes.csv").write_text(
        ",".join(contracts.ROUTES_SEED.fieldNames()) + "\n101-202,NZB,101,Long,,3,,,,,19\n")
    (tmp_path / "stops.csv").write_text(
        ",".join(contracts.STOPS_SEED.fieldNames()) + "\ns1,1,Stop,,-36.8,174.7,,,0,,,,1,20240101,\n")
    route = tables.read_routes(spark, str(tmp_path / "routes.csv")).first()
    stop = tables.read_stops(spark, str(tmp_path / "stops.csv")).first()
    assert (route.route_id, route.route_type, route.route_desc, route.contract_id) == ("101-202", 3, None, "19")
    assert (stop.stop_lat, stop.wheelchair_boarding, stop.end_date) == (-36.8, 1, None)
