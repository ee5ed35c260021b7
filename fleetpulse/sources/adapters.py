"""Feed-shaped tables out of the benchmark star schema, so that every job has data to run on.

All columns are functions of one input row; nothing is generated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(EVENTS_DDL).option("pathGlobFilter", "events.parquet*")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(sf_dir)


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _instant() -> Column:
    return F.col("ts").cast("timestamp")


def trip_columns() -> list[Column]:
    """Some routes are blank, some start times and delays missing."""
    hour, n = F.hour("ts"), F.col("event_id")
    start = F.concat_ws(
        ":",
        F.lpad(F.when(hour < 4, hour + 24).otherwise(hour).cast("string"), 2, "0"),
        F.date_format("ts", "mm:ss"),
    )
    return [
        _text("S", F.col("user_id")).alias("id"),
        _text("T", F.col("user_id") % 40).alias("trip_id"),
        F.when(n % 71 == 3, "").otherwise(_text("R", F.col("user_id") % 30)).alias("route_id"),
        (n % 2).cast("int").alias("direction_id"),
        F.when(n % 83 != 5, start).alias("start_time"),
        F.date_format("ts", "yyyyMMdd").alias("start_date"),
        F.lit(0).alias("schedule_relationship"),
        F.when(n % 61 != 7, F.floor(F.col("value") * 10) - 200).cast("int").alias("delay"),
        F.unix_timestamp(F.date_trunc("hour", _instant())).alias("timestamp"),
        (F.col("event_type") == "error").alias("is_deleted"),
    ]


def trip_updates(events: DataFrame) -> DataFrame:
    """Trip update records. Clocks are whole hours, so a trip is now and then sent twice."""
    return events.select(*trip_columns(), "event_id", "ts")


def bronze_trip_updates(events: DataFrame) -> DataFrame:
    """Trip updates as they lie in bronze; the payload column is left out."""
    return trip_updates(events).select(
        _text("E", F.col("event_id")).alias("event_id"),
        (_instant() + F.make_dt_interval(secs=F.col("event_id") % 60)).alias("ingested_at"),
        F.col("id").alias("source_id"),
        *("trip_id", "route_id", "direction_id", "start_time", "start_date", "schedule_relationship", "delay"),
        F.timestamp_seconds("timestamp").alias("event_ts"),
        "is_deleted",
    )


def position_columns() -> list[Column]:
    """Steps of some 6.7 m, so that two stay within a stall's radius and three do not. Vehicles change route in the
    evening, errors lie outside the service area, and some readings are not on the globe."""
    n, north = F.col("event_id"), F.lit(-36.85) + F.floor(F.col("value") / 50) * F.lit(0.00006)
    evening = F.when(F.hour("ts") >= 18, 1).otherwise(0)
    return [
        _text("V", F.col("user_id") % 30).alias("vehicle_id"),
        _text("D", F.dayofmonth("ts")).alias("trip_id"),
        _text("R", (F.col("user_id") + evening) % 30).alias("route_id"),
        F.when(n % 97 == 11, 123.0).when(F.col("event_type") == "error", 0.0).otherwise(north).alias("latitude"),
        F.lit(174.76).alias("longitude"),
        F.col("value").cast("float").alias("bearing"),
        F.when(F.col("event_type") != "signup", F.col("value")).cast("float").alias("speed"),
        (F.col("event_id") % 20).cast("int").alias("current_stop_sequence"),
        _text("P", F.col("event_id") % 20).alias("stop_id"),
        F.when(F.col("event_type") == "view", "STOPPED_AT").otherwise("IN_TRANSIT_TO").alias("current_status"),
        F.lit(None).cast("string").alias("congestion_level"),
        (F.col("event_id") % 7).cast("string").alias("occupancy_status"),
        F.unix_timestamp(_instant()).alias("timestamp"),
    ]


def vehicle_positions(events: DataFrame) -> DataFrame:
    return events.select(*position_columns(), "event_id", "ts")


def bronze_vehicle_positions(events: DataFrame) -> DataFrame:
    """Some readings have no route."""
    routed = vehicle_positions(events).withColumn("route_id", F.when(F.col("event_id") % 89 != 2, F.col("route_id")))
    return routed.select(
        _text("E", F.col("event_id")).alias("event_id"),
        (_instant() + F.make_dt_interval(secs=F.col("event_id") % 60)).alias("ingested_at"),
        *("vehicle_id", "trip_id", "route_id", "latitude", "longitude", "bearing", "speed"),
        *("current_stop_sequence", "stop_id", "current_status"),
        F.date_trunc("hour", F.timestamp_seconds("timestamp")).alias("event_ts"),
    )


def notice_columns() -> list[Column]:
    clock = F.unix_timestamp(_instant())
    return [
        F.col("event_id").cast("string").alias("id"),
        _text("R", F.col("user_id") % 30).alias("route_id"),
        F.col("event_type").alias("cause"),
        F.when(F.col("event_id") % 3 == 0, "DETOUR").otherwise("DELAYS").alias("effect"),
        F.concat(F.lit("notice "), F.col("event_id").cast("string")).alias("header_text"),
        F.col("props").alias("description_text"),
        (clock - 3600).alias("active_period_start"),
        (clock + 3600).alias("active_period_end"),
        clock.alias("timestamp"),
    ]


def service_alerts(events: DataFrame) -> DataFrame:
    return events.select(*notice_columns())


def routes_seed(nation: DataFrame, blanks: bool = True) -> DataFrame:
    """Some routes have no id, unless ``blanks`` is false."""
    name = _text("R", F.col("n_nationkey"))
    return nation.select(
        (F.when(F.col("n_nationkey") % 12 != 11, name) if blanks else name).alias("route_id"),
        F.col("n_name").alias("route_short_name"),
        F.concat(F.lit("Line "), F.col("n_name")).alias("route_long_name"),
        F.col("n_regionkey").alias("route_type"),
    )


def stops_seed(supplier: DataFrame) -> DataFrame:
    """Some stops have no name."""
    return supplier.select(
        F.col("s_suppkey").cast("string").alias("stop_id"),
        F.when(F.col("s_suppkey") % 9 != 4, F.col("s_name")).alias("stop_name"),
        (-(F.lit(30) + F.col("s_suppkey") % 20)).cast("double").alias("stop_lat"),
        (F.lit(160) + F.col("s_suppkey") % 25).cast("double").alias("stop_lon"),
        _text("C", F.col("s_suppkey")).alias("stop_code"),
    )


def feed_responses(events: DataFrame) -> DataFrame:
    """One nested feed document per event, with a vehicle, an update and a notice entity.

    Signups have no trip block, multiples of 7 no delay, multiples of 5 no affected route, and
    only deletions carry the flag, so that the readers' defaults are used. Notices list several
    routes, periods and translations, of which readers take the first.
    """
    rows = events.select(
        "event_id",
        "event_type",
        F.struct(*trip_columns()).alias("u"),
        F.struct(*position_columns()).alias("p"),
        F.struct(*notice_columns()).alias("n"),
    )

    def pick(struct: str, *names: str) -> list[Column]:
        return [F.col(f"{struct}.{c}").alias(c) for c in names]

    def unless(condition: Column, value: Column) -> Column:
        return F.when(~condition, value)

    signup = F.col("event_type") == "signup"
    vehicle = F.struct(
        F.struct(*pick("p", "latitude", "longitude", "bearing", "speed")).alias("position"),
        unless(signup, F.struct(*pick("p", "trip_id", "route_id"))).alias("trip"),
        *pick("p", "timestamp", "current_stop_sequence", "stop_id", "current_status", "congestion_level"),
        # A number in the document, text in the record.
        F.col("p.occupancy_status").cast("int").alias("occupancy_status"),
    )
    update = F.struct(
        F.struct(
            *pick("u", "trip_id"),
            unless(signup, F.col("u.route_id")).alias("route_id"),
            *pick("u", "direction_id", "start_time", "start_date", "schedule_relationship"),
        ).alias("trip"),
        unless(F.col("event_id") % 7 == 0, F.col("u.delay")).alias("delay"),
        *pick("u", "timestamp"),
    )

    def words(column: str) -> Column:
        second = F.concat(F.lit("mi: "), F.col(column))
        return F.struct(F.array(*[F.struct(c.alias("text")) for c in (F.col(column), second)]).alias("translation"))

    nowhere = F.col("event_id") % 5 == 0
    notice = F.struct(
        unless(nowhere, F.array(*[F.struct(c.alias("route_id")) for c in (F.col("n.route_id"), F.lit("R99"))])).alias("informed_entity"),
        F.array(*[
            F.struct((F.col("n.active_period_start") + s).alias("start"), (F.col("n.active_period_end") + s).alias("end"))
            for s in (0, 86_400)
        ]).alias("active_period"),
        words("n.header_text").alias("header_text"),
        words("n.description_text").alias("description_text"),
        *pick("n", "cause", "effect"),
    )

    def entity(ident: str, **parts: Column) -> Column:
        slots = {"is_deleted": F.lit(None).cast("boolean"), "timestamp": F.lit(None).cast("bigint"),
                 "vehicle": F.lit(None), "trip_update": F.lit(None), "alert": F.lit(None)} | parts
        return F.to_json(F.struct(F.col(ident).alias("id"), *[v.alias(k) for k, v in slots.items()]))

    entities = [
        entity("p.vehicle_id", vehicle=vehicle),
        entity("u.id", trip_update=update, is_deleted=F.when(F.col("u.is_deleted"), True)),
        entity("n.id", alert=notice, timestamp=F.col("n.timestamp")),
    ]
    document = F.concat(F.lit('{"response":{"entity":['), F.concat_ws(",", *entities), F.lit("]}}"))
    return rows.select(document.alias("value"))
