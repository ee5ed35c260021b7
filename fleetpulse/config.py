"""Everything a deployment can set, in one place."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

# Broker topic names (without the local prefix) and the local prefix.
TOPIC_POSITIONS = "vehicle_positions"
TOPIC_TRIPS = "trip_updates"
TOPIC_SERVICE_ALERTS = "service_alerts"
TOPIC_ALERTS = "alerts"
TOPIC_HEADWAY = "headway_metrics"
LOCAL_TOPIC_PREFIX = "at."

# Fixed value: zone in which service dates and hours are counted.
LOCAL_ZONE = "Pacific/Auckland"


@dataclass(frozen=True)
class Settings:
    bootstrap_servers: str = "localhost:9092"
    # Non-empty: managed broker (SASL_SSL, bare topic names, payloads without a header).
    connection_string: str = ""
    # A first start reads what the topic still holds.
    starting_offsets: str = "earliest"
    payload_codec: str = "avro"
    # In front of topic names on a broker without a connection string.
    topic_prefix: str = LOCAL_TOPIC_PREFIX
    # Rows of one trigger at most; None sets no limit, so no backlog outlives its topic.
    bronze_rows_per_trigger: int | None = None
    trip_rows_per_trigger: int | None = None
    position_rows_per_trigger: int | None = None
    # Splits broker partitions over more read tasks when a topic has few of them.
    min_read_partitions: int | None = None
    # Folders that all executors share; a job that needs one raises if it is not set.
    output_path: str = ""
    checkpoint_path: str = ""
    output_format: str = "delta"
    # None: work off what is there, then stop.
    trigger_interval: str | None = "30 seconds"
    headway_watermark: str = "10 minutes"
    # A vehicle silent for longer, by its own clock, is forgotten. None: never.
    stall_state_ttl_s: int | None = 20 * 60
    # How late a reading may be, and the seconds of event time that are judged together.
    stall_watermark: str = "1 minute"
    stall_slice_s: int = 60
    local_zone: str = LOCAL_ZONE

    @property
    def managed(self) -> bool:
        return bool(self.connection_string)

    @property
    def header_bytes(self) -> int:
        """Bytes in front of the body: a registry header on local Avro, otherwise none."""
        return 5 if self.payload_codec == "avro" and not self.managed else 0

    def topic(self, name: str) -> str:
        return name if self.managed else self.topic_prefix + name

    def table_path(self, table: str) -> str:
        if not self.output_path:
            raise ValueError("output_path is not set")
        return f"{self.output_path.rstrip('/')}/{table}"

    def checkpoint(self, query: str) -> str:
        if not self.checkpoint_path:
            raise ValueError("checkpoint_path is not set")
        return f"{self.checkpoint_path.rstrip('/')}/{query}"

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> "Settings":
        """Read the settings a running deployment already exports."""
        names = {
            "bootstrap_servers": ("KAFKA_BOOTSTRAP_SERVERS", str),
            "connection_string": ("BROKER_CONNECTION_STRING", str),
            "starting_offsets": ("KAFKA_STARTING_OFFSETS", str),
            "bronze_rows_per_trigger": ("BRONZE_MAX_OFFSETS_PER_TRIGGER", int),
            "trip_rows_per_trigger": ("TRIP_UPDATES_MAX_OFFSETS_PER_TRIGGER", int),
            "position_rows_per_trigger": ("VEHICLE_POSITIONS_MAX_OFFSETS_PER_TRIGGER", int),
            "output_path": ("OUTPUT_PATH", str),
            "checkpoint_path": ("CHECKPOINT_PATH", str),
            "output_format": ("OUTPUT_FORMAT", str),
            "payload_codec": ("PAYLOAD_CODEC", str),
            "trigger_interval": ("TRIGGER_INTERVAL", str),
            "headway_watermark": ("HEADWAY_WATERMARK", str),
            "stall_state_ttl_s": ("STALL_STATE_TTL_S", int),
            "topic_prefix": ("TOPIC_PREFIX", str),
        }
        return cls(**{field: cast(env[var]) for field, (var, cast) in names.items() if env.get(var)})
