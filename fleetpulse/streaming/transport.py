"""Where the jobs' messages come from and go to: broker topics, or folders standing in for them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from fleetpulse.config import Settings
from fleetpulse.sources.messages import SourceSpec, broker_options
from fleetpulse.streaming.sinks import BatchSink, publish

ToMessages = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class KafkaTransport:
    cfg: Settings

    def source(self, topic: str, rows_per_trigger: int | None) -> SourceSpec:
        return SourceSpec.kafka(self.cfg, topic, rows_per_trigger)

    def sink(self, topic: str, to_messages: ToMessages) -> BatchSink:
        return publish(to_messages, "kafka", topic=self.cfg.topic(topic), **broker_options(self.cfg))


@dataclass(frozen=True)
class FolderTransport:
    """One folder of JSON key/value files per topic, with a folder in it for each trigger that wrote some."""

    base: str
    files_per_trigger: int | None = None

    def path(self, topic: str) -> str:
        return f"{self.base.rstrip('/')}/{topic}"

    def source(self, topic: str, rows_per_trigger: int | None) -> SourceSpec:
        return SourceSpec.files("json", self.path(topic), files_per_trigger=self.files_per_trigger, recursiveFileLookup="true")

    def sink(self, topic: str, to_messages: ToMessages) -> BatchSink:
        return publish(to_messages, "json", self.path(topic))


Transport = KafkaTransport | FolderTransport
