"""Message sources: broker topics, or files of the same shape, as streams or batches."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse import contracts
from fleetpulse.config import Settings

MESSAGE = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


@dataclass(frozen=True)
class SourceSpec:
    """Where messages come from. ``fmt`` is ``kafka`` in deployment, a file format in tests."""

    fmt: str
    topic: str = ""
    path: str = ""
    schema: T.StructType | None = None
    rows_per_trigger: int | None = None
    files_per_trigger: int | None = None
    starting_offsets: str = "latest"
    options: dict[str, str] = field(default_factory=dict)

    @classmethod
    def kafka(cls, cfg: Settings, topic: str, rows_per_trigger: int | None = None) -> "SourceSpec":
        options = broker_options(cfg)
        if cfg.min_read_partitions:
            options["minPartitions"] = str(cfg.min_read_partitions)
        return cls(
            fmt="kafka",
            topic=cfg.topic(topic),
            rows_per_trigger=rows_per_trigger,
            starting_offsets=cfg.starting_offsets,
            options=options,
        )

    @classmethod
    def files(cls, fmt: str, path: str, schema: T.StructType = MESSAGE, files_per_trigger: int | None = None,
              **options: str) -> "SourceSpec":
        return cls(fmt=fmt, path=path, schema=schema, files_per_trigger=files_per_trigger, options=options)

    def reader_options(self, streaming: bool) -> dict[str, str]:
        opts = dict(self.options)
        if self.fmt == "kafka":
            opts["subscribe"] = self.topic
            # A batch read has an end, so "latest" would be empty by definition.
            if streaming:
                opts["startingOffsets"] = self.starting_offsets
                if self.rows_per_trigger:
                    opts["maxOffsetsPerTrigger"] = str(self.rows_per_trigger)
            else:
                opts["startingOffsets"] = "earliest"
        elif streaming and self.files_per_trigger:
            opts["maxFilesPerTrigger"] = str(self.files_per_trigger)
        return opts


def broker_options(cfg: Settings) -> dict[str, str]:
    """Kafka connection options; a managed broker adds SASL over TLS."""
    opts = {"kafka.bootstrap.servers": cfg.bootstrap_servers}
    if cfg.managed:
        login = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="$ConnectionString" password="{cfg.connection_string}";'
        )
        opts["kafka.security.protocol"] = "SASL_SSL"
        opts["kafka.sasl.mechanism"] = "PLAIN"
        opts["kafka.sasl.jaas.config"] = login
    return opts


def _load(reader, spec: SourceSpec, streaming: bool) -> DataFrame:
    reader = reader.format(spec.fmt).options(**spec.reader_options(streaming))
    if spec.schema is not None and spec.fmt != "kafka":
        reader = reader.schema(spec.schema)
    return reader.load(spec.path) if spec.path else reader.load()


def read_stream(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    return _load(spark.readStream, spec, streaming=True)


def read_batch(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    return _load(spark.read, spec, streaming=False)


def payload_text(value: Column | str = "value") -> Column:
    """Message body as text."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def decode(
    messages: DataFrame,
    contract: T.StructType,
    codec: str = "json",
    header_bytes: int = 0,
    name: str = "record",
    keep: Iterable[str] = (),
) -> DataFrame:
    """Message body to a ``data`` struct plus the raw body as base64 in ``_raw_payload``.

    The body is parsed once. Unreadable JSON yields an all-null struct.
    """
    body = F.col("value").cast("binary")
    content = F.expr(f"substring(cast(value as binary), {header_bytes + 1})") if header_bytes else body
    if codec == "json":
        nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in contract.fields])
        data = F.from_json(content.cast("string"), nullable)
    elif codec == "avro":
        # Needs the external spark-avro module on the class path.
        from pyspark.sql.avro.functions import from_avro

        data = from_avro(content, contracts.avro_schema(contract, name))
    else:
        raise ValueError(f"unknown codec {codec!r}")
    return messages.select(*keep, data.alias("data"), F.base64(body).alias("_raw_payload"))


def flatten(decoded: DataFrame, contract: T.StructType, keep: Iterable[str] = ("_raw_payload",)) -> DataFrame:
    """The contract's columns out of the ``data`` struct, in contract order."""
    return decoded.select(*[F.col(f"data.{c}") for c in contract.fieldNames()], *keep)


def header_bytes(messages: DataFrame) -> DataFrame:
    """Magic byte and schema id in front of each body, for looking at an unknown topic."""
    body = F.col("value").cast("binary")
    return messages.select(
        F.hex(F.substring(body, 1, 1)).alias("magic_byte"),
        F.conv(F.hex(F.substring(body, 2, 4)), 16, 10).try_cast("bigint").alias("schema_id"),
        F.octet_length(body).alias("body_bytes"),
    )


def to_messages(df: DataFrame, key: Column) -> DataFrame:
    """Key/value messages with the whole row as JSON; null fields are left out of the JSON."""
    return df.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
