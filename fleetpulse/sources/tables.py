"""Stored tables and static schedule files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.contracts import ROUTES_SEED, STOPS_SEED

# Tasks over which the rows of one target folder are spread.
SALTS = 8


def read_bronze(spark: SparkSession, table: str, base_path: str | None = None, fmt: str = "parquet",
                namespace: str | None = None) -> DataFrame:
    """A bronze table, from its folder when a base path is given, else from the catalog."""
    if base_path:
        return spark.read.format(fmt).load(f"{base_path.rstrip('/')}/{table}")
    return spark.table(f"{namespace}.{table}" if namespace else table)


def read_if_present(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at a path, or None before its first write."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "DELTA_TABLE_NOT_FOUND"):
            return None
        raise


def per_folder(df: DataFrame, *partitions: str) -> DataFrame:
    """Rows grouped by target folder for a partitioned write, so a folder gets few files.

    The rows of one folder are dealt by hash over SALTS tasks, so a folder that holds most rows
    is written by several. The same with and without adaptive execution.
    """
    names = set(partitions)
    salt = F.pmod(F.xxhash64(*[F.to_json(F.struct(c)) if "map" in t or "variant" in t else F.col(c) for c, t in df.dtypes if c not in names] or [F.lit(0)]), F.lit(SALTS))
    return df.repartition(*partitions, salt)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_routes(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, ROUTES_SEED)


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, STOPS_SEED)
