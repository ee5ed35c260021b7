"""Identifiers derived from what a row says, so that a replay produces the same ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def natural_key(kind: str, *parts: Column | str) -> Column:
    """SHA-256 of kind and parts as a JSON array: no two lists of parts read alike, and null is not empty text."""
    texts = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    return F.sha2(F.to_json(F.array(F.lit(kind), *texts)), 256)


def random_key() -> Column:
    return F.expr("uuid()")
