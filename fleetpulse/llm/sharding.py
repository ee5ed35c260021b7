"""Sharding: minimax contiguous partition of ordered atomic groups (equal texts) into shards of near equal bytes.

Groups are ordered by the digest of their text. The smallest capacity with which a greedy fill needs no more
than the wanted number of shards is found by binary search. A greedy fill only needs prefix sums: those of
buckets of groups lie on the driver (one number for about 4,096 groups), and of the groups themselves only
the buckets are read in which a cut falls.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import stored

GROUPS_PER_BUCKET = 4096


class Prefix:
    """Prefix sums of the ordered groups: of buckets at once, inside a bucket on demand."""

    def __init__(self, groups: DataFrame, buckets: int):
        self.groups = groups
        summed = {r["bucket"]: r for r in groups.groupBy("bucket").agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("top")).collect()}
        self.ends = np.cumsum([summed[b]["bytes"] if b in summed else 0 for b in range(buckets)])
        self.total = int(self.ends[-1])
        self.largest = max((r["top"] for r in summed.values()), default=0)
        self.inside: dict[int, tuple[list[str], np.ndarray]] = {}

    def fetch(self, buckets: set[int]) -> None:
        wanted = sorted(buckets - self.inside.keys())
        if wanted:
            rows: dict[int, list] = {b: [] for b in wanted}
            for b, g, n in self.groups.where(F.col("bucket").isin(wanted)).select("bucket", "group", "bytes").toLocalIterator():
                rows[b].append((g, n))
            for b, found in rows.items():
                found.sort()
                start = int(self.ends[b - 1]) if b else 0
                self.inside[b] = ([g for g, _ in found], start + np.cumsum([n for _, n in found], dtype=np.int64))

    def reach(self, limit: int) -> tuple[int, str | None]:
        """The largest prefix sum up to a limit, and the first group beyond it (None after the last)."""
        if limit >= self.total:
            return self.total, None
        b = int(np.searchsorted(self.ends, limit, side="right"))
        self.fetch({b})
        names, sums = self.inside[b]
        i = int(np.searchsorted(sums, limit, side="right"))
        return (int(sums[i - 1]) if i else int(self.ends[b - 1]) if b else 0), names[i]


def fill(prefix: Prefix, capacity: int, shards: int) -> list[str] | None:
    """The first group of every shard but the first, filled greedily; None if the groups need more shards."""
    cuts, at = [], 0
    for _ in range(shards):
        at, following = prefix.reach(at + capacity)
        if following is None:
            return cuts
        cuts.append(following)
    return None


def smallest_capacity(prefix: Prefix, shards: int) -> tuple[int, list[str]]:
    low = max(math.ceil(prefix.total / shards), prefix.largest)
    high = low + prefix.largest  # always enough: each full shard then holds at least its share
    near = {int(np.searchsorted(prefix.ends, min(j * c, prefix.total - 1), side="right")) for j in range(1, shards) for c in (low, (low + high) // 2)}
    prefix.fetch({b for b in near if prefix.total})
    while low < high:
        middle = (low + high) // 2
        if fill(prefix, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low, fill(prefix, low, shards)


def shard(df: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    ``size`` is the UTF-8 bytes of the text plus 1; a null text has size 1 and the crc32 of nothing, and is a
    group apart from the empty text. Rows of equal text, repeated rows too, share a shard, however many: a
    group above its share makes a larger shard. Slots count from 0 in each shard, by the part of the stored table that
    holds a row, then by text digest and key. Fewer groups than shards leave the last shards empty; no rows
    give no shards. Input columns other than the two named are not read.
    """
    spark = df.sparkSession
    t = F.col(text).cast("string")
    rows = df.select(F.col(key).alias("doc_id"), (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
                     F.crc32(F.coalesce(t, F.lit("")).cast("binary")).alias("text_crc32"), F.coalesce(F.md5(t.cast("binary")), F.lit("")).alias("group"), F.spark_partition_id().alias("part"))
    rows = stored(rows, "shard-rows")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    count = max(1, groups.count())
    bits = min(20, max(0, math.ceil(math.log2(count / GROUPS_PER_BUCKET))))
    bucket = F.shiftright(F.coalesce(F.conv(F.substring("group", 1, 8), 16, 10).cast("long"), F.lit(0)), 32 - bits) if bits else F.lit(0)
    groups = groups.withColumn("bucket", F.when(F.col("group") == "", F.lit(0)).otherwise(bucket).cast("int"))
    groups = stored(groups.repartition("bucket").sortWithinPartitions("bucket", "group"), "shard-groups")
    _, cuts = smallest_capacity(Prefix(groups, 1 << bits), shards)
    at = F.lit(0)
    for cut in cuts:
        at = at + (F.col("group") >= cut).cast("int")
    rows = rows.withColumn("shard", at)
    line = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "part").agg(F.count("*").alias("n")).select("shard", "part", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "part").orderBy("group", "doc_id", "size")
    rows = rows.withColumn("row", F.row_number().over(inside) - 1).join(offsets, ["shard", "part"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("offset") + F.col("row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
