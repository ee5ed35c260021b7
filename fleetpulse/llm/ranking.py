"""A quality classifier learned by Bradley-Terry pairwise ranking.

A document is a vector of features of its text. All labelled documents make preference pairs, one of each class; a
logistic loss on the difference of their features gives the weights, so that P(a before b) is the logistic function of
the difference of their scores. The threshold is a quantile of the labelled scores: the share of the worse class.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import binaries, carry, flat, gram_bins, percentiles, release, stored, sums

#: Pairs of each document of the larger class.
PAIRS = 2
#: Pairs are made within cells of about this many documents, which have RARE of the smaller class or all of it.
CELL, RARE = 10_000, 50
#: Byte n-grams are hashed into 2**BITS shares.
N, BITS = 3, 9
#: One row of this many, by the checksum of its id, is never learned from; scores from CUT on are predicted good.
FOLDS, CUT = 5, 0.3
RIDGE, ROUNDS, DONE = 1e-3, 100, 1e-12
#: Pairs of a step's matrix products, and rows of the curvature that are added up together.
STEP, SLAB = 4096, 16

# Classes of bytes whose shares are features.
CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?'\"()-", b"#*$%&|<>", b"@/\\_=+[]{}~^`", b" ", b"\n", bytes(range(128, 256))]
SHAPES = 7
WIDTH = (1 << BITS) + len(CLASSES) + SHAPES


def features(texts: list[bytes]) -> np.ndarray:
    """One row of WIDTH numbers for each text: what it looks like and which n-grams it has, whatever its length."""
    data, starts = flat(texts)
    size = np.maximum(np.diff(starts), 1)
    out = np.zeros((len(texts), WIDTH))
    h, whole = gram_bins(data, starts, N, BITS)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    counts = np.bincount(owner[whole] * (1 << BITS) + h[whole].astype(np.int64), minlength=len(texts) << BITS).reshape(len(texts), -1)
    out[:, :1 << BITS] = np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
    at = 1 << BITS
    for chars in CLASSES:
        member = np.zeros(256, np.int64)
        member[list(chars)] = 1
        out[:, at] = np.sqrt(sums(member[data], starts) / size)
        at += 1
    out[:, at] = np.log1p(np.diff(starts))
    for i, text in enumerate(texts):
        words, lines = text.split(), [line for line in text.split(b"\n") if line.strip()]
        n = max(len(words), 1)
        out[i, at + 1:] = (math.log1p(len(words)), sum(map(len, words)) / n / 10, len(set(words)) / n, len(set(zip(words, words[1:]))) / n,
                           len(set(lines)) / max(len(lines), 1), math.log1p(len(lines)) - math.log1p(len(words)))
    return out


@dataclass(frozen=True)
class Ranker:
    weights: np.ndarray
    threshold: float


def held_out(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == 0


def packed(x: np.ndarray) -> list[bytes]:
    """Rows of features, most of them few values many times over, in little room."""
    return [zlib.compress(row.tobytes(), 1) for row in x.astype(np.float32)]


def unpacked(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(zlib.decompress, rows)), np.float32).reshape(-1, WIDTH)


def featured(df: DataFrame, text: str) -> DataFrame:
    """``__row`` and ``x``, its features, packed."""

    def work(rows):
        for batch in rows:
            yield [pa.array(packed(features(binaries(batch, text))), pa.binary())]

    return carry(df, "x binary", work, [f for f in df.columns if f != text], by=text)


def cells(sample: DataFrame) -> DataFrame:
    """``goods`` and ``bads``: packed features of one cell's documents by class, in order of the ids' hashes.

    Ids are dealt to cells by their hash; where a class is rare, its documents are dealt to several cells each, so
    that no cell lacks it.
    """
    n, goods = sample.agg(F.count(F.lit(1)), F.count_if("good")).first()
    number = max(1, math.ceil(n / CELL))
    few = max(1, min(goods, n - goods))
    copies = min(number, math.ceil(number * RARE / few))
    times = F.when(F.col("good") == F.lit(goods <= n - goods), copies).otherwise(1)
    first = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(number))
    cell = F.explode(F.transform(F.sequence(F.lit(0), times - 1), lambda k: (first + k) % number))

    def gather(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("hash", "ascending"), ("id", "ascending")])
        split = [rows.filter(rows["good"] if good else pc.invert(rows["good"]))["x"].to_pylist() for good in (True, False)]
        return pa.table({"goods": pa.array([split[0]], pa.list_(pa.binary())), "bads": pa.array([split[1]], pa.list_(pa.binary()))})

    dealt = sample.select("id", "good", "x", F.xxhash64("id").alias("hash"), cell.alias("cell"))
    return stored(dealt.groupBy("cell").applyInArrow(gather, "goods array<binary>, bads array<binary>"), "ranking-cells")


def preferences(goods: np.ndarray, bads: np.ndarray) -> Iterator[np.ndarray]:
    """Features of better documents less those of worse ones, in steps; each of the larger class is in PAIRS pairs."""
    larger, smaller = max(len(goods), len(bads)), min(len(goods), len(bads))
    for k in range(PAIRS if smaller else 0):
        for at in range(0, larger, STEP):
            i = np.arange(at, min(at + STEP, larger))
            j = (i + smaller * k // PAIRS) % smaller
            yield (goods[i] - bads[j] if len(goods) >= len(bads) else goods[j] - bads[i]).astype(np.float64)


def pair_sums(held: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Over all pairs, with p the probability of the wrong order: WIDTH rows of the curvature (sums of p (1 - p) x x'),
    one of the slope (sums of -p x), and one that begins with the loss and the number of pairs.

    A task adds up its pairs, its sums are added up slab by slab, and only their total reaches the driver.
    """
    shared = held.sparkSession.sparkContext.broadcast(weights)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((-(-(WIDTH + 2) // SLAB) * SLAB, WIDTH))
        for batch in batches:
            for c in range(batch.num_rows):
                for d in preferences(*[unpacked(batch.column(k)[c].as_py()) for k in (0, 1)]):
                    margin = d @ shared.value
                    p = np.exp(-np.logaddexp(0, margin))
                    total[:WIDTH] += (d * (p * (1 - p))[:, None]).T @ d
                    total[WIDTH] -= p @ d
                    total[WIDTH + 1, :2] += np.logaddexp(0, -margin).sum(), len(d)
        slabs = total.reshape(-1, SLAB * WIDTH)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(slabs), dtype=np.int32)), pa.array([s.tobytes() for s in slabs], pa.binary())], names=["slab", "sums"])
        release()

    def together(rows: pa.Table) -> pa.Table:
        return pa.table({"slab": rows["slab"][:1], "sums": pa.array([sum(np.frombuffer(s, np.float64) for s in rows["sums"].to_pylist()).tobytes()], pa.binary())})

    slabs = held.mapInArrow(add, "slab int, sums binary").groupBy("slab").applyInArrow(together, "slab int, sums binary").collect()
    return np.concatenate([np.frombuffer(s, np.float64) for _, s in sorted(slabs)] or [np.zeros(0)]).reshape(-1, WIDTH)[:WIDTH + 2]


def learn(held: DataFrame) -> np.ndarray | None:
    """Weights of the least mean loss with a ridge on standardised features, by Newton steps; None without pairs."""
    weights, step, best = np.zeros(WIDTH), None, math.inf
    for _ in range(ROUNDS):
        found = pair_sums(held, weights)
        if not len(found) or not (m := found[WIDTH + 1, 1]):
            return None
        if step is None:
            ridge = RIDGE * np.maximum(4 * found[:WIDTH].diagonal() / m, 1e-12)  # at no weights p (1 - p) is a quarter
        value = found[WIDTH + 1, 0] / m + weights @ (ridge * weights) / 2
        if value > best + DONE:  # too far: half the way
            step = step / 2
            weights = weights - step
            continue
        best = value
        slope = found[WIDTH] / m + ridge * weights
        step = -np.linalg.solve(found[:WIDTH] / m + np.diag(ridge), slope)
        if -slope @ step < DONE:
            break
        weights = weights + step
    return weights


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Ranker:
    """Weights and threshold from all labelled ids whose checksum leaves a remainder.

    A labelled id is good if none of its rows says quality 0; rows without an id or a quality are passed over. Of several
    documents with one id one is learned from. Without both classes all scores are equal.
    """
    known = labels.where(F.col(key).isNotNull() & F.col("quality").isNotNull() & ~held_out(key)).groupBy(F.col(key).alias("id")).agg((F.min("quality") > 0).alias("good"))
    texts = df.where(~held_out(key)).select(F.col(key).alias("id"), F.xxhash64(text).alias("which"), F.col(text).alias("text"))
    rows = featured(texts, "text").select("__row.*", "x").join(known, "id")
    sample = stored(rows.groupBy("id", "good").agg(F.min_by("x", "which").alias("x")), "ranking-sample")
    weights = learn(cells(sample))
    if weights is None:
        return Ranker(np.zeros(WIDTH), 0.0)
    shared = df.sparkSession.sparkContext.broadcast(weights)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(unpacked(batch.column(0).to_pylist()) @ shared.value)], names=["raw"])

    bads, n = sample.agg(F.count_if(~F.col("good")), F.count(F.lit(1))).first()
    raw = stored(sample.select("x").mapInArrow(judge, "raw double"), "ranking-scores")
    low, high = percentiles(raw, [max(bads / n - 0.01, 0.0), min(bads / n + 0.01, 1.0)])
    return Ranker(weights, (low + high) / 2)


def score(df: DataFrame, model: Ranker, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``__row`` (without the text), ``held_out``, ``score`` (0 to 1) and ``predicted``.

    The score is the probability to be preferred to a document at the threshold, shifted so that the threshold has CUT.
    Null and empty texts have the features of an empty text; equal texts have equal scores; a text of any length is judged
    whole. A null id is not held out. Tables without rows give none.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.threshold))

    def work(rows: Iterator[pa.StructArray]):
        weights, threshold = shared.value
        for batch in rows:
            raw = features(binaries(batch, text)) @ weights - threshold + math.log(CUT / (1 - CUT))
            yield [pa.array(1 / (1 + np.exp(-np.clip(raw, -500, 500))))]

    found = carry(df, "score double", work, [f for f in df.columns if f != text])
    return found.select("__row", F.coalesce(F.crc32(F.col(f"__row.`{key}`").cast("string").cast("binary")) % FOLDS == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
