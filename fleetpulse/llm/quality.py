"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Byte n-grams of whole texts are hashed into a fixed number of bins. The raw multinomial counts every
document; the target multinomial counts all trusted ones. A document's score is its mean log ratio per n-gram,
and one threshold, an exact percentile of the scores of all trusted documents, decides each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import SLICE_BYTES, binaries, bounded_batches, carry, flat, gram_bins, percentiles, portions, release, stored, sums

N, BITS = 4, 16
#: Share of trusted labelled documents that may fall below the threshold.
TRUSTED_LOSS = 0.001
SMOOTH = 0.5
# Fixed values of the base rules.
MIN_WORDS, REPEAT_PERCENT = 50, 50
SYMBOLS = re.compile(rb"[#*$%&|<>]")


def bins(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return gram_bins(data, starts, N, BITS)


def bin_counts(df: DataFrame, text: str) -> np.ndarray:
    """Counts of the bins over all rows: one array a task, added up by bin; 2**BITS numbers reach the driver."""
    bounded_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for texts in portions([t or b"" for t in batch.column(0).to_pylist()], SLICE_BYTES):
                h, whole = bins(*flat(texts))
                total += np.bincount(h[whole], minlength=1 << BITS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bin", "n"])
        release()

    rows = df.select(F.col(text).cast("binary")).mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(1 << BITS, np.int64)
    for b, n in rows:
        out[b] = n
    return out


@dataclass(frozen=True)
class Model:
    ratio: np.ndarray  # log(target / raw) of each bin
    threshold: float  # -inf keeps all that the base rules keep


def repeats(texts: list[bytes], words: list[list[bytes]]) -> np.ndarray:
    """Words of each text that lie in a 3-word window which the text has twice or more."""
    ids: dict[bytes, int] = {}
    flat_ids = np.fromiter((ids.setdefault(w, len(ids)) for ws in words for w in ws), np.int64)
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=starts[1:])
    hit = np.zeros(len(flat_ids) + 3, bool)
    if len(flat_ids) >= 3:
        owner = np.repeat(np.arange(len(texts)), np.diff(starts))
        at = np.flatnonzero(owner[:-2] == owner[2:])
        # Exact numbers for a window: that of its first two words, then that with the third, then with the text.
        _, two = np.unique(flat_ids[at] * (len(ids) + 1) + flat_ids[at + 1], return_inverse=True)
        _, three = np.unique(two * (len(ids) + 1) + flat_ids[at + 2], return_inverse=True)
        _, where, counts = np.unique(three * len(texts) + owner[at], return_inverse=True, return_counts=True)
        again = at[counts[where] > 1]
        for k in range(3):
            hit[again + k] = True
    return sums(hit[:len(flat_ids)].astype(np.int64), starts)


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.split()]
    return len(lines) - len(set(lines))


def fit(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model:
    """Target and raw multinomials and the threshold. Without trusted rows nothing falls but by the base rules.

    A labelled id is trusted if all its rows say quality 1 and none says toxic 1; quality null counts as 0.
    """
    trusted = F.min(F.coalesce("quality", F.lit(0))) + F.max(F.coalesce("toxic", F.lit(0))) * -1 == 1
    ids = labels.where(F.col(key).isNotNull()).groupBy(key).agg(trusted.alias("trusted")).where("trusted").select(key)
    # One text an id, the smallest where ids are repeated: copies are folded before the shuffle.
    chosen = stored(df.select(key, text).join(ids, key).groupBy(key).agg(F.min(text).alias(text)), "trusted", compression="zstd")
    target, raw = bin_counts(chosen, text), bin_counts(df, text)
    share = [(c + SMOOTH) / (c.sum() + SMOOTH * len(c)) for c in (target, raw)]
    model = Model(np.log(share[0] / share[1]), -np.inf)
    if not target.sum():
        return model
    # Rounded as verdicts are: the last digits depend on how rows lie in batches.
    scores = stored(judge(chosen, model, text, [key]).where("NOT base_failed").select(F.round("score", 9)), "trusted-scores")
    low = percentiles(scores, [TRUSTED_LOSS])
    return Model(model.ratio, -np.inf if low is None else low[0])


def judge(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``__row`` with the base counts, ``base_failed``, ``score`` (mean log ratio; 0 without n-grams) and ``kept``.

    ``keep`` names the columns that ``__row`` brings back (all if None). Null and empty texts have no words and fail. Equal texts get equal verdicts. A text of any length is
    judged whole, in one batch with few others. Tables without rows give none.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    new = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double, kept boolean"

    def work(rows):
        m = shared.value
        for batch in rows:
            texts = binaries(batch, text)
            words = [t.split() for t in texts]
            data, starts = flat(texts)
            # A code point has one byte that is no continuation byte; blanks are not in words.
            blank = (data == 32) | ((data >= 9) & (data <= 13))
            chars = sums((((data & 0xC0) != 0x80) & ~blank).astype(np.int64), starts)
            symbols = [len(SYMBOLS.findall(t)) for t in texts]
            n_words = np.array([len(w) for w in words], np.int64)
            repeat = repeats(texts, words)
            h, whole = bins(data, starts)
            grams = sums(whole.astype(np.int64), starts)
            score = sums(np.where(whole, m.ratio[h], 0.0), starts) / np.maximum(grams, 1)
            failed = (n_words < MIN_WORDS) | (100 * repeat > REPEAT_PERCENT * n_words)
            yield [pa.array(n_words), pa.array(chars), pa.array(symbols, pa.int64()), pa.array([repeated_lines(t) for t in texts], pa.int64()),
                   pa.array(repeat), pa.array(failed), pa.array(score), pa.array(~failed & (np.round(score, 9) >= round(m.threshold, 9)))]

    return carry(df, new, work, keep, by=text)
