"""Spelling variants by PartEnum signatures over letter multisets.

A word is a binary vector with one place for each letter and occurrence (the second ``e`` has a place of its own).
One inserted, deleted or replaced code point changes at most two places, so near words have vectors with a Hamming
distance of at most two. The places are dealt to PARTS parts; two vectors that differ in two places at most agree on
all but two parts. A word's signatures are its contents in each choice of all but two parts, with its length: near
words share at least one of them exactly. An equi-join of signatures gives the candidates, which are verified.

Letters are far from evenly used, so many words share a signature. One edit leaves the first or the second half of a
word as it was: a signature is joined together with either half, which loses no pair and splits crowded signatures.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import bounded_batches, stored

#: Parts of the places, of which signatures leave out two.
PARTS = 4
#: Words of a task counted at once.
HELD = 1 << 19
# Fixed values of the words: letters, least length, least occurrences, and one in how many loses a letter.
LETTERS, LEAST_LENGTH, LEAST_COUNT, HARMED = "a-zÀ-ÿ", 7, 2, 31
#: How much more frequent a form is than its variant.
FORM_RATIO = 10
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)`` of the words with at least LEAST_LENGTH code points and LEAST_COUNT occurrences."""
    bounded_batches(df.sparkSession)
    runs = re.compile(f"[{LETTERS}]{{{LEAST_LENGTH},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = Counter(runs.findall((content or b"").translate(LOWER).decode("utf-8", "replace")))
                start = zlib.crc32(f"{'' if name is None else name}:".encode())
                for word, n in found.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % HARMED == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < LEAST_LENGTH:
                            continue
                    total[word] += n
                if len(total) >= HELD:
                    yield out()
                    total = Counter()
        yield out()

    words = df.select(F.col(key).cast("string"), F.col(text).cast("binary")).mapInArrow(count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(27))


def part_sums(words: list[str]) -> np.ndarray:
    """For each word and part a hash of the letters and occurrences in it, whatever their order."""
    sizes = np.array([len(w) for w in words], np.int64)
    owner = np.repeat(np.arange(len(words)), sizes)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    order = np.lexsort((letters, owner))
    owner, letters = owner[order], letters[order]
    fresh = np.ones(len(letters), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (letters[1:] != letters[:-1])
    at = np.arange(len(letters))
    occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0))
    place = mixed(mixed((letters + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + occurrence.astype(np.uint64))
    sums = np.zeros((len(words), PARTS), np.uint64)
    np.add.at(sums, (owner, ((place >> np.uint64(40)) % np.uint64(PARTS)).astype(np.int64)), place)
    return sums


def signatures(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Arrays of (key, whether the word is one of the longer ones under it), one of each kind of signature.

    A word signs with its own length and, for words longer by one, with the next; the key of a pair has the greater length.
    """
    sums = part_sums(words)
    for more in (0, 1):
        lengths = [len(w) + more for w in words]
        halves = [
            np.fromiter((xxhash.xxh3_64_intdigest(w[:n // 2].encode(), 2 * n) for w, n in zip(words, lengths, strict=True)), np.uint64, len(words)),
            np.fromiter((xxhash.xxh3_64_intdigest(w[n // 2 - n:].encode(), 2 * n + 1) for w, n in zip(words, lengths, strict=True)), np.uint64, len(words)),
        ]
        for k, chosen in enumerate(combinations(range(PARTS), PARTS - 2)):
            letters = mixed(sums[:, chosen].sum(axis=1) + np.uint64(k))
            for half in halves:
                yield mixed(letters ^ half), np.full(len(words), more == 0)


def near_pairs(words: DataFrame) -> DataFrame:
    """``(word, n, other, other_n)`` of ``(word, n)``: all pairs one inserted, deleted or replaced code point apart, both ways."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if texts:
                for key, longer in signatures(texts):
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(longer), batch.column(0), batch.column(1)], names=["key", "longer", "word", "n"])

    signed = words.mapInArrow(sign, "key long, longer boolean, word string, n long")
    long, all_ = signed.where("longer").alias("a"), signed.alias("b")
    # Keys of unlike kinds can be equal too: lengths, not the kinds, say which way round a pair is found.
    once = "IF(length(a.word) = length(b.word), b.word < a.word, length(b.word) < length(a.word))"
    ordered = f"a.key = b.key AND (NOT b.longer OR b.word < a.word) AND {once} AND levenshtein(a.word, b.word, 1) = 1"
    found = long.join(all_, F.expr(ordered)).select(F.col("a.word"), F.col("a.n"), F.col("b.word").alias("other"), F.col("b.n").alias("other_n")).distinct()
    return found.select(F.explode(F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``: forms followed to the last, in doubling steps.

    Every form is FORM_RATIO times as frequent as its word, so chains have 18 steps at most and five rounds reach all ends.
    """
    up = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = up.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = stored(up.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-roots")
        up = step.select("word", "root")
        if step.where("moved").isEmpty():
            return up


def variants(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of all words of the texts.

    ``form`` is the near word that is most frequent (ties: smallest), if it is FORM_RATIO times as frequent as the word;
    ``root`` is where following forms ends. Null and empty texts have no words, a null key counts as an empty one;
    repeated rows count as often as they are there; long texts are counted whole. Tables without rows give none. Other
    columns do not matter.
    """
    words = stored(word_counts(df, key, text), "spelling-words")
    near = near_pairs(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form"))).alias("best"))
    frequent = -F.col("best.minus") >= FORM_RATIO * F.col("n")
    near = stored(near.select("word", "n_near", F.when(frequent, F.col("best.form")).alias("form"), F.when(frequent, -F.col("best.minus")).alias("form_n")), "spelling-near")
    ends = roots(near.where("form IS NOT NULL"))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
