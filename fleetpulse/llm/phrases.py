"""Phrase collocations by SON partitioning.

Rows are dealt to a few shards by a hash of their text. Each shard is mined completely at a support lowered
in proportion to its words: whatever occurs often enough overall does so in one shard at least. Mining counts
64-bit hashes, whose last bits are the shard's, words and pairs first, then only those triples whose two pairs are
frequent in the shard. An occurrence weighs what its shard's share of the words makes of it, so that one bound holds
everywhere and a key and a weight are all that is shuffled; a collision can only add a candidate. The union of what is frequent somewhere becomes a bitmap of bounded size,
and one more pass counts all phrases that it lets through, by their words, over all shards. The bitmap's false
positives are counted too and fall by the support, so the counts are exact whatever its size.

The number of shards is small and fixed, and a shard is spread over all tasks: with an absolute support, shards
of one task each would have a local support of one and prune nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetpulse.llm.common import bounded_batches, release, small, stored

SHARDS = 4
#: Text split at once, tokens of a task counted at once, words numbered at once (21 bits a word, three in a key).
SLICE, TOKENS, WORDS = 2 << 20, 1 << 23, 1 << 20
#: Tokens whose phrases are hashed at once, and what an occurrence weighs where a shard has all words.
STRETCH, WEIGHT = 1 << 17, 1 << 10
#: Bits of a candidate, and of a bitmap at least and at most; a bitmap travels in blocks.
SPARE, BITS_LEAST, BITS_MOST, BLOCK = 16, 1 << 16, 1 << 28, 1 << 20

# What ends a piece is turned to a full stop, ASCII letters are lower-cased.
PIECES = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))
NO_LANGUAGE = "und"
BETWEEN = re.compile(rb"[ .\t]")
_GOLD, _MASK = np.uint64(0x9E3779B97F4A7C15), (1 << 64) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


class Words(dict):
    """Numbers for words as they come up; 0 is the end of a piece."""

    def __init__(self) -> None:
        super().__init__({b".": 0})
        self.hashes = [0]

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.hashes)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return number


def cuts(text: bytes) -> Iterator[bytes]:
    """The text, its pieces marked, in slices that end between words."""
    at = 0
    while at < len(text):
        found = BETWEEN.search(text, at + SLICE)
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def seed(lang: str, size: int) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode(), size))


def stretches(ids: np.ndarray, size: int) -> Iterator[list[np.ndarray]]:
    """All phrases of ``size`` words within pieces, a column of numbers for each word; the first two tokens only lead in."""
    for at in range(0, len(ids) - 2, STRETCH):
        part = ids[at:at + STRETCH + 2]
        columns = [part[2 - k:len(part) - k] for k in range(size - 1, -1, -1)]
        inside = np.logical_and.reduce([c != 0 for c in columns])
        yield [c[inside] for c in columns]


def hashed(columns: list[np.ndarray], hashes: np.ndarray, lang: str) -> np.ndarray:
    h = np.full(len(columns[0]), seed(lang, len(columns)))
    for c in columns:
        h = mixed(h * _GOLD + hashes[c])
    return h


def low_bits(shards: int) -> int:
    """The bits of a key that hold the shard; the others are those of the hash."""
    return (1 << (shards - 1).bit_length()) - 1


def cleared(hashes: np.ndarray, shards: int) -> np.ndarray:
    return hashes & np.uint64(_MASK ^ low_bits(shards))


def token_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, np.ndarray, Words]]:
    """(group, token numbers with two leading ends, words) in bounded portions of a task's rows; the text is the last column."""
    words, held, total = Words(), {}, 0

    def flush():
        nonlocal words, held, total
        for key, arrays in held.items():
            ids = np.concatenate(arrays)
            if len(ids) > 2:
                yield key, ids, words
        words, held, total = Words(), {}, 0

    for batch in batches:
        for *key, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            group = held.setdefault(tuple(key), [np.zeros(2, np.int32)])
            for part in cuts((text or b"").translate(PIECES)):
                tokens = part.replace(b".", b" . ").split()
                group.append(np.fromiter(map(words.__getitem__, tokens), np.int32, len(tokens)))
                total += len(tokens)
                if total >= TOKENS or len(words) >= WORDS:
                    # The last two tokens lead in what follows of this text.
                    tail = np.concatenate(group)[-2:]
                    names = {n: w for w, n in words.items() if n in set(tail.tolist())}
                    yield from flush()
                    group = held.setdefault(tuple(key), [np.array([words[names[n]] for n in tail.tolist()], np.int32)])
            group.append(np.zeros(2, np.int32))
    yield from flush()
    release()


def rows_of(df: DataFrame, lang: str, text: str, shards: int) -> DataFrame:
    bounded_batches(df.sparkSession)
    language = F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE))
    shard = F.pmod(F.xxhash64(F.col(text)), F.lit(shards)).cast("int")
    return df.select(language.alias("lang"), shard.alias("shard"), F.col(text).cast("binary").alias("text"))


def bits_of(hashes: np.ndarray, shard: int, bits: int) -> np.ndarray:
    return (mixed(hashes + np.uint64((shard + 1) * int(_GOLD) & _MASK)) & np.uint64(bits - 1)).astype(np.int64)


def bitmap(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of bits and packed bits of ``(shard, h)``; rows are spread by block, the driver gets the blocks.

    The number follows that of the rows up to BITS_MOST, so the broadcast is bounded; a fuller map prunes less.
    """
    n = rows.count()
    bits = min(max(BITS_LEAST, 1 << (SPARE * n).bit_length()), BITS_MOST)

    def place(batches):
        for b in batches:
            h, s = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64), b.column(0).to_numpy(zero_copy_only=False)
            at = (mixed(h + (s + 1).astype(np.uint64) * _GOLD) & np.uint64(bits - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at // BLOCK), pa.array((at % BLOCK).astype(np.int32))], names=["block", "bit"])

    def fill(group: pa.Table) -> pa.Table:
        block = np.zeros(min(bits, BLOCK), bool)
        block[group["bit"].to_numpy()] = True
        return pa.table({"block": pa.array([group["block"][0].as_py()], pa.int64()), "packed": pa.array([np.packbits(block).tobytes()], pa.binary())})

    placed = rows.select("shard", "h").mapInArrow(place, "block long, bit int").distinct()
    packed = np.zeros(bits // 8, np.uint8)
    size = min(bits, BLOCK) // 8
    for block, content in placed.groupBy("block").applyInArrow(fill, "block long, packed binary").collect():
        packed[block * size:(block + 1) * size] = np.frombuffer(content, np.uint8)
    return bits, packed


def has(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, n = np.unique(keys, return_counts=True)
    return found, n.astype(np.int64)


def summed(counts: DataFrame, by: list[str], n: str) -> DataFrame:
    """Counts added up over tasks. They go to their place as they are: a task has counted already, so adding up before finds
    next to nothing to add."""
    return counts.repartition(*by).groupBy(*by).agg(F.sum(n).alias(n))


def hashed_weights(rows: DataFrame, sizes: DataFrame, lengths: tuple[int, ...], shards: int, keep: Callable | None = None) -> DataFrame:
    """``(key, weight)`` summed over all tasks: hash and shard of a phrase, and its count over the shard's share of the words.

    Rounded up, so a phrase that is frequent enough weighs at least WEIGHT times the support. ``keep`` prunes by the words.
    """
    # As words are counted to the whole text, whole * WEIGHT fits 64 bits, and so does the sum of a key's weights.
    factor = F.expr(f"{WEIGHT}L * n div greatest(own, 1L) + 1L").alias("factor")
    weighed = rows.join(sizes, ["lang", "shard"]).select("lang", "shard", factor, "text")

    def work(batches):
        for (lang, shard, factor), ids, words in token_runs(batches):
            hashes = np.array(words.hashes, np.uint64)
            for size in lengths:
                found = []
                for columns in stretches(ids, size):
                    if keep:
                        some = keep(columns, hashes, lang, shard)
                        columns = [c[some] for c in columns]
                    found.append(cleared(hashed(columns, hashes, lang), shards) | np.uint64(shard))
                key, n = counted(np.concatenate(found))
                yield from small(pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n * factor)], names=["key", "weight"]))

    return summed(weighed.mapInArrow(work, "key long, weight long"), ["key"], "weight")


def shard_words(rows: DataFrame) -> DataFrame:
    """Words of each language: ``own`` of a shard, ``n`` of all."""

    def work(batches):
        out: dict = {}
        for batch in batches:
            for lang, shard, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                n = sum(len(part.replace(b".", b" ").split()) for part in cuts((text or b"").translate(PIECES)))
                out[lang, shard] = out.get((lang, shard), 0) + n
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.int32()), pa.array(list(out.values()), pa.int64())], names=["lang", "shard", "n"])

    own = rows.mapInArrow(work, "lang string, shard int, n long").groupBy("lang", "shard").agg(F.sum("n").alias("own"))
    return own.withColumn("n", F.sum("own").over(Window.partitionBy("lang")))


def locally_frequent(weights: DataFrame, support: int, shards: int) -> DataFrame:
    """``(shard, h)`` with at least the support, lowered in proportion to the shard's share of its language's words."""
    low = low_bits(shards)
    key = F.col("key")
    return weights.where(F.col("weight") >= F.lit(support * WEIGHT)).select(key.bitwiseAND(F.lit(low)).cast("int").alias("shard"), key.bitwiseAND(F.lit(~low)).alias("h"))


def frequent(df: DataFrame, support: int, lang: str = "lang", text: str = "text", shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, size, phrase, f)`` of all phrases of one to three words with ``f >= support``, and ``(lang, n)``; both stored."""
    context = df.sparkSession.sparkContext
    rows = rows_of(df, lang, text, shards)
    sizes = stored(shard_words(rows), "phrase-words")
    pairs = stored(locally_frequent(hashed_weights(rows, sizes, (1, 2), shards), support, shards), "phrase-pairs")
    bits, packed = bitmap(pairs)
    near = context.broadcast(packed)

    def both_pairs(columns: list[np.ndarray], hashes: np.ndarray, language: str, shard: int) -> np.ndarray:
        """For each triple whether its two pairs may be frequent in the shard."""
        first, second = (has(near.value, bits_of(cleared(hashed(columns[k:k + 2], hashes, language), shards), shard, bits)) for k in (0, 1))
        return first & second

    triples = stored(locally_frequent(hashed_weights(rows, sizes, (3,), shards, both_pairs), support, shards), "phrase-triples")
    near.destroy()
    candidates = pairs.unionByName(triples).select(F.lit(-1).alias("shard"), "h").distinct()
    all_bits, all_packed = bitmap(candidates)
    union = context.broadcast(all_packed)

    def count(batches):
        for (language, _), ids, words in token_runs(batches):
            hashes = np.array(words.hashes, np.uint64)
            names = pa.array(list(words), pa.binary())
            for size in (1, 2, 3):
                found = []
                for columns in stretches(ids, size):
                    some = has(union.value, bits_of(cleared(hashed(columns, hashes, language), shards), -1, all_bits))
                    key = np.zeros(int(some.sum()), np.int64)
                    for c in columns:
                        key = (key << 21) | c[some]
                    found.append(key)
                keys, n = counted(np.concatenate(found))
                parts = [names.take(pa.array((keys >> (21 * k)) & ((1 << 21) - 1))) for k in range(size - 1, -1, -1)]
                phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary()))
                yield from small(pa.RecordBatch.from_arrays([pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(keys), np.int8)), [language]).cast(pa.string()), pa.array(np.full(len(keys), size, np.int32)), phrase, pa.array(n)], names=["lang", "size", "phrase", "f"]))

    # Shards no longer matter: a task names a phrase once and not once a shard.
    undealt = rows_of(df, lang, text, 1)
    whole = summed(undealt.mapInArrow(count, "lang string, size int, phrase binary, f long"), ["lang", "size", "phrase"], "f").where(F.col("f") >= support)
    phrases = stored(whole.withColumn("phrase", F.col("phrase").cast("string")), "phrases")
    union.destroy()
    return phrases, sizes.select("lang", "n").distinct()


def collocations(df: DataFrame, support: int = 10, top: int = 2000, covered_percent: int = 50, lang: str = "lang", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of two or three words of each language.

    ``a``, ``l`` and ``r`` count the phrase and its two parts at the cut with the lowest score, floor(10**6 * a * a / (l * r)),
    in whole numbers of up to 38 digits (counts have up to 14). Phrases that a longer one covers are left out. A null
    language is ``und``; null and empty texts have no words; repeated rows count as often as they are there; a text of
    any length is counted whole, in slices. Tables without rows give none. Other columns do not matter.
    """
    phrases, totals = frequent(df, support, lang, text, shards)
    counts = phrases.select("lang", "phrase", "f")
    w = F.split("phrase", " ")

    def words(first: int, n: int) -> Column:
        return F.array_join(F.slice(w, first, n), " ")

    longer = phrases.where("size > 1")
    cut = F.explode(F.filter(F.array(*[F.struct(F.lit(k).alias("k"), words(1, k).alias("left"), F.array_join(F.slice(w, k + 1, F.greatest(F.col("size") - k, F.lit(0))), " ").alias("right")) for k in (1, 2)]), lambda c: c["k"] < F.col("size")))
    parts = longer.select("lang", "phrase", "size", F.col("f").alias("a"), cut.alias("cut")).select("lang", "phrase", "size", "a", "cut.*")
    parts = parts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    parts = parts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    a, l, r = (F.col(c).cast("decimal(14,0)") for c in "alr")
    ratio = F.call_function("div", a * a * F.lit(Decimal(1_000_000)), l * r).cast("long")
    scored = parts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(ratio.alias("score"), "k", "l", "r")).alias("cut"))
    inner = phrases.where("size = 3").select("lang", F.explode(F.array(words(1, 2), words(2, 2))).alias("phrase"), "f")
    cover = inner.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    left = scored.join(cover, ["lang", "phrase"], "left").where(f"cover IS NULL OR 100 * cover < {covered_percent} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
