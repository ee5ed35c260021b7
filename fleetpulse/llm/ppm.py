"""Language-model scoring: prediction by partial matching over bytes, pretrained on the training documents.

The corpus gives counts of byte strings one longer than the longest context; shorter ones follow by adding
up. All are kept. A symbol that a context does not know is escaped (method C: as often as the context has distinct
symbols), and the shorter context leaves out all symbols that the longer one knows. What is left out
depends on the longer context alone, so the score of a symbol depends on the string that ends with it alone.
The most frequent strings are looked up in a broadcast table of their exact scores; all others, seen or
not, are counted for each text and scored by joins with the stored counts of every length.

Beside it stands a smoothed unigram of words over exact counts of the whole vocabulary: frequent words from a
broadcast table, all others by a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import binaries, bounded_batches, carry, flat, stored, sums

#: Longest context in bytes, and the strings that the broadcast table of exact scores holds at most.
ORDER, TRIE = 5, 1 << 19
#: Entries of the broadcast table of frequent words.
FREQUENT = 1 << 18
# Bytes that no UTF-8 text has: before the first byte, and after the last.
BEFORE, AFTER = 0xFE, 0xFF
SYMBOLS = 255  # all bytes but BEFORE
#: Strings sorted at once, and words counted at once, in a task.
GATHER, WORDS = 1 << 21, 1 << 17
#: Bytes coded or scored at once.
PORTION = 1 << 19
# Fixed values of the base: smoothing, and the token that ends a text (no word has white space).
ADD, END = 0.1, b"\n"
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
SPREAD = np.uint64(0x9E3779B97F4A7C15)


def codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol of each text with the ORDER bytes before it as one number, and where texts start."""
    return coded([bytes([BEFORE]) * ORDER + t + bytes([AFTER]) for t in texts])


def coded(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The same of parts that have the ORDER bytes before them in front."""
    data, starts = flat(parts)
    code = np.zeros(max(0, len(data) - ORDER), np.uint64)
    for k in range(ORDER + 1):
        code <<= np.uint64(8)
        code |= data[k:k + len(code)]
    inside = np.ones(len(code), bool)
    for k in range(1, ORDER + 1):
        inside[starts[1:-1] - k] = False
    places = np.zeros(len(parts) + 1, np.int64)
    np.cumsum(np.diff(starts) - ORDER, out=places[1:])
    return code[inside], places


def portions(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts in parts of bounded size, several short ones or a piece of a long one at a time: owners and parts."""
    owners, parts, size = [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, len(t) + 1, PORTION):
            end = AFTER if at + PORTION > len(t) else None
            part = (bytes([BEFORE]) * ORDER if at == 0 else t[at - ORDER:at]) + t[at:at + PORTION] + (bytes([end]) if end else b"")
            if parts and size + len(part) > PORTION:
                yield owners, parts
                owners, parts, size = [], [], 0
            owners.append(i)
            parts.append(part)
            size += len(part)
    if parts:
        yield owners, parts


def gather(df: DataFrame, text: str) -> DataFrame:
    """(word, gram, n): exact counts over all rows, stored. Each task adds up its own before the shuffle."""
    bounded_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        held, size = [], 0

        def said(w: list, g: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            first, second = (pa.array(w, pa.binary()), pa.nulls(len(w), pa.int64())) if len(w) else (pa.nulls(len(g), pa.binary()), pa.array(g.view(np.int64)))
            return pa.RecordBatch.from_arrays([first, second, pa.array(n, pa.int64())], names=["word", "gram", "n"])

        for batch in batches:
            texts = [(t or b"").lower() for t in batch.column(0).to_pylist()]
            for t in texts:
                words.update(t.split())
            words[END] += len(texts)
            if len(words) > WORDS:
                yield said(list(words), np.array([]), list(words.values()))
                words.clear()
            for _, parts in portions(texts):
                held.append(coded(parts)[0])
                size += len(held[-1])
                if size > GATHER:
                    g, n = np.unique(np.concatenate(held), return_counts=True)
                    held, size = [], 0
                    yield said([], g, n)
        if words:
            yield said(list(words), np.array([]), list(words.values()))
        if size:
            g, n = np.unique(np.concatenate(held), return_counts=True)
            yield said([], g, n)

    found = df.select(F.col(text).cast("string").cast("binary")).mapInArrow(count, "word binary, gram long, n long")
    return stored(found.groupBy("word", "gram").agg(F.sum("n").alias("n")), "corpus-counts")


def most(df: DataFrame, limit: int) -> DataFrame:
    """Rows with the largest ``n``, up to a limit: those above a bound taken from a histogram by powers of two."""
    step = F.floor(F.log2("n") * 8).cast("int")
    left, bound = limit, 0
    for s, n in df.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect():
        if n > left:
            bound = s + 1
            break
        left -= n
    return df.where(step >= bound)


@dataclass
class Level:
    """Strings of one length: codes in order with counts, and their contexts in order with what they total."""

    grams: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    log_denominator: np.ndarray  # of a context that is looked at first
    log_escape: np.ndarray
    lower_log_denominator: np.ndarray  # of the next shorter context after an escape from this one
    lower_log_escape: np.ndarray


class Direct:
    """Open addressing from codes to values."""

    def __init__(self, code: np.ndarray, value: np.ndarray) -> None:
        self.slots = np.full(1 << max(4, (4 * max(1, len(code)) - 1).bit_length()), EMPTY)
        self.values = np.zeros(len(self.slots))
        self.shift = np.uint64(64 - (len(self.slots).bit_length() - 1))
        slot, left = (code * SPREAD) >> self.shift, np.arange(len(code))
        while len(left):
            free = self.slots[slot[left]] == EMPTY
            self.slots[slot[left[free]]] = code[left[free]]
            won = self.slots[slot[left]] == code[left]
            self.values[slot[left[won]]] = value[left[won]]
            left = left[~won]
            slot[left] = (slot[left] + np.uint64(1)) & np.uint64(len(self.slots) - 1)

    def look_up(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none), and the places of codes that are not in the table."""
        out, slot = np.zeros(len(code)), (code * SPREAD) >> self.shift
        there = self.slots[slot]
        hit = there == code
        out[hit] = self.values[slot[hit]]
        probe, rest = np.flatnonzero(~hit & (there != EMPTY)), [np.flatnonzero(there == EMPTY)]
        while len(probe):
            slot[probe] = (slot[probe] + np.uint64(1)) & np.uint64(len(self.slots) - 1)
            there = self.slots[slot[probe]]
            hit = there == code[probe]
            out[probe[hit]] = self.values[slot[probe[hit]]]
            rest.append(probe[there == EMPTY])
            probe = probe[~hit & (there != EMPTY)]
        return out, np.concatenate(rest)


class Trie:
    """The whole model in memory, over the strings it is given. Jobs use the stored counts instead; see exact()."""

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]]):
        """grams: for each context length from 0 on, codes (symbol last) and their counts."""
        self.levels: list[Level] = []
        kept: tuple[np.ndarray, np.ndarray] | None = None
        total = distinct = np.array([])
        for k, (code, count) in enumerate(grams):
            order = np.argsort(code)
            code, count = code[order], count[order].astype(np.float64)
            below = np.zeros(len(code))
            if kept is not None:
                at, known = find(kept[0], code & mask(k))
                code, count, below = code[known], count[known], kept[1][at[known]]
            context, start = np.unique(code >> np.uint64(8), return_index=True)
            mass = np.add.reduceat(count, start) if len(code) else np.array([])
            kinds = np.diff(np.append(start, len(code))).astype(np.float64)
            lower_total, lower_kinds = np.zeros(len(context)), np.full(len(context), np.nan)
            if kept is not None and len(context):
                at, _ = find(self.levels[-1].contexts, context & mask(k - 1))
                lower_kinds = distinct[at] - kinds
                lower_total = total[at] - np.add.reduceat(below, start) + lower_kinds
            with np.errstate(divide="ignore", invalid="ignore"):
                denominator = np.log10(lower_total)
                escape = np.where(lower_kinds > 0, np.log10(lower_kinds) - denominator, 0.0)
            self.levels.append(Level(code, np.log10(count), context, np.log10(mass + kinds), np.log10(kinds) - np.log10(mass + kinds), denominator, escape))
            kept, total, distinct = (code, count), mass, kinds
        known = len(self.levels[0].grams)
        self.log_rest = -np.log10(max(1, SYMBOLS - known))
        top = self.levels[-1]
        at, _ = find(top.contexts, top.grams >> np.uint64(8))
        self.direct = Direct(top.grams, top.counts - top.log_denominator[at] if len(at) else top.counts)

    def score(self, code: np.ndarray) -> np.ndarray:
        """Log10 probability of each symbol after its context."""
        out, left = self.direct.look_up(code)
        escaped = np.full(len(left), -1)
        for k in range(len(self.levels) - 1, -1, -1):
            if not len(left):
                break
            level = self.levels[k]
            c = code[left] & mask(k + 1)
            context, there = find(level.contexts, c >> np.uint64(8))
            gram, known = find(level.grams, c)
            first = escaped < 0
            above = self.levels[k + 1] if k + 1 < len(self.levels) else level
            e = np.maximum(escaped, 0)
            if len(level.contexts):
                down, esc = level.log_denominator[context], level.log_escape[context]
                if len(above.contexts):
                    down, esc = np.where(first, down, above.lower_log_denominator[e]), np.where(first, esc, above.lower_log_escape[e])
                out[left[known]] += (level.counts[gram] - down)[known]
                out[left[there & ~known]] += esc[there & ~known]
            escaped = np.where(there, context, -1)[~known]
            left = left[~known]
        out[left] += self.log_rest
        return out


def mask(size: int) -> np.uint64:
    return np.uint64((1 << (8 * size)) - 1)


def find(table: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of codes in an ordered table, and whether they are there."""
    if not len(table):
        return np.zeros(len(code), np.int64), np.zeros(len(code), bool)
    at = np.minimum(np.searchsorted(table, code), len(table) - 1)
    return at, table[at] == code


def strings(counts: DataFrame) -> list[DataFrame]:
    """(gram, n) of all strings of each length, shortest first; each length adds up the next longer one."""
    levels = [counts.where("gram IS NOT NULL").select("gram", "n")]
    for k in range(ORDER - 1, -1, -1):
        levels.append(stored(levels[-1].groupBy(ending("gram", k + 1).alias("gram")).agg(F.sum("n").alias("n")), f"strings-{k}"))
    return levels[::-1]


def ending(code: str, size: int) -> Column:
    return F.col(code).bitwiseAND(F.lit(int(mask(size))).cast("long"))


def contexts(levels: list[DataFrame], k: int) -> DataFrame:
    """Contexts of k bytes: what they total, and what the next shorter one totals after an escape from them."""
    def totals(grams: DataFrame, *more: Column) -> DataFrame:
        return grams.groupBy(F.shiftright("gram", 8).alias("context")).agg(F.sum("n").cast("double").alias("mass"), F.count("*").cast("double").alias("kinds"), *more)

    if k == 0:
        return totals(levels[0]).withColumns({"lower_mass": F.lit(0.0), "lower_kinds": F.lit(0.0)})
    shorter = levels[k - 1].select(F.col("gram").alias("end"), F.col("n").alias("below"))
    known = totals(levels[k].withColumn("end", ending("gram", k)).join(shorter, "end"), F.sum("below").alias("below"))
    lower = totals(levels[k - 1]).select(F.col("context").alias("end"), F.col("mass").alias("all_mass"), F.col("kinds").alias("all_kinds"))
    left = F.col("all_kinds") - F.col("kinds")
    return known.withColumn("end", ending("context", k - 1)).join(lower, "end").select(
        "context", "mass", "kinds", (F.col("all_mass") - F.col("below") + left).alias("lower_mass"), left.alias("lower_kinds"))


def exact(codes: DataFrame, levels: list[DataFrame], longest: DataFrame) -> DataFrame:
    """(gram, first) of distinct codes (``gram``): log10 probability of the last byte after those before it.

    ``longest``: contexts of ORDER bytes. On the way down each length is asked for the endings of what the longer one
    does not know; on the way up ``first`` is the score if the string's own context is looked at first,
    ``after`` that of the rest after an escape from it. A string has at most 256 longer ones, so no key is large.
    """
    asked = []
    for k in range(ORDER, -1, -1):
        found = stored(codes.join(levels[k], "gram", "left"), f"asked-{k}")
        asked.append(found)
        codes = found.where("n IS NULL").select(ending("gram", k).alias("gram")).distinct()
    rest = F.lit(-float(np.log10(max(1, SYMBOLS - levels[0].count()))))
    below = None
    for k, found in enumerate(reversed(asked)):
        at = found.withColumn("context", F.shiftright("gram", 8)).join(longest if k == ORDER else contexts(levels, k), "context", "left")
        if below is None:
            after = first = rest
        else:
            at = at.withColumn("end", F.when(F.col("n").isNull(), ending("gram", k))).join(below, "end", "left")
            escape = F.when(F.col("lower_kinds") > 0, F.log10("lower_kinds") - F.log10("lower_mass")).otherwise(0.0)
            after = F.when(F.col("lower_n").isNotNull(), F.log10("lower_n") - F.log10("lower_mass")).otherwise(escape + F.col("lower_after"))
            first = F.col("lower_first")
        total = F.log10(F.col("mass") + F.col("kinds"))
        # Stored one by one: as one plan the levels take the driver more memory than all else.
        done = stored(at.withColumn("after", after).select(
            "gram", "n", "after", F.when(F.col("n").isNotNull(), F.log10("n") - total).when(F.col("mass").isNotNull(), F.log10("kinds") - total + F.col("after")).otherwise(first).alias("first")), f"scores-{k}")
        below = done.select(F.col("gram").alias("end"), F.col("n").alias("lower_n"), F.col("after").alias("lower_after"), F.col("first").alias("lower_first"))
    return done.select("gram", "first")


def tallied(owner: np.ndarray, code: np.ndarray, size: int) -> pa.Array:
    """For each of ``size`` texts its codes with how often it has them."""
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    new = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (code[1:] != code[:-1]))[:len(code)])
    k = np.diff(np.append(new, len(code)))
    pairs = pa.StructArray.from_arrays([pa.array(code[new].view(np.int64)), pa.array(k, pa.int64())], names=["gram", "k"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[new], np.arange(size + 1)), pa.int32()), pairs)


def held_out(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def score(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Both models see texts with A-Z lower-cased and learn from rows whose key's crc32 is no multiple of 10 (a null
    key counts as empty text). A null text is as an empty one: its end alone is scored. Repeated rows stay,
    and count as often in training. Without training rows every symbol is equally likely. No rows give none.
    """
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"), held_out(F.col(key)).alias("held_out"))
    counts = gather(rows.where("NOT held_out"), "text")
    words = counts.where("word IS NOT NULL").select("word", "n")
    total, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    below = np.log10(total + ADD * (kinds + 1))
    table = most(words, FREQUENT).toArrow()
    levels = strings(counts)
    longest = stored(contexts(levels, ORDER), "contexts")
    top = most(levels[ORDER], TRIE).withColumn("context", F.shiftright("gram", 8)).join(longest, "context")
    top = top.select("gram", (F.log10("n") - F.log10(F.col("mass") + F.col("kinds"))).alias("first")).toArrow()
    model = Direct(top["gram"].to_numpy().astype(np.int64).view(np.uint64), top["first"].to_numpy())
    shared = df.sparkSession.sparkContext.broadcast((model, table["word"].to_pylist(), (np.log10(table["n"].to_numpy() + ADD) - below).tolist()))

    def work(batches):
        direct, names, values = shared.value
        frequent = dict(zip(names, values, strict=True))
        for batch in batches:
            texts = [t.lower() for t in binaries(batch, "text")]
            n, known, base, rare = [], [], [], []
            for t in texts:
                tokens = [*t.split(), END]
                got = [frequent.get(w) for w in tokens]
                seen = [v for v in got if v is not None]
                n.append(len(tokens))
                known.append(len(seen))
                base.append(sum(seen))
                missed = Counter([w for w, v in zip(tokens, got, strict=True) if v is None]) if len(seen) < len(tokens) else {}
                rare.append([{"word": w, "k": k} for w, k in missed.items()])
            value = np.zeros(len(texts))
            owner, other = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for owners, parts in portions(texts):
                code, starts = coded(parts)
                found, left = direct.look_up(code)
                np.add.at(value, owners, sums(found, starts))
                owner.append(np.array(owners)[np.searchsorted(starts, left, "right") - 1])
                other.append(code[left])
            yield [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()),
                   pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())]))), pa.array(value), tallied(np.concatenate(owner), np.concatenate(other), len(texts))]

    done = carry(rows, "n_tokens long, n_known long, base double, rare array<struct<word:binary,k:long>>, score double, others array<struct<gram:long,k:long>>", work)
    done = done.select("__row.doc_id", "__row.held_out", "n_tokens", "n_known", "base", "rare", "score", "others", F.monotonically_increasing_id().alias("row"))
    done = stored(done, "scored")
    shared.destroy()
    rare = done.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.k")
    joined = rare.join(words, "word", "left")
    value = F.col("k") * (F.log10(F.coalesce("n", F.lit(0)) + F.lit(ADD)) - F.lit(float(below)))
    rest = joined.groupBy("row").agg(F.sum(value).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("found"))
    others = done.select("row", F.explode("others").alias("o")).select("row", "o.gram", "o.k")
    scores = exact(others.select("gram").distinct(), levels, longest)
    strange = others.join(scores, "gram").groupBy("row").agg(F.sum(F.col("k") * F.col("first")).alias("others_score"))
    return done.drop("rare", "others").join(rest, "row", "left").join(strange, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("others_score", F.lit(0.0))).alias("score"))
