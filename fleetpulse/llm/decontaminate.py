"""Benchmark decontamination: an FM-index over each shard of the training texts, searched for the test windows.

A shard is one Arrow batch of documents. Its words are numbers of the test vocabulary, 0 for any other word;
runs shorter than the shortest window cannot hold one and are left out. The suffixes are sorted in full
(runs end in separators that sort by place), the Burrows-Wheeler transform lies in a wavelet matrix, all
windows are searched backward at once by its ranks, and rows are located by walking to sampled positions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import WORD_TABLE, binaries, carry, plain_words, stored, sums

# Fixed value: words of a window.
WINDOW = 10
#: Bytes of test texts in one block (one broadcast and one pass over each batch), words of one index, sampling.
BLOCK_BYTES, INDEX_WORDS, SAMPLE = 8 << 20, 1 << 20, 8
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class TestWindows:
    """Distinct windows of a block of test items, as rows of word numbers from 1 on, padded with 0 in front."""

    __test__ = False

    def __init__(self, items: list[tuple[str, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        numbered: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in plain_words(text)]
            for k in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                numbered.setdefault(tuple(ids[k:k + WINDOW]), set()).add(item)
        self.rows = np.array([(0,) * (WINDOW - len(w)) + w for w in numbered], np.int64).reshape(-1, WINDOW)
        self.sizes = (self.rows > 0).sum(axis=1)
        self.names = sorted({i for s in numbered.values() for i in s})
        at = {n: k for k, n in enumerate(self.names)}
        self.items = [np.array(sorted(at[i] for i in s), np.int64) for s in numbered.values()]


class FmIndex:
    """Over numbers from 1 to ``symbols``; 0 separates, and the sequence ends in 0."""

    def __init__(self, seq: np.ndarray, symbols: int):
        n = len(seq)
        order = suffix_order(seq)
        before = seq[order - 1]
        self.first = np.zeros(symbols + 2, np.int64)
        np.cumsum(np.bincount(seq, minlength=symbols + 1), out=self.first[1:])
        # Sampled: every SAMPLE-th position, and where a run starts, so no walk crosses a separator.
        marked = (order % SAMPLE == 0) | (before == 0)
        self.marked, self.marked_rank, self.places = marked, np.cumsum(marked) - 1, order[marked]
        self.bits = [(before >> b) & 1 for b in range(max(1, int(symbols).bit_length()))][::-1]
        self.ones, self.zeros = [], []
        rest = before
        for level in range(len(self.bits)):
            bit = ((rest >> (len(self.bits) - 1 - level)) & 1).astype(bool)
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.bits[level] = bit
            self.ones.append(ones)
            self.zeros.append(n - int(ones[-1]))
            rest = np.concatenate([rest[~bit], rest[bit]])
        self.start = np.zeros(symbols + 1, np.int64)
        self.start = self._down(np.arange(symbols + 1), np.zeros(symbols + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one = ones[at].astype(np.int64)
            at = np.where((symbol >> (len(self.ones) - 1 - level)) & 1, zeros + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each row of the transform."""
        return self._down(symbol, at) - self.start[symbol]

    def search(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) row of the suffixes that start with each window."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(self.marked), np.int64)
        for k in range(windows.shape[1] - 1, -1, -1):
            at = np.flatnonzero((windows[:, k] > 0) & (low < high))
            c = windows[at, k]
            low[at] = self.first[c] + self.rank(c, low[at])
            high[at] = self.first[c] + self.rank(c, high[at])
        return low, np.maximum(low, high)

    def locate(self, row: np.ndarray) -> np.ndarray:
        """Positions of rows, by steps to the preceding symbol until a sampled one."""
        row, steps, out = row.copy(), np.zeros(len(row), np.int64), np.full(len(row), -1, np.int64)
        left = np.arange(len(row))
        while len(left):
            here = row[left]
            found = self.marked[here]
            out[left[found]] = self.places[self.marked_rank[here[found]]] + steps[left[found]]
            left, here = left[~found], here[~found]
            symbol, at = np.zeros(len(here), np.int64), here
            for bit, ones, zeros in zip(self.bits, self.ones, self.zeros, strict=True):
                b, one = bit[at], ones[at].astype(np.int64)
                symbol, at = symbol * 2 + b, np.where(b, zeros + one, at - one)
            row[left] = self.first[symbol] + at - self.start[symbol]
            steps[left] += 1
        return out


def suffix_order(seq: np.ndarray) -> np.ndarray:
    """All suffixes in order; separators sort before words and among each other by place, so no two are equal."""
    n = len(seq)
    separator = seq == 0
    rank = np.where(separator, np.cumsum(separator) - 1, seq + int(separator.sum())).astype(np.int64)
    top = int(rank.max()) + 1
    # The first sort is by one, two or three symbols, as many as fit 63 bits.
    width, key = 1, rank
    while width < 3 and top ** (width + 1) < 1 << 62:
        key = key * top + rank[np.minimum(np.arange(n) + width, n - 1)]
        width += 1
    order = np.argsort(key)
    sorted_key = key[order]
    fresh = np.ones(n, bool)
    fresh[1:] = sorted_key[1:] != sorted_key[:-1]
    starts = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order] = starts
    alone = fresh & np.append(fresh[1:], True)
    open_ = order[~alone]
    while len(open_):
        old, following = rank[open_], rank[np.minimum(open_ + width, n - 1)]
        o = np.argsort(old * n + following)
        open_, old, following = open_[o], old[o], following[o]
        i = np.arange(len(open_))
        group = np.ones(len(open_), bool)
        group[1:] = old[1:] != old[:-1]
        fresh = group.copy()
        fresh[1:] |= following[1:] != following[:-1]
        rank[open_] = old + np.maximum.accumulate(np.where(fresh, i, 0)) - np.maximum.accumulate(np.where(group, i, 0))
        open_ = open_[~(fresh & np.append(fresh[1:], True))]
        width *= 2
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def pieces(ids: np.ndarray, shortest: int) -> list[np.ndarray]:
    """Positions of runs of test words, each run with the separator that ends it, in pieces of one index each.

    ``ids`` ends every document with a 0. A run longer than a piece is cut with a window's overlap.
    """
    inside = np.concatenate([[False], ids > 0, [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= shortest
    begin, end = begin[long], end[long]
    if len(begin) and (end - begin).max() > INDEX_WORDS:
        cut = [(b, min(e, b + INDEX_WORDS)) for lo, e in zip(begin.tolist(), end.tolist(), strict=True) for b in range(lo, max(lo + 1, e - WINDOW + 1), INDEX_WORDS - WINDOW)]
        begin, end = np.array([c[0] for c in cut]), np.array([c[1] for c in cut])
    out, size = [], np.cumsum(end - begin + 1)
    for k in range(int(size[-1] // INDEX_WORDS) + 1 if len(size) else 0):
        mine = np.flatnonzero((size - 1) // INDEX_WORDS == k)
        if len(mine):
            lengths = end[mine] - begin[mine] + 1
            inner = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            at = np.repeat(begin[mine], lengths) + inner
            at[np.cumsum(lengths) - 1] = -1
            out.append(at)
    return out


def find(docs: list[list[bytes]], tests: TestWindows) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Whether each word (documents end to end, one more place after each) is hit, where documents start, and items."""
    vocabulary = tests.vocabulary
    starts = np.zeros(len(docs) + 1, np.int64)
    np.cumsum([len(d) + 1 for d in docs], out=starts[1:])
    get = vocabulary.get
    ids = np.fromiter((i for d in docs for i in (*map(get, d, repeat(0)), 0)), np.int64, int(starts[-1]))
    change, pairs = np.zeros(len(ids) + 1, np.int64), []
    for at in pieces(ids, int(tests.sizes.min())):
        index = FmIndex(np.where(at >= 0, ids[at], 0), len(vocabulary))
        low, high = index.search(tests.rows)
        for group in np.array_split(np.flatnonzero(high > low), max(1, int((high - low).sum() // INDEX_WORDS))):
            count = (high - low)[group]
            if not len(group):
                continue
            window = np.repeat(group, count)
            place = at[index.locate(np.repeat(low[group] - np.cumsum(count) + count, count) + np.arange(count.sum()))]
            np.add.at(change, place, 1)
            np.add.at(change, place + tests.sizes[window], -1)
            owner = np.searchsorted(starts, place, side="right") - 1
            pairs.append(np.unique(owner * len(tests.rows) + window))
    # Overlapping runs may locate one place twice, which changes neither hits nor items.
    found: list[set] = [set() for _ in docs]
    for code in np.unique(np.concatenate(pairs)).tolist() if pairs else []:
        found[code // len(tests.rows)].update(tests.items[code % len(tests.rows)].tolist())
    return np.cumsum(change)[:-1] > 0, starts, [[tests.names[i] for i in sorted(s)] for s in found]


def runs_of(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str, bytes]]]:
    """Test items (distinct; null texts have no words) in blocks of about BLOCK_BYTES; one at a time is on the driver."""
    rows = benchmark.where(F.col(text).isNotNull()).select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(text).cast("string").alias("text")).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // BLOCK_BYTES)
    for b in range(count):
        yield [(r["item"], r["text"].encode()) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == b).collect()]
    if not count:
        yield []


def scan(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """``__row`` with ``n_words``, ``runs`` (hit words as merged half-open ranges), ``items`` and ``contaminated``.

    ``items`` are strings in order. Null and empty texts have no words; an empty benchmark hits nothing. Repeated
    rows stay. Documents are neither joined nor shuffled: each block of tests adds its hits to those before, which
    are stored in between, so that one block is broadcast at a time.
    """
    state = df.select(F.struct("*").alias("row"), F.lit(0).cast("long").alias("n"), F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("runs"), F.expr("cast(array() as array<string>)").alias("items"))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    shared = None
    for block in blocks(benchmark, item, item_text):
        if shared is not None:
            state = stored(state, "contamination")
            shared.destroy()
        shared = df.sparkSession.sparkContext.broadcast(TestWindows(block))

        def work(rows, shared=shared):
            tests = shared.value
            for batch in rows:
                texts = binaries(batch.field("row"), text)
                words = [t.translate(WORD_TABLE).split() for t in texts]
                n, runs, items = [len(w) for w in words], batch.field("runs").to_pylist(), batch.field("items").to_pylist()
                if len(tests.rows):
                    hit, starts, found = find(words, tests)
                    for d in np.flatnonzero(sums(hit.astype(np.int64), starts)).tolist():
                        mine = hit[starts[d]:starts[d + 1]]
                        for r in runs[d]:
                            mine[r["start"]:r["end"]] = True
                        runs[d] = [{"start": a, "end": b} for a, b in runs_of(mine)]
                        items[d] = sorted({*items[d], *found[d]}, key=str.encode)
                yield [pa.array(n, pa.int64()), pa.array(runs, run_type), pa.array(items, pa.list_(pa.string()))]

        state = carry(state, "n long, runs array<struct<start:long,end:long>>, items array<string>", work).select("__row.row", "n", "runs", "items")
    return state.select(F.col("row").alias("__row"), F.col("n").alias("n_words"), "runs", "items", (F.size("runs") > 0).alias("contaminated"))


def cut(scanned: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input row) and ``clean``: its text without the removal spans; null where nothing is left."""

    def work(rows):
        for batch in rows:
            out = []
            for t, runs in zip(binaries(batch.field("row"), text), batch.field("runs").to_pylist(), strict=True):
                if runs:
                    places = [m.span() for m in WORD.finditer(t)]
                    kept, at = [], 0
                    for r in runs:
                        kept.append(t[at:places[r["start"]][0]])
                        at = places[r["end"] - 1][1]
                    t = b"".join([*kept, t[at:]])
                    out.append(t.decode("utf-8", "replace") if plain_words(t) else None)
                else:
                    out.append(t.decode("utf-8", "replace"))
            yield [pa.array(out, pa.string())]

    done = carry(scanned.select(F.col("__row").alias("row"), "runs"), "clean string", work)
    return done.select("__row.row", "clean", (F.size("__row.runs") > 0).alias("changed"))
