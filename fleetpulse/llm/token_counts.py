"""Token counts: a broadcast table of frequent pre-token lengths, worker caches for the rest, no shuffle.

The tokenizer drops white space, none of its patterns crosses it, and it lower-cases. So the tokens of a text
are those of its pre-tokens: runs of letters, digits and other signs where a word is plain ASCII, and the whole
word where it is not, as normalisation may then join its characters.
"""

from __future__ import annotations

import os
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import binaries, bounded_batches, carry

#: The frequent pre-tokens come from at most this many partitions and documents of each. They only save time.
SAMPLE_PARTITIONS, SAMPLE_DOCS = 32, 256
FREQUENT = 32_768
#: Entries of a worker's cache, and the longest pre-token (bytes) it keeps.
CACHE_ENTRIES, CACHE_LENGTH = 300_000, 64
#: Pre-tokens encoded in one call; the library's results take far more memory than the pre-tokens.
AT_ONCE = 1024

# The tokenizer's pattern for ASCII, endings such as 's first, and its mark of special strings.
PIECES = rb"[A-Za-z]+|(?i:'s|'t|'re|'ve|'m|'ll|'d)|[0-9]|[^\x09-\x0D\x20A-Za-z0-9]+"
SPECIAL_MARK = b"<|"
PLAIN = re.compile(PIECES)
#: A word with a sign beyond printable ASCII is one pre-token.
MIXED = re.compile(rb"[\x21-\x7E]*+[^\x09-\x0D\x20-\x7E][^\x09-\x0D\x20]*|" + PIECES)
ODD = re.compile(rb"[^\x09-\x0D\x20-\x7E]")

_worker: dict = {}


def tokenizer(path: str):
    """The library's tokenizer without truncation and padding, once for each worker."""
    if path not in _worker:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(path)
        found.no_truncation()
        found.no_padding()
        _worker[path] = found
    return _worker[path]


def pre_tokens(text: bytes) -> list[bytes]:
    """Stretches that are tokenized apart from each other. Special strings keep the words around them whole."""
    if SPECIAL_MARK in text:
        return text.split()
    return MIXED.findall(text) if ODD.search(text) else PLAIN.findall(text.lower())


def lengths(path: str, pieces: list[bytes]) -> list[int]:
    out: list[int] = []
    for i in range(0, len(pieces), AT_ONCE):
        found = tokenizer(path).encode_batch_fast([p.decode("utf-8", "replace") for p in pieces[i:i + AT_ONCE]], add_special_tokens=False)
        out += [len(e) for e in found]
    return out


def frequent_lengths(df: DataFrame, text: str, path: str, size: int = FREQUENT) -> tuple[bytes, bytes]:
    """The table: frequent pre-tokens joined by blanks, and their lengths as 16-bit numbers.

    Counted in a bounded sample, merged on the driver from at most SAMPLE_PARTITIONS lists of ``size``. One job
    reads the partitions of the sample and no others.
    """
    bounded_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, left = Counter(), SAMPLE_DOCS
        for batch in batches:
            for t in batch.column(0)[:left].to_pylist():
                found.update(p for p in pre_tokens(t or b"") if len(p) <= CACHE_LENGTH)
            left -= batch.num_rows
            if left <= 0:
                break
        top = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:size]
        packed = [b" ".join(w for w, _ in top)], [array("q", [n for _, n in top]).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.binary()) for p in packed], names=["w", "n"])

    lists = df.select(F.col(text).cast("binary")).mapInArrow(count, "w binary, n binary").rdd
    stride = max(1, -(-lists.getNumPartitions() // SAMPLE_PARTITIONS))
    chosen = list(range(0, lists.getNumPartitions(), stride))
    total: Counter = Counter()
    for w, n in df.sparkSession.sparkContext.runJob(lists, lambda rows: [(bytes(r["w"]), bytes(r["n"])) for r in rows], chosen) if chosen else []:
        total.update(dict(zip(w.split(), array("q", n), strict=True)))
    words = [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:size]]
    return b" ".join(words), array("H", lengths(path, words)).tobytes()


def count_tokens(df: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """``__row`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` of each text.

    Null and empty texts have 0 tokens. Rows are neither joined nor shuffled, so repeated rows stay, and an
    empty table gives an empty one. Special strings inside texts count as the library's default has it.
    Each partition adds its own pre-tokens to a bounded cache of its worker; a pre-token of any length is
    encoded whole.
    """
    if df.schema[text].dataType != T.StringType():
        df = df.withColumn(text, F.col(text).cast("string"))
    shared = df.sparkSession.sparkContext.broadcast(frequent_lengths(df, text, path))
    new = "n_bytes long, n_tokens long, over_limit boolean"

    def work(rows):
        words, sizes = shared.value
        frequent = dict(zip(words.split(), array("H", sizes), strict=True))
        cache = _worker.setdefault(("cache", path), {})
        for batch in rows:
            texts = binaries(batch, text)
            parts = [pre_tokens(t) for t in texts]
            seen = set().union(*parts)
            missing = [p for p in seen if p not in frequent and p not in cache]
            if len(cache) + len(missing) > CACHE_ENTRIES:
                kept = {p: cache[p] for p in seen if p in cache}
                cache.clear()
                cache.update(kept)
            rest = dict(zip(missing, lengths(path, missing), strict=True))
            rest.update((p, cache[p]) for p in seen if p in cache)
            cache.update((p, n) for p, n in rest.items() if len(p) <= CACHE_LENGTH and len(cache) < CACHE_ENTRIES)
            rest.update((p, frequent[p]) for p in seen if p in frequent)
            counts = [sum(map(rest.__getitem__, p)) for p in parts]
            yield [pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array([n > limit for n in counts])]

    return carry(df, new, work)
