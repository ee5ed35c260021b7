"""Byte-level BPE: greedy proposals, vectorised checks of adjacent tokens, exact merging where a check fails.

Ids are those of byte-pair merging in order of rank. A sequence of tokens is what merging gives exactly if
each token is what its own bytes merge to and no merge crosses the border of two neighbours before one of
the two sides has gone into a larger part. So the check of a word is a check of its adjacent pairs.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.llm.common import binaries, carry, release

#: Entries of a worker's cache, and the longest unit (characters) it keeps.
CACHE_ENTRIES, CACHE_LENGTH = 150_000, 64
NEVER = 1 << 40

# Unicode white space as the pre-tokenizer sees it.
SPACE = r"\t-\r \x85\xa0  -     　"

# The pre-tokenizer's pattern, with the letters and digits below U+0100 written out.
LETTER, DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^{SPACE}{LETTER}{DIGIT}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
LATIN = re.compile(PIECES)
#: A run without white space that has a character beyond U+00FF, with the blank before it, is one unit.
MIXED = re.compile(rf" ?[^{SPACE}\u0100-\U0010FFFF]*+[^\x00-\xFF{SPACE}][^{SPACE}]*|" + PIECES)
BEYOND_LATIN = re.compile("[^\x00-\xff]")
#: Up to this many bytes the best merge is looked for along the whole word.
SHORT = 24

_worker: dict = {}


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable ones themselves, others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class SpeculativeBpe:
    """Encoder and decoder over one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        from tokenizers import Tokenizer

        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.id_of = {self.bytes_of[i]: i for i in vocab.values()}
        self.digits = list(map(str, range(self.size)))
        self.letters = letters
        self.longest = max(map(len, self.id_of))
        self.single = [self.id_of[bytes([b])] for b in range(256)]
        #: Ranks by packed pair, and what each rank's merge makes.
        self.flat: dict[int, int] = {}
        self.whole: list[int] = []
        parts = np.full((self.size, 2), -1, np.int64)
        made = np.full(self.size, NEVER, np.int64)
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.flat[left * self.size + right] = r
            self.whole.append(whole)
            if parts[whole, 0] < 0:
                parts[whole], made[whole] = (left, right), r
        keys, ranks = (np.fromiter(x, np.int64, len(self.flat)) for x in (self.flat, self.flat.values()))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], ranks[order]
        self.left, self.left_until = self._edge(parts[:, 0], made)
        self.right, self.right_until = self._edge(parts[:, 1], made)
        #: Checked pairs in order with their verdicts, packed: as a dict they would take ten times the memory.
        self.checked, self.good = np.zeros(0, np.int64), np.zeros(0, bool)
        #: Of each token whether its own bytes merge to it: not yet known, yes, no.
        self.sound = np.zeros(self.size, np.int8)
        #: The ids of units of one token, which are most, once for all units.
        self.packed = [array("i", [i]).tobytes() for i in range(self.size)]

    def _edge(self, inner: np.ndarray, made: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The parts along one edge of each token, outermost first, and the merge that uses each up."""
        part, until = np.arange(self.size), np.full(self.size, NEVER, np.int64)
        parts, untils = [], []
        while (part >= 0).any():
            parts.append(part)
            untils.append(until)
            until = np.where(part >= 0, made[part], NEVER)
            part = np.where(part >= 0, inner[part], -1)
        return parts, untils

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """For each pair of adjacent tokens, whether no merge crosses their border."""
        good = np.ones(len(first), bool)
        for part_a, until_a in zip(self.right, self.right_until, strict=True):
            a, ua = part_a[first], until_a[first]
            for part_b, until_b in zip(self.left, self.left_until, strict=True):
                b = part_b[second]
                at = np.flatnonzero(good & (a >= 0) & (b >= 0))
                if not len(at):
                    continue
                key = a[at] * self.size + b[at]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                r = np.where(self.keys[place] == key, self.ranks[place], NEVER)
                good[at[(r < ua[at]) & (r <= until_b[second][at]) & (r < NEVER)]] = False
        return good

    def greedy(self, word: bytes) -> list[int]:
        out, at, n = [], 0, len(word)
        while at < n:
            end = min(n, at + self.longest)
            while (token := self.id_of.get(word[at:end])) is None:
                end -= 1
            out.append(token)
            at = end
        return out

    def exact(self, word: bytes) -> list[int]:
        """Merging in order of rank, from the left, with a heap over a linked list."""
        ids = list(map(self.single.__getitem__, word))
        if len(word) <= SHORT:
            get, size, whole = self.flat.get, self.size, self.whole
            ranks = [get(a * size + b, NEVER) for a, b in zip(ids, ids[1:], strict=False)]
            while ranks and (r := min(ranks)) < NEVER:
                i = ranks.index(r)
                ids[i] = whole[r]
                del ids[i + 1], ranks[i]
                if i:
                    ranks[i - 1] = get(ids[i - 1] * size + ids[i], NEVER)
                if i < len(ranks):
                    ranks[i] = get(ids[i] * size + ids[i + 1], NEVER)
            return ids
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        rank = lambda a, b: self.flat.get(a * self.size + b, NEVER)
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := rank(a, b)) < NEVER]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = self.whole[r], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := rank(ids[x], ids[y])) < NEVER:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word: proposed, checked, and merged exactly where the check fails."""
        found = [self.greedy(w) for w in words]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter((i for f in found for i in f), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(found)), sizes)
        bad = np.zeros(len(found), bool)
        for token in np.unique(ids[self.sound[ids] == 0]).tolist():
            self.sound[token] = 1 if self.exact(self.bytes_of[token]) == [token] else 2
        bad[owner[self.sound[ids] == 2]] = True
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        if len(inside):
            pairs, where = np.unique(ids[inside] * self.size + ids[inside + 1], return_inverse=True)
            place = np.searchsorted(self.checked, pairs)
            known = np.zeros(len(pairs), bool)
            if len(self.checked):
                known = self.checked[np.minimum(place, len(self.checked) - 1)] == pairs
            new, good = pairs[~known], np.zeros(len(pairs), bool)
            good[known], good[~known] = self.good[place[known]], self.compatible(new // self.size, new % self.size)
            if len(self.checked) + len(new) > 2 * CACHE_ENTRIES:
                self.checked, self.good = pairs, good
            else:
                self.checked, self.good = np.insert(self.checked, place[~known], new), np.insert(self.good, place[~known], good[~known])
            bad[owner[inside[~good[where]]]] = True
        for i in np.flatnonzero(bad).tolist():
            found[i] = self.exact(words[i])
        return found

    def pre_tokens(self, unit: str) -> list[bytes]:
        if not BEYOND_LATIN.search(unit):
            return [unit.encode()]
        return [bytes(self.letters[c] for c in part) for part, _ in self.pre_tokenizer.pre_tokenize_str(unit)]

    def units(self, units: list[str]) -> list[list[int]]:
        """Ids of units: pre-tokens, or stretches that no pre-token crosses."""
        if not BEYOND_LATIN.search("".join(units)):
            return self.words([u.encode() for u in units])
        parts = [self.pre_tokens(u) for u in units]
        distinct = list(dict.fromkeys(p for ps in parts for p in ps))
        ids = dict(zip(distinct, self.words(distinct), strict=True))
        return [[i for p in ps for i in ids[p]] for ps in parts]

    def packs(self, units: list[str]) -> list[bytes]:
        """Ids of units as 32-bit numbers one after another."""
        return [self.packed[ids[0]] if len(ids) == 1 else array("i", ids).tobytes() for ids in self.units(units)]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes that the ids stand for, unpaired ones not yet replaced."""
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def split(self, text: str) -> list[str]:
        """Units and special strings of a text, in order."""
        units = (MIXED if BEYOND_LATIN.search(text) else LATIN).findall
        if not any(s in text for s in self.special):
            return units(text)
        out: list[str] = []
        for i, part in enumerate(re.split("(" + "|".join(map(re.escape, self.special)) + ")", text)):
            out += [part] if i % 2 else units(part)
        return out


def codec(path: str) -> SpeculativeBpe:
    if path not in _worker:
        _worker[path] = SpeculativeBpe(path)
        # The parsed file is several times as large as what stays of it.
        release()
    return _worker[path]


def encode_decode(df: DataFrame, path: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """``__row`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256``; with ``keep_ids`` also ``ids`` and ``decoded``.

    Null and empty texts have no ids, and the digests of nothing. Special strings in texts are special
    tokens. Rows are handled one by one, so repeated rows and tables without rows pass through. Memory of a
    worker: one slice of a batch, its units and a bounded cache.
    """
    if df.schema[text].dataType != T.StringType():
        df = df.withColumn(text, F.col(text).cast("string"))
    new = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        new += ", ids array<int>, decoded string"

    def work(rows):
        bpe = codec(path)
        cache: dict[str, bytes] = _worker.setdefault(("cache", path), {})
        for batch in rows:
            parts = [bpe.split(t.decode("utf-8", "replace")) for t in binaries(batch, text)]
            seen = set().union(*parts)
            missing = [u for u in seen if u not in cache and u not in bpe.special]
            found = {u: bpe.packed[i] for u, i in bpe.special.items()}
            found |= {u: cache[u] for u in seen if u in cache}
            if len(cache) + len(missing) > CACHE_ENTRIES:
                cache.clear()
                cache.update(found)
            found.update(zip(missing, bpe.packs(missing), strict=True))
            cache.update((u, found[u]) for u in missing if len(u) <= CACHE_LENGTH and len(cache) < CACHE_ENTRIES)
            del seen, missing
            counts, coded, decoded, listed, back = [], [], [], [], []
            for i, units in enumerate(parts):
                packed = b"".join([found[u] for u in units])
                parts[i] = None
                ids = array("i", packed).tolist()
                out = bpe.decode(ids).decode("utf-8", "replace").encode()
                counts.append(len(ids))
                coded.append(hashlib.sha256(",".join([bpe.digits[i] for i in ids]).encode()).hexdigest())
                decoded.append(hashlib.sha256(out).hexdigest())
                if keep_ids:
                    listed.append(packed)
                    back.append(out)
            arrays = [pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            if keep_ids:
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                arrays += [pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(listed), np.int32))), pa.array(back, pa.string())]
            yield arrays
        _worker.clear()

    return carry(df, new, work, by=text)
