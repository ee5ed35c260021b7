"""Near-duplicate groups: ProbMinHash signatures of weighted word shingles, bands, exact checks, components.

Each shingle (five words; its weight grows with its count) sends points of a Poisson process, at a rate of its
share of the document's weight, to the parts of the signature; a part keeps the shingle of its first point.
Points later than the last first point cannot matter, so a document's process ends there. Two documents agree
in a part with the probability Jaccard of their weights. Documents with repeated shingles have a second signature
with all weights 1, which agrees with the set Jaccard; the others' one signature says both. Documents that agree in a whole band are candidates, and
candidates with a similarity (set or probability Jaccard) of 0.8 or more are linked.

Equal texts are one node. A band's bucket of few nodes gives all its pairs. In a larger one each node is
held against the bucket's leader; nodes that end up in another component than their leader are held against
all nodes of other components in the bucket, block by block: sketches of one byte for each part of a
signature tell which pairs come near enough for an exact check, and one link for each two components stays.
Nothing is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import binaries, carry, plain_words, portions, stored

SHINGLE, SIMILAR = 5, 0.8
ROWS, BANDS = 8, 40
PARTS = ROWS * BANDS
#: Buckets up to this size give all their pairs.
SMALL = 4
#: Nodes of a block, and the share of equal sketch bytes from which a pair is checked: four standard errors
#: below what a similarity of 0.8 gives in the sketch of its kind, set or probability Jaccard.
BLOCK, NEAR = 32, 0.71
#: Bits (as a power of two) of the bitmap of candidates.
FILTER_BITS = 25
#: Points of the process drawn at once.
POINTS = 1 << 18
CACHE_ENTRIES = 100_000
#: Bytes of the texts that a worker has in work at once.
PORTION = 1 << 20
STEP, MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
FACTOR = 0x100000001B3

_worker: dict = {}


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over the whole number."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, hash and weight of each document's distinct shingles. Fewer than five words make one shingle."""
    words = [plain_words(t) for t in texts]
    hashes = _worker.setdefault("words", WordHashes())
    size = np.array([len(w) for w in words], np.int64)
    h = np.fromiter((hashes[w] for ws in words for w in ws), np.uint64, int(size.sum()))
    owner = np.repeat(np.arange(len(texts)), size)
    inner = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
    total, padded = np.zeros(len(h), np.uint64), np.concatenate([h, np.zeros(SHINGLE, np.uint64)])
    for k in range(SHINGLE):
        inside = inner + k < size[owner]
        total += np.where(inside, padded[k:k + len(h)], np.uint64(0)) * np.uint64(pow(FACTOR, k, 1 << 64))
    first = (inner == 0) | (inner + SHINGLE <= size[owner])
    doc, code = owner[first], mixed(total[first] + STEP)
    order = np.argsort(code + doc.astype(np.uint64) * STEP)
    doc, code = doc[order], code[order]
    fresh = np.ones(len(code), bool)
    fresh[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
    count = np.diff(np.append(np.flatnonzero(fresh), len(code)))
    return doc[fresh], code[fresh], 1 + np.log(count) / 4


def signatures(docs: int, doc: np.ndarray, code: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The shingle of the first point in each part; 0 in documents without shingles."""
    total = np.bincount(doc, weight, minlength=docs)
    share = weight / total[doc]
    first, owner = np.full(docs * PARTS, np.inf), np.zeros(docs * PARTS, np.uint64)
    latest = np.full(docs, np.inf)
    time, drawn = np.zeros(len(doc)), np.uint64(0)
    live = np.arange(len(doc))
    while len(live):
        block = max(1, min(PARTS, POINTS // len(live) // 4 if drawn else 1))
        steps = (drawn + np.arange(1, block + 1, dtype=np.uint64)) * STEP
        bits = mixed(code[live][:, None] + steps[None, :])
        drawn += np.uint64(block)
        gaps = -np.log(((bits >> np.uint64(11)) + np.uint64(1)).astype(np.float64) / 2.0 ** 53)
        at = time[live][:, None] + np.cumsum(gaps, axis=1) / share[live][:, None]
        slot = doc[live][:, None] * PARTS + (mixed(bits + STEP) % np.uint64(PARTS)).astype(np.int64)
        early = at < latest[doc[live]][:, None]
        slots, times = slot[early], at[early]
        np.minimum.at(first, slots, times)
        won = times == first[slots]
        owner[slots[won]] = np.broadcast_to(code[live][:, None], at.shape)[early][won]
        time[live] = at[:, -1]
        touched = np.unique(doc[live])
        latest[touched] = first.reshape(docs, PARTS)[touched].max(axis=1)
        live = live[time[live] < latest[doc[live]]]
    return owner.reshape(docs, PARTS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    bands = signature.reshape(len(signature), BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * STEP + np.zeros((len(signature), 1), np.uint64)
    for k in range(ROWS):
        key = mixed(key * np.uint64(FACTOR) + bands[:, :, k])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of set Jaccard and probability Jaccard; arguments: sorted hashes and their weights."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    plain = len(common) / (len(a[0]) + len(b[0]) - len(common))
    if plain >= SIMILAR or (a[1].max() == a[1].min() and b[1].max() == b[1].min()):
        return plain
    # 1 / sum over all of max(a / a_i, b / b_i), summed over the common ones: sums of a above a ratio, of b below it.
    wa, wb = a[1] / a[1].sum(), b[1] / b[1].sum()
    ca, cb = wa[i], wb[j]
    only_a = wa.sum() - ca.sum()
    only_b = wb.sum() - cb.sum()
    ratio = ca / cb
    order = np.argsort(ratio)
    ca, cb, ratio = ca[order], cb[order], ratio[order]
    at = np.searchsorted(ratio, ratio, side="left")
    above = only_a + ca.sum() - np.concatenate([[0], np.cumsum(ca)])[at]
    below = only_b + np.concatenate([[0], np.cumsum(cb)])[at]
    return float(max(plain, (1 / (above / ca + below / cb)).sum()))


def nodes(df: DataFrame, text: str) -> DataFrame:
    """The input with ``__node``: the digest of the text; a null text is as an empty one."""
    return df.withColumn("__node", F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"))))


def sign(part: list[bytes]) -> tuple[list[np.ndarray], list[bytes], list[bool]]:
    """Band keys and sketch of each text, and whether it has shingles. Where one is repeated, both of two signatures.

    The sketch of the weighted signature comes first, that of the plain one last; without repetitions they are one.
    """
    doc, code, weight = shingles(part)
    signature = signatures(len(part), doc, code, weight)
    keys, sketch = list(band_keys(signature)), [x.tobytes() for x in (signature & np.uint64(0xFF)).astype(np.uint8)]
    repeated = np.unique(doc[weight > 1])
    if len(repeated):
        of = np.isin(doc, repeated)
        plain = signatures(len(repeated), np.searchsorted(repeated, doc[of]), code[of], np.ones(int(of.sum())))
        for i, k, s in zip(repeated, band_keys(plain), (plain & np.uint64(0xFF)).astype(np.uint8), strict=True):
            keys[i], sketch[i] = np.unique(np.concatenate([keys[i], k])), sketch[i] + s.tobytes()
    return keys, sketch, (np.bincount(doc, minlength=len(part)) > 0).tolist()


def close(some: list[bytes], others: list[bytes]) -> np.ndarray:
    """For each sketch of ``some`` and of ``others`` whether one of the two similarities may be large enough."""
    out = np.zeros((len(some), len(others)), bool)
    two = any(len(s) > PARTS for s in (*some, *others))
    for part in (slice(0, PARTS), slice(-PARTS, None)) if two else (slice(0, PARTS),):
        a, b = (np.frombuffer(b"".join(s[part] for s in side), np.uint8).reshape(-1, PARTS) for side in (some, others))
        out |= np.stack([(sketch == b).mean(axis=1) for sketch in a]) >= NEAR
    return out


def signed(texts: DataFrame) -> DataFrame:
    """(node, keys, sketch) of each distinct text with a shingle, stored; texts: __node, __text. See sign()."""

    def work(rows):
        for batch in rows:
            seen: dict[bytes, int] = {}
            ids = batch.field("__node").to_pylist()
            where = [seen.setdefault(i, len(seen)) for i in ids]
            texts, chosen = binaries(batch, "__text"), {}
            for t, w in zip(texts, where, strict=True):
                chosen.setdefault(w, t)
            parts = [sign(part) for part in portions(list(chosen.values()), PORTION)]
            keys, sketch, some = (sum(column, []) for column in zip(*parts, strict=True))
            first = dict.fromkeys(where)
            shown = [w if some[w] and first.pop(w, 0) is None else None for w in where]
            yield [pa.array([None if w is None else keys[w] for w in shown], pa.list_(pa.int64())), pa.array([None if w is None else sketch[w] for w in shown], pa.binary())]

    found = carry(texts, "keys array<long>, sketch binary", work, ["__node"]).where("keys IS NOT NULL")
    return stored(found.select(F.col("__row.__node").alias("node"), "keys", "sketch").dropDuplicates(["node"]), "signatures")


def marks(nodes_: DataFrame) -> bytes:
    """A bitmap of FILTER_BITS bits with one bit set for each node; as large for any number of nodes."""
    bit = F.pmod(F.xxhash64("node"), F.lit(1 << FILTER_BITS))
    words = nodes_.groupBy(F.shiftright(bit, 5).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(xxhash64(node), 32) as int))")).alias("b")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[words["w"].to_numpy()] = words["b"].to_numpy().astype(np.uint32)
    return out.tobytes()


def sets(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, hashes, weights) of the wanted texts, as packed numbers; no weights where all are 1.

    Texts are not joined with the wanted nodes: a bitmap lets the wanted and few others through, and the joins
    that follow drop those. A bitmap that fills up lets more through, and nothing is lost.
    """
    shared = texts.sparkSession.sparkContext.broadcast(marks(wanted))
    texts = texts.withColumn("__bit", F.pmod(F.xxhash64("__node"), F.lit(1 << FILTER_BITS)).cast("int"))

    def work(rows):
        bitmap = np.frombuffer(shared.value, np.uint32)
        for batch in rows:
            seen: set = set()
            hashes, weights = [], []
            bit = batch.field("__bit").to_numpy()
            passed = (bitmap[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1
            fresh = [bool(p) and i not in seen and not seen.add(i) for i, p in zip(batch.field("__node").to_pylist(), passed, strict=True)]
            for part in portions([t if f else b"" for t, f in zip(binaries(batch, "__text"), fresh, strict=True)], PORTION):
                doc, code, weight = shingles(part)
                order = np.argsort(doc, kind="stable")
                doc, code, weight = doc[order], code[order], weight[order]
                ends = np.searchsorted(doc, np.arange(len(part) + 1))
                for k in range(len(part)):
                    c, w = code[ends[k]:ends[k + 1]], weight[ends[k]:ends[k + 1]]
                    c, at = np.unique((c >> np.uint64(32)).astype(np.uint32), return_index=True)
                    hashes.append(c.tobytes())
                    weights.append(b"" if (w == 1).all() else w[at].astype(np.float32).tobytes())
            hashes = [h if f else None for h, f in zip(hashes, fresh, strict=True)]
            yield [pa.array(hashes, pa.binary()), pa.array(weights, pa.binary())]

    found = carry(texts, "hashes binary, weights binary", work, ["__node"]).where("hashes IS NOT NULL")
    return found.select(F.col("__row.__node").alias("node"), "hashes", "weights").dropDuplicates(["node"])


def linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar, stored. Only texts of candidates have their shingles gathered."""
    pairs = stored(pairs.distinct(), "candidates")
    packed = stored(sets(texts, pairs.select(F.col("a").alias("node")).union(pairs.select("b"))), "shingle-sets")

    def side(name: str) -> DataFrame:
        return packed.select(F.col("node").alias(name), F.col("hashes").alias(f"h{name}"), F.col("weights").alias(f"w{name}"))

    def work(rows):
        for batch in rows:
            columns = [batch.field(n).to_pylist() for n in ("ha", "wa", "hb", "wb")]
            out = []
            for ha, wa, hb, wb in zip(*columns, strict=True):
                a, b = np.frombuffer(ha, np.uint32), np.frombuffer(hb, np.uint32)
                weights = [np.frombuffer(w, np.float32).astype(np.float64) if w else np.ones(len(h)) for w, h in ((wa, a), (wb, b))]
                out.append(similarity((a, weights[0]), (b, weights[1])) >= SIMILAR - 1e-9)
            yield [pa.array(out, pa.bool_())]

    found = carry(pairs.join(side("a"), "a").join(side("b"), "b"), "near boolean", work, ["a", "b"]).where("near")
    return stored(found.select("__row.a", "__row.b"), "links")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of all linked nodes: large-star and small-star steps on stored links until nothing changes."""

    def stars(edges: DataFrame, both: bool) -> DataFrame:
        # both: every neighbour counts and the larger ones move; else the smaller ones count, and node and they move.
        pairs = edges.union(edges.select("b", "a")).toDF("u", "v") if both else edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        moved = pairs.join(least, "u")
        out = moved.where("v > u").select("v", "m") if both else moved.select("v", "m").union(least.select("u", "m"))
        out = out.toDF("x", "m").where("x != m")
        return out.select(F.least("x", "m").alias("a"), F.greatest("x", "m").alias("b")).distinct()

    def stamp(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now, last = links.distinct(), None
    while True:
        now = stored(stars(stored(stars(now, True), "stars"), False), "stars")
        if (said := stamp(now)) == last:
            break
        last = said
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select("a", "a").distinct())


def candidates(signs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between different texts that the bands find, enough to join what belongs together."""
    spread = signs.select("node", F.explode("keys").alias("key"))
    # Most keys are alone: they are counted by number only, and leaders are sought among what is left.
    shared = stored(spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    members = stored(spread.join(shared, "key"), "bucket-rows")
    leaders = members.groupBy("key").agg(F.min("node").alias("leader"))
    members = stored(members.join(leaders, "key"), "bucket-members")
    few = members.where(f"n <= {SMALL}").select("key", "node")
    pairs = few.select("key", F.col("node").alias("a")).join(few.select("key", F.col("node").alias("b")), "key").where("a < b").select("a", "b")
    to_leader = members.where(f"n > {SMALL} AND node != leader").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    links = linked(pairs.union(to_leader), texts)
    many = members.where(f"n > {SMALL}").select("key", "node", "leader")
    if many.isEmpty():
        return links
    roots = stored(components(links), "roots")

    def rooted(df: DataFrame, node: str, name: str) -> DataFrame:
        return df.join(roots.select(F.col("node").alias(node), F.col("root").alias("__root")), node, "left").withColumn(name, F.coalesce("__root", node)).drop("__root")

    many = stored(rooted(rooted(many, "node", "root"), "leader", "leader_root"), "large-buckets")
    apart = many.where("root != leader_root").select("key", "node", "root")
    held = stored(many.join(apart.select("key").distinct(), "key", "left_semi"), "held-buckets")
    packed = stored(sets(texts, held.select("node")).join(signs.select("node", "sketch"), "node"), "held-sets")
    held = held.select("key", "node", "root", (F.col("root") != F.col("leader_root")).alias("apart")).join(packed, "node")
    waiting, there = blocked(held.where("apart"), "waiting"), blocked(held, "there")

    def shares(x: dict) -> tuple[np.ndarray, np.ndarray]:
        h = np.frombuffer(x["hashes"], np.uint32)
        return h, np.frombuffer(x["weights"], np.float32).astype(np.float64) if x["weights"] else np.ones(len(h))

    def work(rows):
        for batch in rows:
            out = []
            for w, t in zip(batch.field("waiting").to_pylist(), batch.field("there").to_pylist(), strict=True):
                near = close([x["sketch"] for x in w], [x["sketch"] for x in t])
                joined: dict[tuple, dict] = {}
                for i, j in zip(*np.nonzero(near), strict=True):
                    x, y = w[i], t[j]
                    roots_ = (min(x["root"], y["root"]), max(x["root"], y["root"]))
                    # One link joins two components; further ones between the same two change nothing.
                    if x["root"] != y["root"] and roots_ not in joined and similarity(shares(x), shares(y)) >= SIMILAR - 1e-9:
                        joined[roots_] = {"a": min(x["node"], y["node"]), "b": max(x["node"], y["node"])}
                out.append(list(joined.values()))
            yield [pa.array(out, pa.list_(pa.struct([("a", pa.binary()), ("b", pa.binary())])))]

    more = carry(waiting.join(there, "key").select("key", "waiting", "there"), "pairs array<struct<a:binary,b:binary>>", work, ["key"])
    return links.union(stored(more.select(F.explode("pairs").alias("p")).select("p.a", "p.b").distinct(), "late-links"))


def blocked(rows: DataFrame, name: str) -> DataFrame:
    """(key, ``name``): the nodes of each bucket with roots and sketches, in blocks of about BLOCK nodes."""
    size = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = rows.join(size, "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    return dealt.groupBy("key", "block").agg(F.collect_list(F.struct("node", "root", "sketch", "hashes", "weights")).alias(name)).drop("block")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id (smallest doc_id of its group), class_size, one row for each input row.

    Equal texts are always one group; null texts count as empty, and texts without words equal only their copies.
    Repeated rows stay and count. Null keys come after all others as class_id. No rows give none.
    """
    rows = nodes(df.select(F.col(key).alias("doc_id"), F.col(text).alias("__text")), "__text")
    table = members_by_node(rows)
    slim = stored(rows.select("doc_id", "__node"), "doc-nodes")
    return slim.join(table.withColumnRenamed("node", "__node"), "__node").select("doc_id", "class_id", "class_size")


def members_by_node(rows: DataFrame) -> DataFrame:
    """(node, root, class_id, class_size, first_id) of each distinct text, stored; rows: doc_id, __node, __text."""
    texts = rows.select("__node", F.coalesce(F.col("__text").cast("string"), F.lit("")).alias("__text"))
    copies = stored(rows.groupBy(F.col("__node").alias("node")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies")), "copies")
    roots = stored(components(candidates(signed(texts), texts)), "roots")
    placed = copies.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    whole = placed.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    return stored(placed.join(whole, "root").select("node", "root", "class_id", "class_size", "first_id"), "classes")


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group: that with the smallest key, all its columns as they were."""
    rows = nodes(df.select(F.struct("*").alias("__row"), F.col(key).alias("doc_id"), F.col(text).alias("__text")), "__text")
    table = members_by_node(rows.select("doc_id", "__node", "__text"))
    # One text of a group holds its smallest key; of two texts with the same key, the smaller digest.
    chosen = table.where("first_id <=> class_id").groupBy("root").agg(F.min("node").alias("__node"), F.min("class_id").alias("__id")).drop("root")
    kept = rows.join(chosen, (rows["__node"] == chosen["__node"]) & rows["doc_id"].eqNullSafe(chosen["__id"])).select(rows["__node"], "doc_id", "__row")
    slim = rows.select("doc_id", "__node").groupBy("doc_id", "__node").count().where("count > 1")
    if not slim.isEmpty():
        kept = kept.dropDuplicates(["__node", "doc_id"])
    return kept.select("__row.*")
