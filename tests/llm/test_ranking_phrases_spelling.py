"""Quality ranking, phrase collocations and spelling variants: odd tables, brute force, held-out accuracy.

The given tables are compared with SQL in tests/test_queries.py.
"""

import collections
import itertools
import random
import zlib

import numpy as np
import pytest

from fleetpulse.llm import phrases, ranking, spelling
from fleetpulse.llm.common import stored
from fleetpulse.llm.queries import QUERIES

LONG = "lorem ipsum dolor " * 3000
ODD = [(1, None), (2, ""), (2, ""), (3, "a"), (None, "same text here with some words"), (4, "same text here with some words"), (5, LONG), (6, LONG), (7, "\x00 \x1c <|endoftext|> MIT ñ漢🙂"), (3, "a")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, and columns whose names the operators use themselves."""
    rows = [(i, t, "xx" if k % 2 else None, 1.0, 1, "x", 2, b"n") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, n int, word string, shard int, x binary")


def test_classifier_holds_out(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op11_quality_classifier"](spark, sf_dir).collect()
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    tested = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(tested) > 5 and np.mean([a == b for a, b in tested]) > 0.9


def test_classifier_learns_nothing_from_held_out_labels(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0, 1 - quality, quality) AS quality")
    one, two = (ranking.fit(docs, x) for x in (labels, turned))
    assert np.array_equal(one.weights, two.weights) and one.threshold == two.threshold


def test_classifier_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 0), (2, 0), (2, 1), (3, None), (None, 1), (4, 1), (4, 1), (5, 1), (7, 0), (99, 1)], "doc_id long, quality int")
    for known in (labels, labels.where("quality = 1"), labels.where("false")):
        model = ranking.fit(odd, known)
        rows = ranking.score(odd, model).select("__row.*", "held_out", "predicted", "score").drop("score").collect()
        assert len(rows) == len(ODD)
        assert ranking.score(odd.where("false"), model).count() == 0
    assert ranking.fit(odd.where("false"), labels).threshold == 0.0
    rows = ranking.score(odd, ranking.fit(odd, labels)).select("__row.doc_id", ranking.F.col("score").alias("s"), "held_out").collect()
    scores = collections.defaultdict(set)
    for r in rows:
        scores[r["doc_id"]].add(r["s"])
    assert all(len(s) == 1 for s in scores.values()) and scores[5] == scores[6] and scores[None] == scores[4]
    assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}


def test_classifier_learns_from_all_labels(spark, monkeypatch):
    """A third kind of text whose few documents a bound of 10,000 ids left out; a rare class is in every cell."""
    kinds = spark.range(0, 16_000, 1, 4).selectExpr("id AS doc_id", "CASE WHEN id < 15970 THEN 'plain text here' ELSE 'bad ## text' END AS text", "CAST(id < 15970 AS INT) AS quality")
    monkeypatch.setattr(ranking, "CELL", 1000)
    used = []
    monkeypatch.setattr(ranking, "stored", lambda df, label, **o: used.append((label, s := stored(df, label, **o))) or s)
    model = ranking.fit(kinds, kinds.select("doc_id", "quality"))
    learned = [i for i in range(16_000) if zlib.crc32(str(i).encode()) % 5]
    held = dict(used)
    assert held["ranking-sample"].count() == len(learned) > 10_000
    sizes = held["ranking-cells"].selectExpr("size(goods) AS g", "size(bads) AS b").collect()
    rare = sum(i >= 15_970 for i in learned)
    assert len(sizes) == 13 and sum(r["g"] for r in sizes) == len(learned) - rare and {r["b"] for r in sizes} == {rare}
    scores = ranking.score(kinds, model).groupBy("__row.quality").agg(ranking.F.min("score"), ranking.F.max("score")).collect()
    assert {r[0]: (r[1] == r[2]) for r in scores} == {0: True, 1: True} and len({r[1] for r in scores}) == 2


def test_weights_are_those_of_the_least_loss(spark):
    draw = np.random.default_rng(2)
    goods, bads = np.zeros((300, ranking.WIDTH)), np.zeros((100, ranking.WIDTH))
    goods[:, :3], bads[:, :3] = draw.normal(size=(300, 3)) + [1, 0, 0.2], draw.normal(size=(100, 3))
    held = spark.createDataFrame([(ranking.packed(goods), ranking.packed(bads))], "goods array<binary>, bads array<binary>")
    d = np.concatenate([*ranking.preferences(goods.astype(np.float32), bads.astype(np.float32))])
    assert len(d) == 600
    w = ranking.learn(held)
    slope = -(d / (1 + np.exp(d @ w))[:, None]).mean(axis=0) + ranking.RIDGE * (d ** 2).mean(axis=0) * w
    assert np.abs(slope).max() < 1e-6 and w[0] > 0.5


def collocations_by_hand(rows, support, top):
    split = [("und" if lang is None else lang, [p.split() for p in "".join(c.lower() if c.isascii() else c for c in t or "").translate({ord(c): "." for c in ",;:!?\n\x0b\x0c\r"}).split(".")]) for lang, t in rows]
    f = collections.Counter((lang, tuple(p[i:i + k])) for lang, ps in split for p in ps for k in (1, 2, 3) for i in range(len(p) - k + 1))
    out = []
    for (lang, w), a in f.items():
        if len(w) < 2 or a < support:
            continue
        score, k = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        if any(100 * b >= 50 * a for (other, v), b in f.items() if other == lang and len(w) == 2 and len(v) == 3 and b >= support and w in (v[:2], v[1:])):
            continue
        n = sum(b for (other, v), b in f.items() if other == lang and len(v) == 1)
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n))
    ranked = []
    for lang, group in itertools.groupby(sorted(out), key=lambda r: r[0]):
        ranked += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (_, s, a, p, left, right, n) in enumerate(group) if i < top]
    return ranked


@pytest.mark.parametrize("shards,tokens", [(1, 1 << 23), (4, 1 << 23), (5, 50)])
def test_phrases_are_the_same_however_rows_are_dealt(spark, monkeypatch, shards, tokens):
    draw = random.Random(3)
    words = ["a", "B", "cc", "dé", "漢", "e-f", "g"]
    rows = [(draw.choice(["en", "de", None]), "".join(draw.choice(words) + draw.choice([" ", " ", "\t", ". ", " ", ";"]) for _ in range(draw.randint(0, 60)))) for _ in range(60)]
    rows += [("en", None), ("", "a a a a a a a a a a a a"), ("en", "a b\n" * 400), ("en", "a b\n" * 400)]
    monkeypatch.setattr(phrases, "TOKENS", tokens)
    monkeypatch.setattr(phrases, "SLICE", 64)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(df, support=10, top=12, shards=shards).collect())
    assert got == sorted(collocations_by_hand(rows, 10, 12))


def test_phrases_shuffle_no_more_than_they_need(spark, monkeypatch):
    shuffled = []
    summed = phrases.summed
    monkeypatch.setattr(phrases, "summed", lambda counts, by, n: shuffled.append((counts.dtypes, by, counts.count())) or summed(counts, by, n))
    df = spark.createDataFrame([("en", f"a b c. {'x ' * i}") for i in range(40)], "lang string, text string").coalesce(1)
    found, _ = phrases.frequent(df, 10)
    assert {(r["phrase"], r["f"]) for r in found.collect()} == {("a", 40), ("b", 40), ("c", 40), ("a b", 40), ("b c", 40), ("a b c", 40), ("x", 780), ("x x", 741), ("x x x", 703)}
    # Mining moves a key and a weight; one task names a phrase once when it counts, not once for each shard.
    assert [(dtypes, by) for dtypes, by, _ in shuffled[:-1]] == [([("key", "bigint"), ("weight", "bigint")], ["key"])] * 2
    assert shuffled[-1][1:] == (["lang", "size", "phrase"], 9)


def test_phrases_of_odd_rows(odd):
    rows = phrases.collocations(odd).collect()
    assert {(r["lang"], r["phrase"]) for r in rows} == {(lang, p) for lang in ("und", "xx") for p in ("lorem ipsum dolor", "ipsum dolor lorem", "dolor lorem ipsum")} and all(r["n"] >= 9000 for r in rows)
    assert phrases.collocations(odd.where("false")).count() == 0


def variants_by_hand(counts):
    def shorter(w):
        return {(i, w[:i] + w[i + 1:]) for i in range(len(w))}

    cut = {w: shorter(w) for w in counts}
    near = {w: sorted((-counts[v], v) for v in counts if v != w and (cut[w] & cut[v] or w in {s for _, s in cut[v]} or v in {s for _, s in cut[w]})) for w in counts}
    form = {w: v[0][1] if v and -v[0][0] >= 10 * counts[w] else None for w, v in near.items()}

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), counts[w], len(near[w]), counts.get(form[w])) for w in counts}


def test_variants_by_brute_force(spark):
    draw = random.Random(4)
    base = ["abcdefg", "aaaaaaa", "éabcdefgh", "zzzzÿzzzz", "abcdefgabcdefg"]
    counts = {w: 1000 for w in base}
    for _ in range(3):
        for w in list(counts):
            for _ in range(6):
                i, c = draw.randrange(len(w)), draw.choice("abcdéz")
                v = draw.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])
                if len(v) >= 7:
                    counts.setdefault(v, max(2, counts[w] // draw.choice([1, 9, 10, 30])))
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    near = collections.Counter()
    for r in spelling.near_pairs(words).collect():
        near[r["word"]] += 1
    want = variants_by_hand(counts)
    assert {w: n for w, _, _, _, n, _ in want if n} == dict(near)


def test_a_near_pair_under_several_keys_counts_once(spark):
    # The key of one word among those of its length is one of the other among longer ones, and the other way round.
    for pair in (("éèmentelle", "éêmentelle"), ("éèréelle", "éêréelle"), ("éêmenttion", "éèmenttion")):
        kinds = [{(int(k), bool(more)) for keys, longer in spelling.signatures([w]) for k, more in zip(keys, longer)} for w in pair]
        assert {k for k, more in kinds[0] if more} & {k for k, more in kinds[1] if not more}
        found = spelling.near_pairs(spark.createDataFrame([(w, 5) for w in pair], "word string, n long")).collect()
        assert sorted((r["word"], r["other"]) for r in found) == sorted([pair, pair[::-1]])


def test_variants_of_texts(spark, odd):
    rows = [(i, "Housing housing HOUSING housin hous1ing housings " * 20) for i in range(4)] + [(None, "housings"), (9, None)]
    got = spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))
    counts = collections.Counter()
    for i, t in rows:
        for run in spelling.re.findall("[a-zÀ-ÿ]+", (t or "").lower()):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            run = run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run
            counts[run] += len(run) >= 7
    assert {tuple(r) for r in got.collect()} == variants_by_hand({w: n for w, n in counts.items() if n >= 2})
    assert spelling.variants(odd).count() == 0 and spelling.variants(odd.where("false")).count() == 0


def test_chains_of_forms_end_at_their_root(spark):
    chain = [f"w{i}" for i in range(12)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:])) + [("x", "w5")], "word string, form string")
    assert {tuple(r) for r in spelling.roots(forms).collect()} == {(w, "w11") for w in [*chain[:-1], "x"]}
