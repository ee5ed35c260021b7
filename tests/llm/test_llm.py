"""The training-data operators against brute force, on given tables and on odd rows."""

import collections
import hashlib
import math
import random
import time
import tracemalloc
import types
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from fleetpulse.llm import bpe, chat, common, decontaminate, langid, licenses, neardup, ppm, quality, sharding, token_counts
from fleetpulse.llm.common import plain_words, portions, sliced
from fleetpulse.llm.queries import QUERIES

LONG = "lorem ipsum dolor " * 3000
ODD = [(1, None), (2, ""), (2, ""), (3, "a"), (None, "same text here with some words"), (4, "same text here with some words"), (5, LONG), (6, LONG), (7, "\x00 \x1c <|endoftext|> <|startoftext|> MIT License ñ漢🙂"), (3, "a")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, long and repeated texts, and columns whose names the operators use themselves."""
    rows = [(i, t, "EN-us" if k % 2 else None, None, 1, "x", 2, b"n") for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int, kept string, shard int, node binary")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def test_shards_are_smallest_and_gapless(spark, odd, none):
    rows = sharding.shard(odd, 3).collect()
    assert sharding.shard(none, 3).count() == 0 and len(rows) == len(ODD)
    by = collections.defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert {r["size"] for r in rows if r["doc_id"] == 1} == {1} and {r["text_crc32"] for r in rows if r["doc_id"] == 1} == {0}
    assert len({r["shard"] for r in rows if r["size"] == len(LONG) + 1}) == 1


def test_capacity_is_minimal(spark, sf_dir, docs):
    rows = QUERIES["op1_sharding"](spark, sf_dir).collect()
    groups = collections.Counter()
    for t in docs.values():
        groups[hashlib.md5(t.encode()).hexdigest()] += len(t.encode()) + 1
    sizes = [groups[g] for g in sorted(groups)]

    def shards(capacity):
        n, left = 0, 0
        for s in sizes:
            if s > left:
                n, left = n + 1, capacity
            left -= s
        return n

    load = collections.Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
        assert r["text_crc32"] == zlib.crc32(docs[r["doc_id"]].encode())
    assert shards(max(load.values())) <= 8 and (max(load.values()) == max(sizes) or shards(max(load.values()) - 1) > 8)


def test_languages(spark, sf_dir, odd, none):
    found = langid.identify(odd, F.col("lang"), F.col("source"), F.col("doc_id"))
    assert {r[0] for r in found.where("__row.doc_id in (1, 2)").select("kept").collect()} == {False}
    assert found.count() == len(ODD) and langid.identify(none, F.col("lang"), F.col("source"), F.col("doc_id")).count() == 0
    rows = QUERIES["op2_language_id"](spark, sf_dir).collect()
    assert np.mean([r["lang"] == r["declared"] for r in rows]) > 0.97
    assert QUERIES["language_id_pages"](spark, sf_dir).where("lang = declared").count() > 0


def test_rare_languages_are_found_on_large_tables(spark, monkeypatch):
    """Ten of 400 rows, and two of a language without a model, against samples of 20 rows."""
    rng = random.Random(5)
    words = {"en": "the house stands near river where old people talk about weather every morning", "fi": "talo seisoo joen vieressa jossa vanhat ihmiset puhuvat saasta joka aamu yhdessa", "th": "บ้าน ตั้ง อยู่ ใกล้ แม่น้ำ คน แก่ พูด คุย ทุก เช้า"}
    rows = [(i, " ".join(rng.choices(words[lang].split(), k=30)), lang) for i, lang in enumerate(["en"] * 388 + ["fi"] * 10 + ["th"] * 2)]
    rows += [(400, "the old house stands near the river where people talk every morning", "xx")]
    monkeypatch.setattr(langid, "LABELLED", 20)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    found = langid.identify(df, F.col("lang"), F.lit(None), F.col("doc_id")).select("__row.doc_id", "lang", "kept").collect()
    assert {r["doc_id"]: (r["lang"], r["kept"]) for r in found} == {i: ("en" if lang == "xx" else lang, True) for i, _, lang in rows}


def test_token_counts_are_the_librarys(spark, sf_dir, docs, odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    for r in QUERIES["op3_token_counts"](spark, sf_dir).collect():
        assert r["n_tokens"] == len(library.encode(docs[r["doc_id"]], add_special_tokens=False).ids)
    for r in token_counts.count_tokens(odd, path).select("__row.text", "n_tokens").collect():
        assert r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids)
    assert token_counts.count_tokens(none, path).count() == 0


def mixtures(parts: list[str], seed: int) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice(parts) for _ in range(draw.randint(1, 14))) for _ in range(4000)]


def test_frequent_pieces_come_from_one_job(spark):
    path, tracker = public_tokenizers.path("word_bpe_49k.json"), spark.sparkContext.statusTracker()
    many = spark.range(300, numPartitions=300).select(F.format_string("word%d and and some", F.col("id") % 7).alias("text"))
    spark.sparkContext.setJobGroup("sample", "sample")
    words, lengths = token_counts.frequent_lengths(many, "text", path)
    assert len(tracker.getJobIdsForGroup("sample")) == 1
    stages = tracker.getJobInfo(tracker.getJobIdsForGroup("sample")[0]).stageIds
    assert sum(tracker.getStageInfo(s).numTasks for s in stages) <= token_counts.SAMPLE_PARTITIONS
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert words.split()[0] == b"and" and len(lengths) == 2 * len(words.split())
    assert token_counts.frequent_lengths(many.where("false"), "text", path) == (b"", b"")


def test_token_pieces_are_apart():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    parts = ["'", "s", "S", "L", "e", "é", "\u0301", "<", "|", "<|endoftext|>", " ", "\n", "1", "\u0663", "#", ",", "K", "İ", "Σ", "\x1f", "\u2028"]
    for text in ["H\u0331", "'stuff I'LL don'T x,'s ''s", "<|ENDOFTEXT|> a<|startoftext|>b", *mixtures(parts, 1)]:
        pieces = token_counts.pre_tokens(text.encode())
        assert sum(token_counts.lengths(path, pieces)) == len(library.encode(text, add_special_tokens=False).ids), text


def test_bpe_units_are_apart():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, codec = Tokenizer.from_file(path), bpe.codec(path)
    parts = ["'", "s", "l", "e", "é", "\u0301", "日", " ", "\n", "1", "\u0663", "#", "\u3000", "\x85", "\xa0", "²", "\U0001f600", " 's"]
    for text in ["日  日\u3000x \u3000 y", " 's 'sé日", *mixtures(parts, 2)]:
        ids = [i for unit in codec.units(codec.split(text)) for i in unit]
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_bpe_worker_holds_little(monkeypatch):
    rng, path, held = random.Random(5), public_tokenizers.path("byte_bpe_50k.json"), {}
    monkeypatch.setattr(bpe, "carry", lambda df, new, work, by: held.update(work=work))
    monkeypatch.setattr(bpe, "_worker", {})
    bpe.encode_decode(types.SimpleNamespace(schema={"text": types.SimpleNamespace(dataType=T.StringType())}), path, keep_ids=True)
    texts = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(2000)) for _ in range(20)]
    rows = [pa.StructArray.from_arrays([pa.array([t], pa.string())], names=["text"]) for t in texts]
    tracemalloc.start()
    try:
        work = held["work"](iter(rows))
        found = [next(work) for _ in rows]
        kept, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    library = Tokenizer.from_file(path)
    assert [a[3].to_pylist()[0] for a in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [a[4].to_pylist()[0] for a in found] == texts
    # 37 MB; 50 MB with units as texts and tuples, and checked pairs in a dict.
    assert kept < 42 << 20, (kept, peak)


def test_ppm_is_a_distribution_and_base_is_exact(spark, odd, none):
    train = [b"the cat sat on the mat", b"abracadabra abracadabra", b""] * 3
    code, _ = ppm.codes(train)
    for cap in (10**6, 40, 5):
        grams = []
        for k in range(ppm.ORDER + 1):
            g, n = np.unique(code & ppm.mask(k + 1), return_counts=True)
            order = np.argsort(-n, kind="stable")[:cap]
            grams.append((g[order], n[order]))
        trie = ppm.Trie(grams)
        for context in (b" the ", b"xabra", b"zzzzz", bytes([ppm.BEFORE] * 5)):
            all_next = np.array([int.from_bytes(context[-ppm.ORDER:] + bytes([s]), "big") for s in range(256) if s != ppm.BEFORE], np.uint64)
            assert abs((10 ** trie.score(all_next)).sum() - 1) < 1e-9
    rows = ppm.score(odd).collect()
    words = {i: [w for w in (t or "").encode().lower().split()] + [b"\n"] for i, t in ODD}
    trained = [words[i] for i, _ in ODD if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    count = collections.Counter(w for ws in trained for w in ws)
    total = sum(count.values())
    for r in rows:
        assert r["train_tokens"] == total and r["score"] < 0
        assert math.isclose(r["base_score"], sum(math.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in words[r["doc_id"]]), rel_tol=1e-9)
    assert len(rows) == len(ODD) and ppm.score(none).count() == 0


def test_ppm_scores_are_exact_beyond_the_broadcast_table(spark, docs, monkeypatch):
    texts = {i: t[:3000].encode().lower() for i, t in sorted(docs.items())[:60]}
    train = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    assert 0 < len(train) < len(texts)
    code, _ = ppm.codes(train)
    whole = ppm.Trie([np.unique(code & ppm.mask(k + 1), return_counts=True) for k in range(ppm.ORDER + 1)])
    monkeypatch.setattr(ppm, "TRIE", 50)
    rows = ppm.score(spark.createDataFrame([(i, t.decode()) for i, t in texts.items()], "doc_id long, text string")).collect()
    for r in rows:
        assert math.isclose(r["score"], whole.score(ppm.codes([texts[r["doc_id"]]])[0]).sum(), rel_tol=1e-9), r["doc_id"]
    assert len(rows) == len(texts)


def brute_windows(text, items):
    w, hit, found = plain_words(text.encode()), set(), set()
    for item, words in items:
        size = min(10, len(words))
        wins = {tuple(words[k:k + size]) for k in range(len(words) - size + 1)} if words else set()
        for k in range(len(w) - size + 1) if words else ():
            if tuple(w[k:k + size]) in wins:
                hit.update(range(k, k + size))
                found.add(item)
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_contamination(spark, sf_dir, docs, odd, none):
    items = [(str(r["item_id"]), plain_words(r["text"].encode())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = QUERIES["op5_decontamination"](spark, sf_dir).collect()
    assert any(r["contaminated"] for r in rows)
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == brute_windows(docs[r["doc_id"]], items)
    tests = spark.createDataFrame([(1, "A"), (2, None), (3, "lorem ipsum " * 8), (4, "dolor lorem"), (4, "some words"), (5, "!")], "item_id int, text string")
    scanned = decontaminate.scan(odd, tests)
    pairs = [(str(i), plain_words(t.encode())) for i, t in ((1, "A"), (3, "lorem ipsum " * 8), (4, "dolor lorem"), (4, "some words"))]
    for r in scanned.select("__row.text", "n_words", "runs", "items").collect():
        expected = brute_windows(r["text"] or "", pairs)
        assert (r["n_words"], sum(x["end"] - x["start"] for x in r["runs"]), len(r["items"])) == expected[:3]
    assert {r["clean"] for r in decontaminate.cut(scanned).where("row.doc_id = 4").collect()} == {"same text here with "}
    assert decontaminate.scan(none, tests).count() == 0 and decontaminate.scan(odd, tests.where("false")).where("contaminated").count() == 0


def test_contamination_block_by_block(spark, sf_dir, odd, monkeypatch):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    columns = ["__row.doc_id", "n_words", "runs", "items", "contaminated"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = [r.asDict(recursive=True) for r in decontaminate.scan(docs, benchmark).select(*columns).orderBy("doc_id").collect()]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 3 << 10)
    assert len(list(decontaminate.blocks(benchmark, "item_id", "text"))) > 2
    assert [r.asDict(recursive=True) for r in decontaminate.scan(docs, benchmark).select(*columns).orderBy("doc_id").collect()] == whole


def test_slices_keep_order_and_bound():
    texts = [None, "", "ab", "x" * 50, "cde", None, "f" * 10, "g" * 10, ""]
    rows = pa.array([{"i": i, "text": t} for i, t in enumerate(texts)]).slice(1)
    for size in (1, 10, 20, 1000):
        got = [s.to_pylist() for s in sliced(rows, "text", size)]
        assert [r for s in got for r in s] == rows.to_pylist()
        assert all(len(s) == 1 or sum(len(r["text"] or "") for r in s) <= size for s in got)


def test_slices_change_no_result(spark, sf_dir, odd, monkeypatch):
    """Verdicts, languages and ids are the same with slices of few texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    def all_results():
        yield quality.judge(docs, quality.fit(docs, labels)).select("__row.doc_id", "n_words", "n_repeat_words", F.round("score", 9), "kept").collect()
        yield langid.identify(docs, F.col("lang"), F.col("source"), F.col("doc_id")).select("__row.doc_id", "lang", "kept").collect()
        yield bpe.encode_decode(odd, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True).select("__row.doc_id", "__row.text", "ids", "decoded").collect()

    whole = [sorted(map(str, rows)) for rows in all_results()]
    monkeypatch.setattr(common, "SLICE_BYTES", 3000)
    monkeypatch.setattr(quality, "SLICE_BYTES", 3000)
    assert [sorted(map(str, rows)) for rows in all_results()] == whole


def test_phrases_in_long_texts():
    text = b" " + b"the mit license and apache license x " * 20_000
    began = time.monotonic()
    places = licenses.phrase_places(text)
    assert len(places) == 40_000 and time.monotonic() - began < 20
    assert sorted(places)[:3] == [(1, "mit"), (4, "apache"), (8, "mit")]


def test_fm_index_finds_all():
    rng = random.Random(3)
    for _ in range(60):
        seq = np.array([rng.choice([0, 1, 1, 2, 3]) for _ in range(rng.randint(1, 120))] + [0])
        index = decontaminate.FmIndex(seq, 3)
        windows = np.array([[rng.randint(1, 3) for _ in range(3)] for _ in range(12)] + [[0, 1, 2], [0, 0, 1]])
        low, high = index.search(windows)
        for w, lo, hi in zip(windows, low, high, strict=True):
            w = w[w > 0]
            expected = [k for k in range(len(seq) - len(w) + 1) if (seq[k:k + len(w)] == w).all()]
            assert sorted(index.locate(np.arange(lo, hi)).tolist()) == expected


def test_chat(spark, sf_dir):
    odd = spark.createDataFrame([(1, 0, "user", None), (1, None, None, r"\### x </turn>"), (None, 1, "assistant", "ok"), (2, 0, "assistant", ""), (2, 0, "assistant", ""), (2, 1, "a: b\\", "tail")], "conv_id long, turn int, role string, text string")
    pieces = chat.render(odd)
    shown = chat.examples(pieces)
    rows = {r["conv_id"]: r for r in chat.read_back(pieces, shown).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert rows[1]["turns_sha256"] == sha("\n\\### x </turn>\nuser\n\n") and rows[1]["loss_chars"] == 0
    assert rows[None]["loss_sha256"] == sha("ok") and rows[2]["n_turns"] == 3
    assert shown.where("conv_id = 2").count() == 3
    for r in chat.materialise(shown, pieces).collect():
        if r["conv_id"] is None:
            assert r["text"][r["loss_start"]:r["loss_start"] + r["loss_chars"]] == "ok"
    assert chat.render(odd.where("false")).count() == 0
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    whole, loss = collections.defaultdict(str), collections.defaultdict(str)
    for r in given:
        whole[r["conv_id"]] += f"{r['role']}\n{r['text']}\n"
        loss[r["conv_id"]] += r["text"] if r["role"] == "assistant" else ""
    marks = r"\### Assistant: </turn> ok"
    whole[-7], loss[-7] = f"user\n{marks}\nassistant\n{marks}\n", marks
    found = {r["conv_id"]: r for r in QUERIES["op6_chat_formatting"](spark, sf_dir).collect()}
    assert found.keys() == whole.keys()
    for c, r in found.items():
        assert (r["turns_sha256"], r["loss_sha256"], r["loss_chars"]) == (sha(whole[c]), sha(loss[c]), len(loss[c]))


def test_chat_writes_every_example(spark, monkeypatch):
    """Texts of all examples are written, short and long conversations', in parts and stretches of any size, and digests are read from them."""
    rng = random.Random(6)
    odd = ["", None, "\\\\", "###", "</turn>", "<</turn>\n### assistant: x", ": ", "ñ漢🙂" * 40, "a: b:", "word " * 300]
    rows = [(conv, turn, rng.choice(["user", "assistant", "assistant", None, "a:", ": \\"]), rng.choice(odd)) for conv, n in ((1, 1), (2, 7), (3, 120), (None, 30)) for turn in range(n)]
    rows += [(4, 0, "user", "only"), (4, 1, "user", "users"), (5, 0, "assistant", "x"), (5, 0, "assistant", "x"), (5, None, "user", "first")] + [(6, t, "user", "y" * 500) for t in range(40)] + [(6, 40, "assistant", "z")]

    def masked(t, marks):
        t = (t or "").replace("\\", "\\\\")
        for m in marks:
            t = t.replace(m, "\\" + m)
        return t

    told, expected = collections.defaultdict(list), {}
    for r in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1])):
        told[r[0]].append(r)
    for conv, turns in told.items():
        text = ""
        for k, (_, _, role, said) in enumerate(turns):
            body = masked(said, ["###", "</turn>"])
            text += f"### {masked(role, ['###', '</turn>', ': '])}: {body}</turn>\n"
            if role == "assistant":
                expected[conv, k] = (text, text[len(text) - 8 - len(body):-8])
            elif k == len(turns) - 1:
                expected[conv, k] = (text, None)
    docs = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    kept, digests, keep = {}, [], chat.stored

    def stored(df, label, **options):
        kept[label] = keep(df, label, **options)
        return kept[label]

    monkeypatch.setattr(chat, "stored", stored)
    for part, stretch in ((chat.PART, chat.STRETCH), (1, 20_000), (2000, 1)):
        monkeypatch.setattr(chat, "PART", part)
        monkeypatch.setattr(chat, "STRETCH", stretch)
        pieces = chat.render(docs)
        shown = chat.examples(pieces)
        assert shown.count() == len(expected)
        digests.append({r["conv_id"]: r for r in chat.read_back(pieces, shown).collect()})
        found = collections.defaultdict(list)
        for r in kept["chat-examples"].collect():
            found[r["conv_id"], r["last"]].append(r)
        assert found.keys() == expected.keys()
        for key, parts in found.items():
            parts.sort(key=lambda r: r["part"])
            text = "".join(r["text"] for r in parts)
            start, size = parts[0]["loss_start"], parts[0]["loss_chars"]
            assert [r["part"] for r in parts] == list(range(len(parts))) and (part > 1 or len(parts) == key[1] + 1)
            assert [r["at"] for r in parts] == [sum(len(p["text"]) for p in parts[:k]) for k in range(len(parts))]
            assert (text, None if start is None else text[start:start + size]) == expected[key]
        if part == chat.PART:
            assert {(r["conv_id"], r["last"]): r["text"] for r in chat.materialise(shown, pieces).collect()} == {k: t for k, (t, _) in expected.items()}
    assert all(d == digests[0] for d in digests) and len(digests[0]) == len(told)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in digests[0].values():
        turns = told[r["conv_id"]]
        losses = [t or "" for _, _, role, t in turns if role == "assistant"]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), sha("".join(f"{role or ''}\n{t or ''}\n" for _, _, role, t in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (sum(map(len, losses)), sha("".join(losses)))
        assert r["formatted_chars"] == sum(len(t) for (conv, _), (t, _) in expected.items() if conv == r["conv_id"])


def test_near_duplicates(spark, sf_dir, docs, odd, none):
    rows = {r["doc_id"]: r["class_id"] for r in QUERIES["op7_near_duplicates"](spark, sf_dir).collect()}
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} for i, t in docs.items() if (w := plain_words(t.encode()))}
    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                assert rows[a] == rows[b]
    assert neardup.classes(none).count() == 0
    found = collections.defaultdict(set)
    for r in neardup.classes(odd).collect():
        found[r["class_id"]].add(r["doc_id"])
    assert found == {1: {1, 2}, 3: {3}, 4: {None, 4}, 5: {5, 6}, 7: {7}}
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 7]


def test_large_near_groups_lose_no_link(spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(150)] = f"x{i}"
        texts.append(" ".join(words))
    texts += [" ".join(base[:75] + [f"y{i}{k}" for k in range(75)]) for i in range(20)]
    found = neardup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    sizes = collections.Counter(r["class_id"] for r in found)
    assert sizes[0] == 60 and len(sizes) == 21


def test_near_copies_with_repeated_lines(spark):
    """Set Jaccard 300 / 374; what one text says fifty times lowers the probability Jaccard to about 0.71."""
    texts = []
    for i in range(60):
        line, rest = " ".join(f"s{i}x{k}" for k in range(104)), " ".join(f"t{i}x{k}" for k in range(200))
        texts += [" ".join([line] * 50 + [rest, *(f"a{i}x{k}" for k in range(33))]), " ".join([line, rest, *(f"b{i}x{k}" for k in range(37))])]
    sets = [set(c.tolist()) for t in texts for _, c, _ in [neardup.shingles([t.encode()])]]
    assert all(len(a & b) / len(a | b) == 300 / 374 for a, b in zip(sets[::2], sets[1::2], strict=True))
    found = neardup.classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == {i: i - i % 2 for i in range(120)}
    # In large buckets sketches decide: each of the two similarities by its own.
    sketch = [neardup.sign([t.encode()])[1][0] for t in texts]
    assert all(neardup.close([a], [b])[0, 0] for a, b in zip(sketch[::2], sketch[1::2], strict=True))


def test_slices_of_texts_change_no_signature(monkeypatch):
    texts = [b"", b"one two", b" ".join(b"w%d" % (i % 700) for i in range(3000)), b"a b c d e f", b"a b c d e f"]
    assert [list(p) for p in portions(texts, 10)] == [texts[:2], texts[2:3], texts[3:4], texts[4:]]
    assert list(portions([], 10)) == [] and list(portions([b""], 10)) == [[b""]]
    whole = neardup.band_keys(neardup.signatures(len(texts), *neardup.shingles(texts)))
    parts = [neardup.band_keys(neardup.signatures(len(p), *neardup.shingles(p))) for p in portions(texts, 10)]
    assert (np.concatenate(parts) == whole).all()


def test_probability_jaccard():
    a, b = np.array([1, 2, 3], np.uint32), np.array([2, 3, 4], np.uint32)
    wa, wb = np.array([1.0, 2, 3]), np.array([2.0, 5, 1])
    pa_, pb = dict(zip(a, wa / wa.sum(), strict=True)), dict(zip(b, wb / wb.sum(), strict=True))
    every = set(a) | set(b)
    brute = sum(1 / sum(max(pa_.get(j, 0) / pa_[i], pb.get(j, 0) / pb[i]) for j in every) for i in (2, 3))
    assert neardup.similarity((a, wa), (b, wb)) == pytest.approx(max(brute, 0.5))


def test_quality_base(spark, sf_dir, docs, odd, none):
    for r in QUERIES["op8_quality_rules"](spark, sf_dir).collect():
        t = docs[r["doc_id"]].encode()
        w = t.split()
        windows = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
        repeat = len({k + d for k in range(len(w) - 2) if windows[tuple(w[k:k + 3])] > 1 for d in range(3)})
        lines = [x for x in t.split(b"\n") if x.split()]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), sum(len(x.decode()) for x in w), repeat, len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 50 or 100 * repeat > 50 * len(w)) and not (r["base_failed"] and r["kept"])
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0), (5, 1, None), (5, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(odd, labels)
    judged = quality.judge(odd, model).select("__row.text", "kept").collect()
    assert len(judged) == len(ODD) and len({r["kept"] for r in judged if r["text"] == LONG}) == 1
    assert quality.judge(none, quality.fit(none, labels.where("false"))).count() == 0


def test_bpe_is_the_librarys(spark, sf_dir, docs, odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.SpeculativeBpe(path)
    rng = random.Random(1)
    texts = [t or "" for _, t in ODD] + ["".join(rng.choice("abc  \n\t'stred.!?0129éßжॐ漢🙂\xa0\x85\x1c ") for _ in range(rng.randint(0, 200))) for _ in range(500)]
    for t in texts:
        units = own.split(t)
        ids = [i for u in units for i in ([own.special[u]] if u in own.special else own.units([u])[0])]
        assert ids == library.encode(t, add_special_tokens=False).ids
    for r in QUERIES["op9_bpe"](spark, sf_dir).collect():
        ids = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_decode(odd, path, keep_ids=True).where("decoded <> coalesce(__row.text, '')").count() == 0
    assert bpe.encode_decode(none, path).count() == 0


def test_licenses(spark, sf_dir, docs, odd, none):
    for r in QUERIES["op10_license_scan"](spark, sf_dir).collect():
        w = plain_words(docs[r["doc_id"]].encode())
        at = sorted((k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(w)) if w[k:k + phrase.count(" ") + 1] == phrase.encode().split())
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in at})) and set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) | {""}
    scanner = licenses.Scanner(licenses.NOTICES)
    for label, words in licenses.NOTICES:
        k = max(1, len(words) // licenses.LETTERS_PER_EDIT)
        harmed = list("xx " + words + " yy")
        for j in range(k):
            harmed[3 + (j * len(words)) // k + 1] = "q"
        assert label in {s[0] for s in scanner.spans("".join(harmed))}
    assert licenses.scan(odd, spans=True).where("labels = 'mit' AND score = 1").count() == 1 and licenses.scan(none).count() == 0


def fewest_edits(words, text):
    """Edits of the best place of a notice anywhere in a text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(words, 1):
        before, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(before[j - 1] + (w != t), before[j] + 1, row[-1] + 1))
    return min(row)


def test_notices_against_brute_force():
    scanner, rng = licenses.Scanner(licenses.NOTICES), random.Random(5)
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            notice = list(rng.choice(licenses.NOTICES)[1])
            for _ in range(rng.randint(0, 8)):
                at = rng.randrange(len(notice))
                notice[at:at + rng.randint(0, 1)] = rng.choice(["", "q", "license"[rng.randrange(7)]])
            parts.append("".join(notice))
        text = rng.choice([" ", " and ", ""]).join(parts)
        best: dict = {}
        for start, end, i, edits in scanner.candidates(text):
            assert fewest_edits(scanner.notices[i][1], text[start:end]) <= edits
            best[i] = min(edits, best.get(i, edits))
        expected = {i: fewest_edits(words, text) for i, (_, words, _, _) in enumerate(scanner.notices)}
        assert best == {i: e for i, e in expected.items() if e <= scanner.notices[i][2]}
        found = scanner.candidates(text)
        assert scanner.spans(text) == sorted(
            ((scanner.notices[i][0], i, a, b, e) for a, b, i, e in found if not any(f < e and c < b and a < d for c, d, _, f in found)), key=lambda s: (s[2], s[3], s[1]))


def test_each_place_of_a_notice_once_and_long_texts(spark):
    scanner = licenses.Scanner(licenses.NOTICES)
    two = "licensed under the mit licence or licensed under the mit license"
    assert [s[2:] for s in scanner.spans(two) if s[1] == 2] == [(0, 30, 1), (34, 64, 0)]
    started = time.time()
    for notice in ("licensed under the mit license ", "licensed under the mit licence "):
        assert len([s for s in scanner.spans(notice * 10_000) if s[1] == 2]) == 10_000
    assert time.time() - started < 60
    own = licenses.scan(spark.createDataFrame([("Shared with Friends only, MIT license",)], "text string"), spans=True, notices=[("friends", "shared with friends only")])
    assert own.select("labels", "spans").first() == ("friends,mit", [("friends", 0, 24, 0)])


def test_address_suffixes_and_domains(spark):
    hosts = {"www.vw.de": ("de", "vw.de"), "www.hp.fr": ("fr", "hp.fr"), "news.bbc.co.uk": ("co.uk", "bbc.co.uk"), "shop.com.au": ("au", "shop.com.au"),
             "x.ac.jp": ("jp", "x.ac.jp"), "co.uk": ("uk", "co.uk"), "a.b.example.org": ("org", "example.org"), "localhost": ("", ""), None: ("", "")}
    df = spark.createDataFrame([(h,) for h in hosts], "h string")
    got = langid.views(df, "h", F.lit(None), F.col("h"), F.lit(1)).select("__row0.h", "__suffix", "__domain").collect()
    assert {r[0]: (r[1], r[2]) for r in got} == hosts


def test_repeated_ids_in_the_labelled_sample(spark):
    """One text of an id is learned from, whichever row comes first."""
    text = [" ".join(f"{w}{k}" for k in range(60)) for w in ("good", "bad")]
    rows = [(1, text[0])] * 50 + [(1, text[1])] * 50 + [(2, text[0])]
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    models = [quality.fit(spark.createDataFrame(r, "doc_id long, text string").repartition(n), labels) for r, n in ((rows, 1), (rows[::-1], 7))]
    assert np.array_equal(models[0].ratio, models[1].ratio) and models[0].threshold == models[1].threshold


def test_percentiles_are_exact(spark):
    draw = random.Random(8)
    for values in ([], [3.0], [1.0] * 50 + [2.0], [draw.gauss(0, 1) ** 9 for _ in range(3000)] + [None, 0.0, 0.0], [1e-300 * k for k in range(100)]):
        df = spark.createDataFrame([(v,) for v in values], "score double").repartition(5)
        want = df.agg(F.percentile("score", [0.0, 0.001, 0.37, 0.5, 1.0])).first()[0]
        assert common.percentiles(df, [0.0, 0.001, 0.37, 0.5, 1.0]) == want


def test_models_learn_from_all_rows(spark):
    """More labelled rows and rows of a language than a bound that was there."""
    texts = spark.range(0, 20_600, 1, 5).selectExpr("id AS doc_id", "repeat(concat('word', id, ' '), 3) AS text", "'en' AS lang")
    labels = texts.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    assert not quality.fit(texts, labels).ratio.any()
    counts = np.zeros(1 << langid.BITS)
    for r in texts.collect():
        h, whole = common.gram_bins(*common.flat([r["text"].encode()]), langid.N, langid.BITS)
        np.add.at(counts, h[whole], 1)
    model = langid.fit(langid.views(texts, "text", F.col("lang"), F.lit(None), F.col("doc_id")))
    assert model.languages == ["en", "und"] and np.allclose(model.log_bins[0], np.log((counts + 0.1) / (counts + 0.1).sum()), rtol=1e-12)


def test_pipeline_stages_on_odd_tables(spark, sf_dir, odd, none):
    for table in (odd, none, none.drop("n_tokens")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf_dir)
            assert out.columns == table.columns, name
            assert out.count() <= table.count()
        coded = corpus_pipeline.STAGES[-1][1](spark, table, sf_dir)
        assert sorted(coded.columns) == sorted({*table.columns, "n_tokens", "ids_sha256", "decoded_sha256", "ids"})
        assert coded.count() == table.count()
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf_dir).where("doc_id = 1 AND n_tokens = 0 AND size(ids) = 0").count() == 1


def test_pipeline(spark, sf_dir, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "language id", "near duplicates", "decontamination", "bpe"]
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    items = [(str(r["item_id"]), plain_words(r["text"].encode())) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert rows and len({r["doc_id"] for r in rows}) == len(rows)
    assert all(brute_windows(r["text"], items)[1] == 0 for r in rows)
    assert all(r["text"] == docs[r["doc_id"]] or r["n_chars"] == len(r["text"]) for r in rows)
