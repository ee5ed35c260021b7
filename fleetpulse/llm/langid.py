"""Language identification: text likelihoods, declared language, address suffix and host priors in one posterior.

The text model is a multinomial over hashed byte trigrams for each language that enough rows of the whole table
declare, fitted on all of these rows. A language that fewer declare is a hypothesis for the rows that declare it, as
a text of any language or of none. Priors are counts of what the texts alone say, over all rows, by host,
domain and table, each level smoothed by the one above. ``und`` is a hypothesis of its own: bytes that
follow no language, uniform over the bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import SLICE_BYTES, binaries, bounded_batches, carry, flat, gram_bins, portions, release, stored, sums

N, BITS = 3, 14
#: About how many rows of each language the models are fitted on (None: all), and the rows of the table that a language must have.
LABELLED, LEAST = None, 5
#: Numbers (hosts times languages) of the broadcast prior table; rows of other hosts are joined by host.
TABLE_NUMBERS = 100_000
#: Weights of the parent level in the smoothed priors.
DOMAIN_WEIGHT, HOST_WEIGHT = 100.0, 20.0
#: How often a declaration or an address suffix names the right language.
DECLARED_RIGHT, SUFFIX_RIGHT = 0.9, 0.7
UNKNOWN = "und"
# Country suffixes with one main language.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "co.uk": "en", "uk": "en", "us": "en", "au": "en", "ie": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh", "kr": "ko"}
#: Those of the suffixes that have two parts, tried first.
LONG_SUFFIXES = "|".join(s.replace(".", r"\.") for s in SUFFIXES if "." in s)
# Second parts under which a country's registry gives out names.
REGISTRY = "co|com|net|org|edu|gov|ac|or|ne|go"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class Model:
    languages: list[str]  # UNKNOWN is the last
    log_bins: np.ndarray  # languages x bins
    log_any: np.ndarray  # bins, all languages together


def language(declared: Column) -> Column:
    """``EN-us`` as ``en``; null where nothing is declared."""
    code = F.regexp_extract(F.lower(F.trim(declared.cast("string"))), "^([a-z]{2,3})([-_].*)?$", 1)
    return F.when(code != "", code)


def views(df: DataFrame, text: str, declared: Column, host: Column, key: Column) -> DataFrame:
    """``__row``, and what the evidence needs in columns of their own."""
    host = F.lower(F.coalesce(host.cast("string"), F.lit("")))
    return df.select(F.struct("*").alias("__row0"), F.col(text).cast("string").alias("__text"), language(declared).alias("__declared"), host.alias("__host"), F.xxhash64(key, F.col(text).cast("string")).alias("__hash")).withColumn(
        "__suffix", F.regexp_extract("__host", rf"\.({LONG_SUFFIXES}|[a-z]+)$", 1)).withColumn("__domain", F.regexp_extract("__host", rf"([^.]+\.(?:(?:{REGISTRY})\.[a-z]{{2}}|[^.]+))$", 1))


def fit(rows: DataFrame) -> Model:
    """Trigram models of all languages that LEAST rows declare, each from all its rows.

    A caller that sets LABELLED gets models of the rows with the smallest hashes, by a bound for each language; the smallest
    hash is always chosen.
    """
    declared = rows.where("__declared IS NOT NULL")
    found = declared.groupBy("__declared").agg(F.count("*").alias("n"), F.min("__hash").alias("least")).where(F.col("n") >= LEAST).orderBy("__declared").collect()
    often = [r[0] for r in found]
    bounds = [(lang, max(least, -(1 << 63) + (1 << 64) * min(LABELLED or n, n) // n - 1)) for lang, n, least in found]
    table = rows.sparkSession.createDataFrame(bounds, "__declared string, __bound long")
    chosen = declared.join(F.broadcast(table), "__declared").where("__hash <= __bound")
    bounded_batches(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = [(t or b"").translate(LOWER) for t in batch.column(0).to_pylist()], np.array(batch.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                for part in portions([t for t, x in zip(texts, langs, strict=True) if x == lang], SLICE_BYTES):
                    h, whole = gram_bins(*flat(part), N, BITS)
                    total[lang] = total.get(lang, 0) + np.bincount(h[whole], minlength=1 << BITS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "bin", "n"])
        release()

    counts = np.zeros((len(often), 1 << BITS))
    for lang, b, n in chosen.select(F.col("__text").cast("binary"), "__declared").mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n")).toLocalIterator():
        counts[often.index(lang), b] += n
    share = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True)
    uniform = np.full((1, 1 << BITS), 0.5 ** BITS)
    pooled = counts.sum(axis=0) + 0.1
    return Model([*often, UNKNOWN], np.log(np.concatenate([share, uniform])), np.log(pooled / pooled.sum()))


def likelihoods(texts: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log likelihood of each text (rows) and language; a trigram shares its bytes with two others, so counts a third."""
    data, starts = flat([t.translate(LOWER) for t in texts])
    h, whole = gram_bins(data, starts, N, BITS)
    columns = [sums(np.where(whole, row[h], 0.0), starts) / N for row in model.log_bins]
    return np.stack(columns, axis=1), sums(whole.astype(np.int64), starts)


def any_likelihood(texts: list[bytes], model: Model) -> np.ndarray:
    """The same if nothing is known of the language: as all languages together or as none, whichever is more likely."""
    data, starts = flat([t.translate(LOWER) for t in texts])
    h, whole = gram_bins(data, starts, N, BITS)
    return np.maximum(sums(np.where(whole, model.log_any[h], 0.0), starts), sums(whole.astype(np.float64), starts) * model.log_bins[-1, 0]) / N


def priors(rows: DataFrame, model: Model) -> DataFrame:
    """(__host, n, prior): smoothed shares of the languages, from the texts' own verdicts over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    size = len(model.languages)

    def verdicts(batches):
        for batch in batches:
            ll, grams = likelihoods(binaries(batch, "__text"), shared.value)
            yield [pa.array(np.where(grams > 0, ll.argmax(axis=1), size - 1).astype(np.int32))]

    said = carry(rows.select("__text", "__host", "__domain"), "lang int", verdicts, by="__text")
    tally = stored(said.groupBy(F.col("__row.__host").alias("__host"), F.col("__row.__domain").alias("__domain"), "lang").agg(F.count("*").alias("n")), "host-counts")

    def vector(df: DataFrame, by: list[str]) -> DataFrame:
        counts = [F.sum(F.when(F.col("lang") == i, F.col("n")).otherwise(0)).cast("double") for i in range(size)]
        return df.groupBy(*by).agg(F.sum("n").alias("n"), F.array(*counts).alias("c"))

    total = vector(tally, []).first()
    table = (np.array([c or 0.0 for c in total["c"]]) + 1) / ((total["n"] or 0) + size)
    over = F.array(*[F.lit(float(x)) for x in table])
    mix = lambda w: lambda c, p: c + p * F.lit(w)
    domains = vector(tally, ["__domain"]).select("__domain", F.transform(F.zip_with("c", over, mix(DOMAIN_WEIGHT)), lambda x: x / (F.col("n") + DOMAIN_WEIGHT)).alias("parent"))
    hosts = vector(tally, ["__host", "__domain"]).join(domains, "__domain")
    return stored(hosts.select("__host", "n", F.transform(F.zip_with("c", "parent", mix(HOST_WEIGHT)), lambda x: x / (F.col("n") + HOST_WEIGHT)).alias("prior")), "host-priors")


def identify(df: DataFrame, declared: Column, host: Column, key: Column, text: str = "text") -> DataFrame:
    """``__row`` with ``lang``, ``confidence``, ``declared``, ``host``, ``kept`` for every row of the table.

    ``kept`` is false for ``und`` and for texts shorter than a trigram (null, empty), which have no evidence of their own.
    Equal rows get equal verdicts; null or odd declarations and hosts are missing evidence. Rows of hosts with
    many rows find their prior in a broadcast table of bounded size, others by a join on the host.
    """
    rows = views(df, text, declared, host, key)
    model = fit(rows)
    hosts = priors(rows, model)
    entries = TABLE_NUMBERS // len(model.languages)
    top = hosts.orderBy(F.desc("n"), "__host").limit(entries).drop("n")
    if hosts.count() <= entries:
        joined = rows.join(F.broadcast(top), "__host")
    else:
        rest = rows.join(F.broadcast(top.select("__host")), "__host", "left_anti").join(hosts.drop("n"), "__host")
        joined = rows.join(F.broadcast(top), "__host").unionByName(rest)
    shared = df.sparkSession.sparkContext.broadcast(model)
    new = "lang string, confidence double, kept boolean"

    def hint(names: list[str | None], right: float, langs: list[str], own: list[str | None]) -> np.ndarray:
        """Of each row and language; the last column is that of the row's own hypothesis, if it has one."""
        out = np.zeros((len(names), len(langs) + 1))
        for i, name in enumerate(names):
            if name is not None and (name in langs[:-1] or name == own[i]):
                out[i] = np.log((1 - right) / max(1, len(langs) - (own[i] is None)))
                out[i, -1 if name == own[i] else langs.index(name)] = np.log(right)
        return out

    def work(batches):
        m = shared.value
        und = len(m.languages) - 1
        for batch in batches:
            prior = np.array(batch.field("prior").to_pylist())
            texts, names = binaries(batch, "__text"), batch.field("__declared").to_pylist()
            ll, grams = likelihoods(texts, m)
            own = [x if x not in m.languages[:-1] else None for x in names]
            at = [i for i, x in enumerate(own) if x is not None]
            # Texts of a language without a model are among those that follow none: the same prior.
            score = np.concatenate([ll + np.log(prior), np.full((len(texts), 1), -np.inf)], axis=1)
            if at:
                score[at, -1] = any_likelihood([texts[i] for i in at], m) + np.log(prior[at, und])
            score += hint(names, DECLARED_RIGHT, m.languages, own)
            score += hint([SUFFIXES.get(s) for s in batch.field("__suffix").to_pylist()], SUFFIX_RIGHT, m.languages, own)
            best = score.argmax(axis=1)
            sure = 1 / np.exp(score - score.max(axis=1, keepdims=True)).sum(axis=1)
            kept = (best != und) & (grams > 0)
            said = [own[i] if b > und else m.languages[b] for i, b in enumerate(best)]
            yield [pa.array([x if k else UNKNOWN for x, k in zip(said, kept, strict=True)], pa.string()), pa.array(np.round(sure, 6)), pa.array(kept)]

    done = carry(joined, new, work, by="__text")
    return done.select(F.col("__row.__row0").alias("__row"), "lang", "confidence", F.col("__row.__declared").alias("declared"), F.col("__row.__host").alias("host"), "kept")
