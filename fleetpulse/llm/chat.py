"""Chat formatting: every assistant turn as an example of its own, all turns before it as its context.

The rendered turns of a conversation are its pieces. An example shows the pieces 0 to ``last`` and is trained on
the last one's text. ``written`` writes the texts of all examples out, ``read_back`` reads all it says from them.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import BATCH_BYTES, BATCH_ROWS, bounded_batches, release, stored

# The template. Its marks and the escape sign get an escape sign where texts and roles have them.
HEAD, MIDDLE, END = "### ", ": ", "</turn>\n"
IN_ROLE, IN_TEXT = r"(\\|###|</turn>|: )", r"(\\|###|</turn>)"
PIECE = re.compile(r"### ((?:[^\\:]++|\\.|:(?! ))*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.S)
ESCAPED = re.compile(r"\\(\\|###|</turn>|: )")
#: Bytes of a part of an example's text: whole pieces, one alone if it is longer.
PART = 1 << 16
#: Characters of examples that one group of rows writes at most, besides those of its first example.
STRETCH = 1 << 27
#: Tasks that give a long conversation's pieces to its stretches.
SALTS = 64


def escaped(text: Column, marks: str) -> Column:
    return F.regexp_replace(text, marks, r"\\$1")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def parse(text: str) -> Iterator[tuple[str, str]]:
    """Roles and texts of one or more rendered turns."""
    at = 0
    while at < len(text):
        found = PIECE.match(text, at)
        if not found:
            raise ValueError(f"no turn begins at character {at}")
        yield unescape(found[1]), unescape(found[2])
        at = found.end()


def render(df: DataFrame) -> DataFrame:
    """The pieces of all conversations, stored: conv_id, seq, trained, piece, start, head_chars, text_chars, turns, total.

    ``seq`` counts a conversation's rows from 0 by turn (null first), then role, then the text's hash; all rows
    stay, repeated ones too. ``start`` is the number of characters before the piece, ``turns`` and ``total`` are the
    pieces and characters of the whole conversation. A null role or text counts as empty, null conv_ids are one
    conversation. Rows are dealt by ranges of conversation and turn, so a long conversation spreads over tasks;
    its parts are put in line by their counts.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    order = ["conv_id", "turn", "role", "hash"]
    rows = df.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.xxhash64(text).alias("hash"))
    head, body = F.concat(F.lit(HEAD), escaped(F.col("role"), IN_ROLE), F.lit(MIDDLE)), escaped(F.col("text"), IN_TEXT)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    rows = stored(rows.select(*order, "part", (F.col("role") == "assistant").alias("trained"), F.concat(head, body, F.lit(END)).alias("piece"),
                              F.length(head).alias("head_chars"), F.length(body).alias("text_chars")), "chat-rows")
    run = Window.partitionBy("part", "conv_id").orderBy(*order[1:], "piece")
    before = run.rowsBetween(Window.unboundedPreceding, -1)
    chars = F.length("piece").cast("long")
    placed = rows.select("*", (F.row_number().over(run) - 1).alias("__seq"), F.coalesce(F.sum(chars).over(before), F.lit(0)).alias("__start"))
    whole = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.sum(chars).alias("c"))
    line = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = whole.select(F.col("conv_id").alias("__conv"), F.col("part").alias("__part"), F.coalesce(F.sum("n").over(line), F.lit(0)).alias("__n"), F.coalesce(F.sum("c").over(line), F.lit(0)).alias("__c"),
                         F.sum("n").over(every).alias("turns"), F.sum("c").over(every).alias("total"))
    joined = placed.join(whole, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("part") == F.col("__part")))
    out = joined.select("conv_id", (F.col("__seq") + F.col("__n")).alias("seq"), "trained", "piece", (F.col("__start") + F.col("__c")).alias("start"), "head_chars", "text_chars", "turns", "total")
    return stored(out, "chat-pieces")


def examples(pieces: DataFrame) -> DataFrame:
    """One row for each assistant turn, and one with nothing to train for turns that no assistant turn follows.

    conv_id, ``last`` (the example shows the pieces 0 to ``last``), ``chars`` (of the example), ``loss_start`` and
    ``loss_chars`` (of the example's characters, those on which it is trained; null in a row without), ``turns`` and
    ``total`` (of its conversation). One example of each conversation shows all of it. ``written`` has their texts.
    """
    body = F.col("start") + F.col("head_chars")
    loss = [F.when(F.col("trained"), c).alias(n) for c, n in ((body, "loss_start"), (F.col("text_chars").cast("long"), "loss_chars"))]
    ends = pieces.where(F.col("trained") | (F.col("seq") + 1 == F.col("turns")))
    return ends.select("conv_id", F.col("seq").alias("last"), (body + F.col("text_chars") + len(END)).alias("chars"), *loss, "turns", "total")


def stretch(turns: Column, chars: Column) -> Column:
    """Numbers neighbouring examples alike: each turn adds an example's length at least, so a number's examples have STRETCH characters and one more example at most."""
    return F.floor(turns.cast("double") * chars / STRETCH)


def written(chosen: DataFrame, pieces: DataFrame) -> DataFrame:
    """The texts of chosen examples, all they show written out: conv_id, last, part, at, text, loss_start, loss_chars, entire.

    The text of an example is that of its parts in order, ``at`` the characters before a part; ``entire`` says that
    it shows its whole conversation. Parts hold whole pieces, PART bytes of them unless one is longer. Pieces pass
    a task in order, and each example there is all that has passed. Examples of a long conversation are dealt to
    tasks by stretches, each of which gets the pieces up to its last example. A task holds the text of one
    conversation of a stretch, STRETCH characters at most; one example by itself leaves part by part.
    """
    bounded_batches(pieces.sparkSession)
    of = ["last", "loss_start", "loss_chars", "entire"]
    marks = chosen.withColumns({"stretch": stretch(F.col("last") + 1, F.col("chars")), "entire": F.col("last") + 1 == F.col("turns")})
    none = [F.lit(None).cast(marks.schema[c].dataType).alias(c) for c in of]
    text = [F.lit(False).alias("ends"), "start", F.col("piece").cast("binary").alias("piece")]
    # A conversation of one stretch, as nearly all are, needs no join.
    several = stretch(F.col("turns"), F.col("total")) > 0
    rows = pieces.where(~several).select("conv_id", F.lit(0).cast("long").alias("stretch"), "seq", *text, *none)
    spans = marks.where(several).groupBy(F.col("conv_id").alias("__conv"), "stretch").agg(F.max("last").alias("__to"), F.count("*").alias("__n"), F.max(F.struct(*of)).alias("__of"))
    spans = spans.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    long = pieces.where(several).join(spans, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("seq") % SALTS == F.col("__salt")) & (F.col("seq") <= F.col("__to")))
    rows = rows.unionByName(long.select("conv_id", "stretch", "seq", *text, *(F.when(F.col("__n") == 1, F.col(f"__of.{c}")).alias(c) for c in of)))
    rows = rows.unionByName(marks.select("conv_id", "stretch", F.col("last").alias("seq"), F.lit(True).alias("ends"), F.lit(None).cast("long").alias("start"), F.lit(None).cast("binary").alias("piece"), *of))
    rows = rows.repartition("conv_id", "stretch").sortWithinPartitions("conv_id", "stretch", "seq", "ends")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        group, closed, gone, begin, held, size = None, [], 0, 0, [], 0
        for batch in batches:
            for conv, number, _, ends, start, piece, *example in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != (conv, number):
                    group, closed, gone, held, size = (conv, number), [], 0, [], 0
                if ends:
                    for k, (at, text) in enumerate([*closed, (begin, b"".join(held))], gone):
                        yield conv, k, at, text, *example
                    continue
                if held and size + len(piece) > PART:
                    closed.append((begin, b"".join(held)))
                    held, size = [], 0
                    if example[0] is not None:
                        yield conv, gone, *closed.pop(), *example
                        gone += 1
                if not held:
                    begin = start
                held.append(piece)
                size += len(piece)

    names = ["conv_id", "part", "at", "text", *of]
    key = pieces.schema["conv_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field("conv_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            return pa.RecordBatch.from_arrays([c.cast(pa.string()) if n == "text" else c for c, n in zip(columns, names, strict=True)], names=names)

        done, size = [], 0
        for row in parts(itertools.chain([first], batches)):
            done.append(row)
            size += len(row[3])
            if len(done) == BATCH_ROWS or size >= BATCH_BYTES:
                yield out(done)
                done, size = [], 0
        if done:
            yield out(done)
        release()

    return rows.mapInArrow(write, f"conv_id {key}, part long, at long, text string, last long, loss_start long, loss_chars long, entire boolean")


def materialise(chosen: DataFrame, pieces: DataFrame) -> DataFrame:
    """Texts of chosen examples, for examples that fit a row: conv_id, last, text, loss_start, loss_chars."""
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "")
    return written(chosen, pieces).groupBy("conv_id", "last", "loss_start", "loss_chars").agg(text.alias("text"))


def read_back(pieces: DataFrame, shown: DataFrame) -> DataFrame:
    """What the output says, one row a conversation: the texts of the examples are written, then all is read from them.

    Turns are those of the example that shows the whole conversation, trained characters those that each example
    marks. A digest is sequential, so what it needs of one conversation streams through one task, in order and
    with constant memory; nothing is held.
    """
    # Spark reads thousands of rows at once, but not beyond a row group.
    texts = stored(written(shown, pieces), "chat-examples", **{"compression": "zstd", "parquet.block.row.count.limit": str(BATCH_ROWS)})
    bounded_batches(pieces.sparkSession)
    chars = F.length("text").cast("long")
    inside = (F.col("loss_start") >= F.col("at")) & (F.col("loss_start") < F.col("at") + chars)
    loss = F.when(inside, F.substring("text", (F.col("loss_start") - F.col("at") + 1).cast("int"), F.col("loss_chars").cast("int")))
    rows = texts.select("conv_id", "last", "part", chars.alias("chars"), F.when(F.col("entire"), F.col("text")).alias("text"), loss.alias("loss"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "last", "part")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        done: list[tuple] = []

        def closed() -> tuple:
            conv, n, turns, chars, loss, total = state
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), total

        def out(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            for conv, _, _, size, text, loss in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or state[0] != conv:
                    done += [closed()] if state else []
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[5] += size
                for role, said in parse(text or ""):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                if loss is not None:
                    masked = unescape(loss)
                    state[3] += len(masked)
                    state[4].update(masked.encode())
            yield out(done)
            done = []
        yield out([closed()] if state else [])

    return rows.mapInArrow(digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
