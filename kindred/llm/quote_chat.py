"""Quotation linking: conversations ordered by reply, without the quotes.

A line's quote level is the number of '>' at its start. Lines of one level up to a blank line
or another level form a passage, normalised to lower case and single spaces and hashed. Quoted
passages are looked up among the passages and lines of earlier messages of the conversation,
and where none equals them, among all runs of as many words in the earlier messages' passages,
so that any excerpt of whole words finds its original; a message replies to the latest message
that its outermost linked quote came from. Quotes that are linked leave the body, and the
attribution line right before one goes with it; marked lines that link to nothing, such as a
prompt of code, are the message's own words and stay.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import regex

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm.shared import Scratch, by_batches

MARK = regex.compile(r"^[ \t]*((?:>[ \t]?)+)(.*)$")
#: Line endings that introduce a quote.
SAYS = regex.compile(r"(?:wrote|writes|said|schrieb|a écrit|escribió)[ \t ]*:[ \t]*$", regex.I)


@dataclass
class Parsed:
    """A message by its passages: quoted ones as (level, normal form), own passages and lines, and the lines with their quote's place."""

    quotes: list[tuple[int, str]]
    pieces: list[str]
    lines: list[tuple[str, int]]

    def body(self, linked=frozenset()) -> str:
        """The text without the quotes of the given places, and without the lines that introduce these."""
        kept = []
        for k, (line, quote) in enumerate(self.lines):
            after = self.lines[k + 1][1] if k + 1 < len(self.lines) else -1
            if quote not in linked and not (quote < 0 and after in linked and SAYS.search(line)):
                kept.append(line)
        return "\n".join(kept).strip("\n")

    def own(self) -> str:
        """The text with empty lines in place of marked and introducing ones, so that passages end there."""
        marked = [bool(MARK.match(line)) for line, _ in self.lines] + [False]
        return "\n".join("" if now or after and SAYS.search(line) else line for (line, _), now, after in zip(self.lines, marked, marked[1:]))


def parsed(text: str) -> Parsed:
    quotes, pieces, placed = [], [], []
    level, held = 0, []

    def close():
        words = " ".join(" ".join(held).lower().split())
        if words and level:
            quotes.append((level, words))
        elif words:
            pieces.extend([words, *(" ".join(x.lower().split()) for x in held)] if len(held) > 1 else [words])
        held.clear()

    lines = text.split("\n")
    says = ""
    for k, line in enumerate(lines):
        m = MARK.match(line)
        now, body = (m[1].count(">"), m[2]) if m else (0, line)
        if now != level or not body.strip():
            close()
            level = now
        says = line if not now and k + 1 < len(lines) and SAYS.search(line) and MARK.match(lines[k + 1]) else ""
        # a marked line without words is part of the quote it touches
        placed.append((line, len(quotes) if now and body.strip() else len(quotes) - 1 if now and quotes and not held else -1))
        if body.strip() and not says:
            held.append(body)
    close()
    return Parsed(quotes, list(dict.fromkeys(x for x in pieces if x)), placed)


PARTS = T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("level", T.IntegerType()), T.StructField("quoted", T.BooleanType())]))


def digests(batches):
    """Adds own (text without marked lines) and parts (normal forms of quoted and own passages); text stays only with quotes."""
    for batch in batches:
        texts, own, parts = [], [], []
        for text in batch.column("text").to_pylist():
            found = parsed(text or "")
            own.append(found.own())
            texts.append(text if found.quotes else None)
            parts.append([{"key": q, "level": n, "quoted": True} for n, q in found.quotes] + [{"key": p, "level": 0, "quoted": False} for p in found.pieces])
        kind = pa.list_(pa.struct([("key", pa.string()), ("level", pa.int32()), ("quoted", pa.bool_())]))
        bodies = [None if t is not None else (x or "").strip("\n") for t, x in zip(texts, batch.column("text").to_pylist())]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "turn", "role")), pa.array(texts, pa.string()), pa.array(bodies, pa.string()), pa.array(own, pa.string()), pa.array(parts, kind)], names=["conv_id", "turn", "role", "text", "body", "own", "parts"])


def bodies(batches):
    """Bodies of messages with quotes, by the hashes of those that were linked."""
    for batch in batches:
        out = []
        for text, body, linked in zip(*(batch.column(c).to_pylist() for c in ("text", "body", "linked"))):
            if text is not None:
                found, known = parsed(text), set(linked or ())
                body = found.body({k for k, (_, q) in enumerate(found.quotes) if hashlib.md5(q.encode()).hexdigest() in known})
            out.append(body)
        kept = [c for c in batch.schema.names if c not in ("text", "body", "linked")]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out, pa.string())], names=[*kept, "body"])


def excerpts(batches):
    """Hashes of all runs of words of the given lengths in each own passage."""
    for batch in batches:
        rows = []
        for conv, turn, body, lengths in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "own", "lengths"))):
            found, held = set(), []
            for line in [*body.split("\n"), ""]:
                words = line.lower().split()
                if words:
                    held.extend(words)
                    continue
                for n in lengths:
                    found.update(" ".join(held[k : k + n]) for k in range(len(held) - n + 1))
                held = []
            rows.extend((conv, turn, hashlib.md5(x.encode()).hexdigest()) for x in found)
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["conv_id", "turn", "check"])


#: Turns of a conversation that are looked at together; what is before them comes as one row for each passage.
SPAN = 1024


def latest_before(part: DataFrame, column: str, which) -> DataFrame:
    """``part`` (conv_id, check, turn, ...) with ``column``: the latest earlier turn whose row fulfils ``which``.

    Ordered passes over each passage's rows within spans of turns, and over one row for each span,
    so that a passage that a whole long conversation repeats is no single task.
    """
    part = part.withColumn("span", F.floor(F.col("turn") / SPAN))
    by = ["conv_id", "check"]
    inside = W.partitionBy(*by, "span").orderBy("turn").rangeBetween(W.unboundedPreceding, -1)
    here = part.withColumn("here", F.max(F.when(which, F.col("turn"))).over(inside))
    spans = part.groupBy(*by, "span").agg(F.max(F.when(which, F.col("turn"))).alias("last"))
    before = spans.select(*by, "span", F.max("last").over(W.partitionBy(*by).orderBy("span").rowsBetween(W.unboundedPreceding, -1)).alias("before"))
    return here.join(before, [*by, "span"]).withColumn(column, F.coalesce("here", "before")).drop("span", "here", "before")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, reply_to, thread, depth, n_quotes, n_linked, rendered), one row a message.

    ``thread`` is the turn that the chain of replies starts from and ``depth`` its length; in the
    order of thread, depth and turn a message comes after all that it replies to. Messages that
    link to nothing start a thread. ``n_quotes`` counts quoted passages, ``n_linked`` the distinct
    ones that were found. A null text is empty; messages with a null conversation or
    turn start a thread of their own and are linked with nothing. Messages that repeat a turn
    have that turn's link. Other columns are not used.
    """
    spark = messages.sparkSession
    scratch = Scratch(spark, "quotes")
    plain = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    schema = T.StructType([*(plain.schema[c] for c in ("conv_id", "turn", "role", "text")), T.StructField("body", T.StringType()), T.StructField("own", T.StringType()), T.StructField("parts", PARTS)])
    read = scratch.keep("read", by_batches(plain, digests, schema))
    known = read.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    part = known.select("conv_id", "turn", F.explode("parts").alias("p")).select("conv_id", "turn", F.md5("p.key").alias("check"), "p.level", "p.quoted", F.size(F.split("p.key", " ")).alias("length"))
    # only passages that are quoted somewhere in the conversation matter; others stop here
    asked = part.where("quoted").select("conv_id", "check").distinct()
    part = part.join(asked, ["conv_id", "check"], "left_semi").distinct()
    found = scratch.keep("whole", latest_before(part, "origin", ~F.col("quoted")).where("quoted"))
    # quotes that no whole passage or line equals: runs of their numbers of words
    open_ = found.where("origin IS NULL").drop("origin")
    lengths = open_.groupBy("conv_id").agg(F.sort_array(F.collect_set("length")).alias("lengths"))
    inner = by_batches(known.select("conv_id", "turn", "own").join(lengths, "conv_id"), excerpts, "conv_id long, turn long, check string")
    inner = inner.join(open_.select("conv_id", "check").distinct(), ["conv_id", "check"], "left_semi").select("conv_id", "turn", "check", F.lit(0).alias("level"), F.lit(False).alias("quoted"), F.lit(0).alias("length"))
    partly = latest_before(open_.unionByName(inner), "origin", ~F.col("quoted")).where("quoted AND origin IS NOT NULL")
    linked = scratch.keep("linked", found.where("origin IS NOT NULL").unionByName(partly).select("conv_id", "turn", "check", "level", "origin"))
    top = linked.groupBy("conv_id", "turn").agg(F.max(F.struct(-F.col("level"), "origin")).alias("x"), F.collect_set("check").alias("linked"))
    gone = top.select("conv_id", "turn", "linked")
    hop = scratch.keep("hop-0", top.select("conv_id", "turn", F.col("x.origin").alias("reply_to"), F.col("x.origin").alias("up"), F.lit(1).cast("long").alias("depth")))
    turn = 0
    while True:  # pointer doubling: each pass halves what is left of every chain
        far = hop.select("conv_id", F.col("turn").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        joined = hop.join(far, ["conv_id", "up"], "left")
        turn += 1
        moved = scratch.keep(f"hop-{turn}", joined.select("conv_id", "turn", "reply_to", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved")))
        scratch.drop(f"hop-{turn - 1}")
        hop = moved.drop("moved")
        if not moved.where("moved").limit(1).count():
            break
    scratch.drop("whole")
    quotes = F.size(F.filter("parts", lambda p: p["quoted"])).cast("long")
    out = read.drop("own").join(gone, ["conv_id", "turn"], "left").withColumns({"n_quotes": quotes, "n_linked": F.coalesce(F.size("linked"), F.lit(0)).cast("long")}).drop("parts")
    schema = T.StructType([f for f in out.schema if f.name not in ("text", "body", "linked")] + [T.StructField("body", T.StringType())])
    out = by_batches(out, bodies, schema).join(hop, ["conv_id", "turn"], "left")
    rendered = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), "body")
    return out.select("conv_id", "turn", "role", "body", "reply_to", F.coalesce("up", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).cast("long").alias("depth"), "n_quotes", "n_linked", rendered.alias("rendered"))
