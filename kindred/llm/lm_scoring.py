"""Cross-entropy difference: target and background bigram models over one shared vocabulary.

Both models have the same form: counts of words and word pairs, an add-alpha word model over
the vocabulary, and pair probabilities smoothed towards it. A document's score is the mean over
its tokens of target loss minus background loss (nats); lower means closer to the target. Its own
counts are left out of both models, so that no document is scored by what it taught itself.

Words and pairs are counted apart, each under its own 64-bit hash, and no table of them is ever
in one place. With count c and word probability p, a token's loss is
log(c(before) + beta) - log(c(before, word) + beta * p(word)), so that all it needs follows from
the occurrences of one word: as the word itself, and as the history of the token after it. The
occurrences are dealt out by word, in as many shards as the counted tokens ask for; each shard
counts, and sums the losses of its own tokens by text. Pairs that end in one of the most frequent
words are dealt out by pair instead, and take the word's count from a broadcast of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm import arrowtext
from kindred.llm.shared import Scratch, by_batches, small_or_shuffled

PARTS = ("keys", "members", "runs", "sizes", "words", "at", "before", "n", "flags", "own")
FIRST, LAST = 1, 2
SHORT = np.uint64((1 << 48) - 1)
#: Parts that a shard is read in, and bytes of text that are cut into tokens at a time.
CUTS, SLICE = 8, 2 << 20


@dataclass(frozen=True)
class LmSettings:
    """A word is frequent if it makes more than 1 / ``frequent`` of all tokens, so that there are fewer than that.

    Shards are sorted into tasks, which add up their shards by text, so that a text makes no more
    rows where the corpus asks for more shards: ``spread`` tasks, or as many as keep one's tokens
    within ``task_tokens``.
    """

    alpha: float = 0.1
    beta: float = 4.0
    shard_tokens: int = 3 << 20
    spread: int = 48
    task_tokens: int = 1 << 27
    held_texts: int = 1 << 18
    frequent: int = 1 << 16
    broadcast_rows: int = 1_000_000


@dataclass
class Tokens:
    """Tokens of a batch: row of the batch, word hash, 48 bits of the hash of the word before (0: none), whether first or last of its text."""

    rows: np.ndarray
    words: np.ndarray
    before: np.ndarray
    flags: np.ndarray


def tokens(batch: pa.RecordBatch, text: str) -> Tokens:
    held, base = [], 0
    for part, data, offsets in arrowtext.pieces(batch, text):
        found = arrowtext.words(data, offsets)
        h, full = found.hashes, found.first[:-1] < found.first[1:]
        before, flags = np.zeros_like(h), np.zeros(len(h), np.uint8)
        before[1:] = h[:-1] & SHORT
        before[found.first[:-1][full]] = 0
        flags[found.first[:-1][full]] |= FIRST
        flags[found.first[1:][full] - 1] |= LAST
        held.append(((base + found.texts).astype(np.int32), h, before, flags))
        base += part.num_rows
    return Tokens(*(np.concatenate(x) for x in zip(*held))) if held else Tokens(*(np.zeros(0, t) for t in (np.int32, np.uint64, np.uint64, np.uint8)))


def text_key(text: str, member: str):
    """Documents of one text are scored as one, but for those in the target, whose own counts are left out there too."""
    return F.xxhash64(F.col(text), F.coalesce(F.col(member), F.lit(False))).alias("key")


def pair_of(word: np.ndarray, before: np.ndarray) -> np.ndarray:
    """One hash for a word and the 48 bits of the word before it."""
    with np.errstate(over="ignore"):
        return arrowtext.mix(before * arrowtext.STEP + word)


def flags_of(batch: pa.RecordBatch, member: str) -> np.ndarray:
    return batch.column(member).fill_null(False).to_numpy(zero_copy_only=False).astype(np.uint8)


def narrow(counts: np.ndarray) -> bytes:
    """Counts in the least of 1, 2, 4 or 8 bytes each that holds them all."""
    most = int(counts.max(initial=0))
    return counts.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8").tobytes()


def wide(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}").astype(np.int64)


def word_counts(docs: DataFrame, member: str, text: str = "text") -> DataFrame:
    """(word, n, m): tokens of each word in all documents, and in those whose ``member`` is true."""

    def add_up(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            t = tokens(batch, text)
            words, at = np.unique(t.words, return_inverse=True)
            n, m = np.bincount(at, minlength=len(words)), np.bincount(at[flags_of(batch, member)[t.rows] > 0], minlength=len(words))
            yield pa.RecordBatch.from_arrays([pa.array(arrowtext.signed(words)), pa.array(n, pa.int64()), pa.array(m, pa.int64())], names=["word", "n", "m"])

    return by_batches(docs.select(text, member), add_up, "word long, n long, m long", SLICE).groupBy("word").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def frequent_words(counts: DataFrame, total: int, s: LmSettings) -> np.ndarray:
    """Rows of word hash, n, m in the order of the hash."""
    rows = counts.where(F.col("n") > total // s.frequent + 1).collect()
    table = np.array([(r.word, r.n, r.m) for r in rows], np.int64).reshape(-1, 3)
    return table[np.argsort(np.ascontiguousarray(table[:, 0]).view(np.uint64))]


def found_in(table: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each word is in the table of frequent ones, and in which row."""
    if not len(table):
        return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
    known = np.ascontiguousarray(table[:, 0]).view(np.uint64)
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return known[at] == words, at


def own_counts(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For each token how often its text has the word."""
    order = np.lexsort((words, rows))
    r, w = rows[order], words[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (w[1:] != w[:-1])
    out = np.empty(len(r), np.int32)
    out[order] = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] if len(r) else 0
    return out


def dealt(docs: DataFrame, member: str, shards: int, frequent, text: str) -> DataFrame:
    """Rows of packed arrays, one for each batch and shard; equal tokens of a text are one entry with its number.

    With each text go its tokens, and with each entry of a frequent word the text's own count of it:
    the other own counts follow from the entries, which are all in one shard.
    """

    def deal(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            t = tokens(batch, text)
            keys, members = batch.column("key").to_numpy(zero_copy_only=False), flags_of(batch, member)
            common, _ = found_in(frequent.value, t.words)
            shard = ((np.where(common, pair_of(t.words, t.before), t.words) >> np.uint64(32)) % np.uint64(shards)).astype(np.int32)
            sizes, own = np.bincount(t.rows, minlength=batch.num_rows), own_counts(t.rows, t.words)
            order = np.lexsort((t.flags, t.before, t.words, t.rows, shard))
            shard, rows, words, before, flags, own, common = (x[order] for x in (shard, t.rows, t.words, t.before, t.flags, own, common))
            del t, order
            new = np.ones(len(shard), bool)
            new[1:] = (shard[1:] != shard[:-1]) | (rows[1:] != rows[:-1]) | (words[1:] != words[:-1]) | (before[1:] != before[:-1]) | (flags[1:] != flags[:-1])
            at = np.flatnonzero(new)
            n = np.diff(np.append(at, len(shard)))
            shard, rows, words, before, flags, own, common = (x[at] for x in (shard, rows, words, before, flags, own, common))
            edges = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard)).tolist()
            out = []
            for a, b in zip(edges[:-1], edges[1:]):
                first = np.flatnonzero(np.diff(rows[a:b], prepend=-1))
                text_rows, (known, where) = rows[a:b][first], np.unique(words[a:b], return_inverse=True)
                six = before[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
                packed = (keys[text_rows].tobytes(), members[text_rows].tobytes(), narrow(np.diff(np.append(first, b - a))), narrow(sizes[text_rows]), known.tobytes(), narrow(where), six.tobytes(), narrow(n[a:b]), flags[a:b].tobytes(), narrow(own[a:b][common[a:b]]))
                out.append((int(shard[a]), *packed))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary() if k else pa.int32()) for k, x in enumerate(zip(*out))], names=["shard", *PARTS])

    schema = "shard int, " + ", ".join(f"{c} binary" for c in PARTS)
    return by_batches(docs.select(text, member, text_key(text, member)), deal, schema, SLICE)


def entries(rows: list[tuple], part: int, table: np.ndarray) -> list[np.ndarray]:
    """Key, member, text size, word, pair, number, flags and own counts of the entries whose word is in this part of the shard."""
    held: list[list[np.ndarray]] = []
    for key, member, runs, size, known, at, before, number, flag, own in rows:
        n = len(before) // 6
        word, at = np.frombuffer(known, np.uint64), wide(at, n)
        common = found_in(table, word)[0][at]
        here = ((word >> np.uint64(48)) % np.uint64(CUTS) == part)[at]
        sent = np.zeros(n, np.int32)
        if common.any():
            sent[np.flatnonzero(common)] = wide(own, int(common.sum()))
        here = np.flatnonzero(here)
        k = np.frombuffer(key, np.int64)
        text = np.repeat(np.arange(len(k), dtype=np.int64), wide(runs, len(k)))[here]
        eight = np.zeros((len(here), 8), np.uint8)
        eight[:, :6] = np.frombuffer(before, np.uint8).reshape(n, 6)[here]
        short = eight.view("<u8")[:, 0]
        number, flag, at, common = wide(number, n)[here].astype(np.int32), np.frombuffer(flag, np.uint8)[here], at[here], common[here]
        # entries of one text and word, and of one text and pair, lie side by side
        new = np.ones(len(here), bool)
        new[1:] = (text[1:] != text[:-1]) | (at[1:] != at[:-1])
        mine = np.cumsum(new) - 1
        words = np.where(common, sent[here], np.bincount(mine, number, int(new.sum()))[mine] if len(here) else 0).astype(np.int32)
        new[1:] |= short[1:] != short[:-1]
        mine = np.cumsum(new) - 1
        pairs = (np.bincount(mine, number * (flag & FIRST == 0), int(new.sum()))[mine] if len(here) else np.zeros(0)).astype(np.int32)
        held.append([k[text], np.frombuffer(member, np.uint8)[text], wide(size, len(k))[text].astype(np.int32), word[at], pair_of(word[at], short), number, flag, words, pairs])
    return [np.concatenate(x) for x in zip(*held)]


def summed(rows: list[tuple], table: np.ndarray, totals: tuple[int, int], vocabulary: int, s: LmSettings) -> list[np.ndarray]:
    """Key, tokens, first tokens, loss under background and target of the texts that one shard has tokens of.

    A shard is read in ``CUTS`` parts by word, so that one part of it is expanded at a time.
    """
    return added([summed_part(entries(rows, part, table), table, totals, vocabulary, s) for part in range(CUTS)])


def summed_part(found: list[np.ndarray], table: np.ndarray, totals: tuple[int, int], vocabulary: int, s: LmSettings) -> list[np.ndarray]:
    key, member, size, word, pair, n, flag, own_word, own_pair = found
    word, of_word = np.unique(word, return_inverse=True)
    of_pair = np.unique(pair, return_inverse=True)[1]
    common, row = found_in(table, word)
    key, of_key = np.unique(key, return_inverse=True)
    first, last = flag & FIRST > 0, flag & LAST > 0
    out = [key, np.bincount(of_key, n), np.bincount(of_key, n * first)]
    for k, (mine, own) in enumerate(((n, 1), (n * member, member))):
        single = np.bincount(of_word, mine)
        single[common] = table[row[common], 1 + k]
        others = single[of_word] - own_word * own
        joint = np.bincount(of_pair, mine * ~first)[of_pair] - own_pair * own
        p = (others + s.alpha) / (totals[k] - size * own + s.alpha * vocabulary)
        loss = -np.log(np.where(first, p, joint + s.beta * p))
        loss += np.where(last, 0.0, np.log(others + s.beta))
        out.append(np.bincount(of_key, n * loss))
    return out


def added(some: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Sums of several shards as one."""
    key, at = np.unique(np.concatenate([x[0] for x in some]), return_inverse=True)
    return [key, *(np.bincount(at, np.concatenate(x)) for x in list(zip(*some))[1:])]


def sent(sums: list[np.ndarray]) -> pa.RecordBatch:
    values = [pa.array(x.astype(np.int64) if k < 3 else x) for k, x in enumerate(sums)]
    return pa.RecordBatch.from_arrays(values, names=["key", "n", "firsts", "background", "target"])


def text_sums(docs: DataFrame, member: str, s: LmSettings, text: str, scratch: Scratch) -> DataFrame:
    """(key, n, firsts, background, target) of every text that has a word, copies added up."""
    spark = docs.sparkSession
    counts = scratch.keep("words", word_counts(docs, member, text))
    vocabulary, *totals = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("m"), F.lit(0))).first()
    frequent = spark.sparkContext.broadcast(frequent_words(counts, totals[0], s))
    scratch.drop("words")
    tasks = s.spread * (1 + totals[0] // (s.spread * s.task_tokens))
    shards = tasks * (1 + totals[0] // (tasks * s.shard_tokens))

    def work(batches: Iterator[pa.RecordBatch]):
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        held: list[list[np.ndarray]] = []
        for _, same in groupby(rows, itemgetter(0)):
            held.append(summed([x[1:] for x in same], frequent.value, totals, vocabulary, s))
            if sum(len(x[0]) for x in held) > s.held_texts:
                held = [added(held)]
                if len(held[0][0]) > s.held_texts // 2:
                    yield sent(held.pop())
        if held:
            yield sent(added(held))

    packed = dealt(docs, member, shards, frequent, text).repartitionById(tasks, (F.col("shard") % tasks).cast("int")).sortWithinPartitions("shard")
    sums = by_batches(packed, work, "key long, n long, firsts long, background double, target double")
    return scratch.keep("sums", sums.groupBy("key").agg(*(F.sum(c).alias(c) for c in sums.columns[1:])))


def cross_entropy_difference(docs: DataFrame, member: str, s: LmSettings = LmSettings(), text: str = "text") -> DataFrame:
    """``docs`` (text and member left out) with n_tokens, loss_target, loss_background, score.

    Each document's own counts are left out of both models; those of its copies stay. The background is fitted on all other ``docs``, the target on those of them with ``member`` true. Null
    members are not in the target. Without any target text all target probabilities are the
    uniform ones of an empty model. A text that is null or has no word has n_tokens 0 and null
    losses and score. Repeated rows get equal values.
    """
    made = ["n_tokens", "loss_target", "loss_background", "score"]
    sums = text_sums(docs, member, s, text, Scratch(docs.sparkSession, "lm"))
    loss = sums.select(
        F.col("key").alias("text_key"),
        F.expr("n div firsts").alias("n_tokens"),
        *((F.col(c) / F.col("n")).alias(f"loss_{c}") for c in ("target", "background")),
        ((F.col("target") - F.col("background")) / F.col("n")).alias("score"),
    )
    kept = [F.col(c) for c in docs.columns if c not in (text, member, *made)]
    rows = docs.select(*kept, text_key(text, member).alias("text_key"))
    out = rows.join(small_or_shuffled(loss, loss.count(), s.broadcast_rows), "text_key", "left").drop("text_key")
    return out.withColumn("n_tokens", F.coalesce("n_tokens", F.lit(0)).cast("long"))


def labelled_target(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text and in_target: whether some label row marks the document's quality as 1."""
    docs = docs.select("doc_id", "text")
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("good_id")).distinct()
    good = small_or_shuffled(good, good.count())
    return docs.join(good, docs.doc_id == good.good_id, "left").withColumn("in_target", F.col("good_id").isNotNull()).drop("good_id")
