"""Edit-aware token counts: a segment tree of pre-token blocks for each document.

A leaf is a run of pre-tokens with its length in code points and its token count; inner nodes
hold sums. An edit descends by length to the first leaf whose pre-tokens can change, re-splits
from there until the split falls back in step with the old one, and updates the sums on the
leaf's path. Nothing else is encoded again.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm import arrowtext
from kindred.llm.trie_bpe import TrieEncoder, shipped, worker_encoder
from kindred.llm.shared import by_batches

#: Pre-tokens in a leaf.
LEAF = 64
#: Code points before an edit that a pre-token's end may depend on: its stop, and two letters after an apostrophe.
CONTEXT = 3


class TokenTree:
    def __init__(self, encoder: TrieEncoder, text: str):
        self.encoder = encoder
        self.recoded = 0
        parts = encoder.split_text(text)
        encoder.learn([p for p in parts if isinstance(p, str)])
        if encoder.v.specials and encoder.v.specials.search(text):
            counts = [self.count(p) for p in parts]
            sizes = [self.width(p) for p in parts]
        else:
            counts = [n // 4 for n in map(len, map(encoder.words.__getitem__, parts))]
            sizes = list(map(len, parts))
        cuts = range(0, max(1, len(parts)), LEAF)
        self.leaves = [parts[k : k + LEAF] for k in cuts]
        self.base = 1 << max(0, (len(self.leaves) - 1).bit_length())
        self.tokens, self.chars = [0] * (2 * self.base), [0] * (2 * self.base)
        self.tokens[self.base : self.base + len(self.leaves)] = [sum(counts[k : k + LEAF]) for k in cuts]
        self.chars[self.base : self.base + len(self.leaves)] = [sum(sizes[k : k + LEAF]) for k in cuts]
        for k in range(self.base - 1, 0, -1):
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]

    def count(self, part: str | int) -> int:
        if isinstance(part, int):
            return 1
        self.encoder.learn([part]) if part not in self.encoder.words else None
        return len(self.encoder.words[part]) // 4

    def width(self, part: str | int) -> int:
        return len(part) if isinstance(part, str) else len(self.encoder.v.bytes[part].decode())

    def written(self, part: str | int) -> str:
        return part if isinstance(part, str) else self.encoder.v.bytes[part].decode()

    @property
    def total(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.written(p) for leaf in self.leaves for p in leaf)

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds code point ``at`` (or the last one), and where it begins."""
        node, start = 1, 0
        while node < self.base:
            node *= 2
            if at >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self.base, start

    def replace(self, at: int, drop: int, put: str) -> None:
        """Replace ``drop`` code points from ``at`` on by ``put``; out of range means the text's end."""
        at = min(max(0, at), self.chars[1])
        drop = min(max(0, drop), self.chars[1] - at)
        reach = max([CONTEXT, *(len(s) for s in self.encoder.v.special)])
        first, start = self.find(max(0, at - reach))
        leaf = self.leaves[first]
        ends = list(accumulate(map(self.width, leaf), initial=start))
        keep = max(0, bisect_right(ends, max(0, at - reach)) - 2)  # one more whole pre-token as context
        if keep == 0 and first:  # the context may reach into the leaf before
            first -= 1
            while first and not self.leaves[first]:
                first -= 1
            leaf = self.leaves[first]
            start -= self.chars[self.base + first]
            ends = list(accumulate(map(self.width, leaf), initial=start))
            keep = max(0, len(leaf) - 2)
        begin = ends[keep]
        stop, taken = first, leaf[keep:]
        old = ends[-1]
        while True:
            while stop + 1 < len(self.leaves) and old < at + drop + reach:
                stop += 1
                taken += self.leaves[stop]
                old += self.chars[self.base + stop]
            body = "".join(map(self.written, taken))
            cut = at - begin
            fresh = self.encoder.split_text(body[:cut] + put + body[cut + drop :])
            if stop + 1 >= len(self.leaves):
                tail, done = [], len(fresh)
                break
            shift = len(put) - drop
            olds = {x: k for k, x in enumerate(accumulate(map(self.width, taken), initial=begin)) if x >= at + drop + 1}
            where, joint = begin, None
            for k, p in enumerate(fresh):
                if where >= at + len(put) + 1 and where - shift in olds and olds[where - shift] < len(taken) - 1:
                    joint = (k, olds[where - shift])
                    break
                where += self.width(p)
            if joint:
                done, tail = joint[0], taken[joint[1] :]
                break
            stop += 1  # not yet in step with the old split: read one leaf more
            taken += self.leaves[stop]
            old += self.chars[self.base + stop]
        self.recoded += done
        self.leaves[first] = leaf[:keep] + fresh[:done] + tail
        for k in range(first + 1, stop + 1):
            self.leaves[k] = []
        for k in range(first, stop + 1):
            node = self.base + k
            self.tokens[node] = sum(map(self.count, self.leaves[k]))
            self.chars[node] = sum(map(self.width, self.leaves[k]))
            while node > 1:
                node //= 2
                self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]
                self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]


EDIT = "array<struct<at:bigint,drop:bigint,put:string>>"


def planned_edits(text):
    """The query's edits of each text: seven code points go after the first third, a phrase comes in after the second."""
    size = F.char_length(F.coalesce(text, F.lit("")))
    edit = lambda at, drop, put: F.struct(at.cast("bigint").alias("at"), F.lit(drop).cast("bigint").alias("drop"), F.lit(put).alias("put"))
    return F.array(edit(F.floor(size / 3), 7, ""), edit(F.floor(size * 2 / 3), 0, " it's edited 42 times"))


def edited_counts(docs: DataFrame, vocabulary: str, edits: str = "edits", text: str = "text") -> DataFrame:
    """``docs`` (text left out) with n_tokens, n_tokens_edited, n_pretokens, n_recoded.

    ``edits`` is a column of type array<struct<at, drop, put>>, applied in order, positions in
    code points of the text as edited so far. A null text is empty; null edits or fields count as
    none, 0 or "". Nothing is shuffled, and a row depends on itself alone.
    """
    key, held = shipped(docs.sparkSession, vocabulary)
    made = ["n_tokens", "n_tokens_edited", "n_pretokens", "n_recoded"]
    kept = [c for c in docs.columns if c not in (text, edits, *made)]
    fields = [docs.schema[c] for c in kept] + [T.StructField(c, T.LongType()) for c in made]
    docs = docs.withColumn(edits, F.col(edits).cast(EDIT))

    def work(batches):
        encoder = worker_encoder(key, held.value)
        for batch in batches:
            for part, _, _ in arrowtext.pieces(batch, text):
                rows = []
                for t, changes in zip(part.column(text).to_pylist(), part.column(edits).to_pylist()):
                    tree = TokenTree(encoder, t or "")
                    before, parts = tree.total, sum(map(len, tree.leaves))
                    for c in changes or []:
                        if c:
                            tree.replace(c["at"] or 0, c["drop"] or 0, c["put"] or "")
                    rows.append((before, tree.total, parts, tree.recoded))
                cols = [part.column(c) for c in kept] + [pa.array(x, pa.int64()) for x in zip(*rows)]
                yield pa.RecordBatch.from_arrays(cols, names=kept + made)

    return by_batches(docs, work, T.StructType(fields))
