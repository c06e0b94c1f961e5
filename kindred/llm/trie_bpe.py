"""Byte-level BPE encoding by prefix-sharing trie traversal, and decoding.

The distinct words of a piece of text form a trie. It is walked depth first (in sorted order,
keeping the states of the current path): each node has one state, the last token of the
encoding of the bytes from the root to it. That token is the one suffix token that may stand
after the last token of what precedes it, that is, whose joint encoding is just the two.
States of a shared prefix are computed once, and a word's ids follow by walking its states
from the end. Encoded words stay in a bounded cache of the worker.

Special tokens are matched in the text before anything else, as the library does by default.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex

from pyspark.sql import DataFrame, SparkSession

from kindred.llm import arrowtext
from kindred.llm.shared import by_batches

#: The split pattern of the vocabulary's family. White space is the Unicode property.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"

#: Encoded words that a worker keeps between pieces.
CACHE = 800_000


def byte_letters() -> dict[str, int]:
    """The letters by which such vocabularies write bytes: printable ones as they are, others from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(moved)}


class Vocabulary:
    """Tokens, merge ranks and special tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, text: str):
        held = json.loads(text)
        letters = byte_letters()
        raw = lambda s: bytes(map(letters.__getitem__, s))
        self.special = {x["content"]: x["id"] for x in held["added_tokens"]}
        self.token = {raw(s): i for s, i in held["model"]["vocab"].items() if s not in self.special}
        self.bytes = [b""] * (1 + max([*self.token.values(), *self.special.values()]))
        for b, i in self.token.items():
            self.bytes[i] = b
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.longest = max(map(len, self.token))
        self.merge = {}
        #: For each token the rank and the two parts of the one merge that makes it; bytes have none.
        self.made: dict[int, tuple[int, int, int]] = {self.token[bytes((b,))]: (-1, -1, -1) for b in range(256) if bytes((b,)) in self.token}
        self.several: set[int] = set()
        for rank, pair in enumerate(held["model"]["merges"]):
            a, b = (self.token[raw(s)] for s in (pair if isinstance(pair, list) else pair.split(" ")))
            whole = self.token[self.bytes[a] + self.bytes[b]]
            self.merge[a, b] = (rank, whole)
            if self.made.setdefault(whole, (rank, a, b)) != (rank, a, b):
                self.several.add(whole)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    @staticmethod
    def load(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            return Vocabulary(f.read())


class TrieEncoder:
    def __init__(self, vocabulary: Vocabulary, cache: int = CACHE):
        self.v = vocabulary
        self.split = regex.compile(SPLIT).findall
        self.words: dict[str, bytes] = {}
        self.room = cache
        self.adjoins: dict[tuple[int, int], bool] = {}
        self.states = 0

    def plain(self, word: bytes) -> list[int]:
        """BPE as defined: the lowest-ranked adjacent pair is merged until there is none."""
        ids = [self.v.token[bytes((b,))] for b in word]
        merge = self.v.merge
        while len(ids) > 1:
            found = min(((merge[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in merge), default=None)
            if not found:
                break
            k = found[1]
            ids[k : k + 2] = [merge[ids[k], ids[k + 1]][1]]
        return ids

    def may_follow(self, left: int, right: int) -> bool:
        known = self.adjoins.get((left, right))
        if known is None:
            if len(self.adjoins) > 2_000_000:
                self.adjoins.clear()
            known = self.adjoins[left, right] = self.stand_apart(left, right)
        return known

    def stand_apart(self, left: int, right: int) -> bool:
        """Whether the joint encoding of two tokens is just the two.

        Their last merges are undone, the later one first, until only bytes touch at the seam. The
        tokens stand apart if no two parts that touch there merge before the part that was undone
        was made. Of equal ranks the merge further left comes first. Tokens that several merges
        make, or none, are encoded in full instead.
        """
        made, merge, several = self.v.made, self.v.merge, self.v.several
        a, b, before = left, right, len(merge) + 1  # a merge at the seam comes first if its rank is below ``before``
        while True:
            if several and (a in several or b in several) or a not in made or b not in made:
                return self.plain(self.v.bytes[left] + self.v.bytes[right]) == [left, right]
            seam = merge.get((a, b))
            if seam and seam[0] < before:
                return False
            (rank_a, _, inner_a), (rank_b, inner_b, _) = made[a], made[b]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a > rank_b:
                a, before = inner_a, rank_a
            else:
                b, before = inner_b, rank_b + 1

    def walk(self, fresh: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Encode distinct words: the depth-first traversal of their trie."""
        token, longest, size = self.v.token, self.v.longest, self.v.bytes
        last: list[int] = [-1]  # last[i]: state of the node at depth i of the current path
        path = b""
        for word, raw in sorted(((w, w.encode()) for w in fresh), key=lambda x: x[1]):
            shared, most = 0, min(len(path), len(raw), len(last) - 1)
            while shared < most and path[shared] == raw[shared]:
                shared += 1
            del last[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                for start in range(max(0, end - longest), end):
                    t = token.get(raw[start:end])
                    if t is not None and (not start or self.may_follow(last[start], t)):
                        last.append(t)
                        break
            self.states += len(raw) - shared
            path, at, ids = raw, len(raw), []
            while at:
                ids.append(last[at])
                at -= len(size[last[at]])
            yield word, array("I", reversed(ids)).tobytes()

    def learn(self, found: Iterable[str]) -> None:
        """Make sure that the cache holds all of ``found``."""
        fresh = set(found).difference(self.words)
        if fresh and len(self.words) + len(fresh) > self.room:
            self.words.clear()
            fresh = set(found)
        self.words.update(self.walk(fresh))

    def split_text(self, text: str) -> list[str | int]:
        """Pre-tokens of a text; a special token stands as its id."""
        if self.v.specials is None or not self.v.specials.search(text):
            return self.split(text)
        out: list[str | int] = []
        for part in self.v.specials.split(text):
            if part in self.v.special:
                out.append(self.v.special[part])
            else:
                out += self.split(part)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self.split_text(t) for t in texts]
        mixed = [any(isinstance(x, int) for x in p) if self.v.specials and self.v.specials.search(t) else False for p, t in zip(parts, texts)]
        distinct: set[str] = set()
        for p, odd in zip(parts, mixed):
            distinct.update([x for x in p if not isinstance(x, int)] if odd else p)
        self.learn(distinct)
        get = self.words.__getitem__
        return [b"".join([get(x) if isinstance(x, str) else x.to_bytes(4, "little") for x in p]) if odd else b"".join(map(get, p)) for p, odd in zip(parts, mixed)]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 bytes of the text that ids stand for; invalid sequences become U+FFFD."""
        held = b"".join(map(self.v.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return held.decode("utf-8", "replace").encode()


#: One encoder for each vocabulary and Python worker.
_encoders: dict[str, TrieEncoder] = {}


def worker_encoder(key: str, text: str) -> TrieEncoder:
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TrieEncoder(Vocabulary(text))
    return _encoders[key]


def shipped(spark: SparkSession, path: str) -> tuple[str, object]:
    """The vocabulary file's text as a broadcast (of fixed size), with a key for it."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return hashlib.sha256(text.encode()).hexdigest(), spark.sparkContext.broadcast(text)


def encode_decode(docs: DataFrame, vocabulary: str, text: str = "text", ids: bool = False) -> DataFrame:
    """``docs`` with the columns n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    A null text counts as empty: no tokens, and the digests of nothing. Columns of the input
    other than these names stay; nothing is shuffled.
    """
    key, held = shipped(docs.sparkSession, vocabulary)
    made = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * ids
    kept = [c for c in docs.columns if c not in made]

    def work(batches):
        encoder = worker_encoder(key, held.value)
        for batch in batches:
            for part, _, _ in arrowtext.pieces(batch, text):
                texts = [t or "" for t in part.column(text).to_pylist()]
                coded = encoder.encode(texts)
                plain = [encoder.decode(c) for c in coded]
                out = {c: part.column(c) for c in kept}
                out |= {
                    "n_tokens": pa.array([len(c) // 4 for c in coded], pa.int64()),
                    "ids_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                    "decoded_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in plain]),
                }
                if ids:
                    out |= {"ids": pa.array([np.frombuffer(c, "<u4").astype(np.int64).tolist() for c in coded], pa.list_(pa.int64())), "decoded": pa.array([p.decode() for p in plain], pa.string())}
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    from pyspark.sql import types as T

    fields = [docs.schema[c] for c in kept] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if ids:
        fields += [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.StringType())]
    return by_batches(docs, work, T.StructType(fields))
