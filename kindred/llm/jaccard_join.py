"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct word shingles (64-bit hashes). Sets are dealt into bands
of size. Two sets of Jaccard similarity t or more, the larger of size s, differ in at most
k = 2 (1 - t) / (1 + t) s elements. The domain of shingles is hashed into n1 first-level
partitions; in one of them the two sets differ in at most ``k2`` elements. That partition is
hashed into n2 parts, and all subsets of n2 - k2 parts are enumerated: on one of them the sets
agree. A signature is the band, the partition, the subset, and the hash of the set's elements
there, so that similar sets of a band share one at least. A set signs for its own band and for
each band that a similar larger set may be in.

Steps: (1) documents of equal sets form classes, and only each class's least document goes on;
(2) rows (signature, document) meet by signature. Rows of one batch that share a signature make a
star around the least document, and only that hub goes on to meet the hubs of other batches, which
make a star in turn: a bucket of m rows makes m - 1 pairs, no task reads more rows of it than there
are batches, and no hub has more pairs than that; (3) each document is verified against the hub
that it meets most often, exactly, on the whole sets; (4) pairs with the other hubs, where the
components found so far still differ; (5) within buckets that still hold several components, the
pairs across them. For (5) each document has a sketch, its shingles counted in cells, about half as
many as there are shingles: the L1 distance of two sketches is no more than the sets' difference,
so that pairs whose sketches are too far apart are no links. Buckets of (5) are cut into blocks of
bounded size, and each pair of blocks is a unit of work of its own, on sketches folded to
``FOLDED`` cells; what these allow is tested on the full sketches, as are the pairs of (3) and (4),
before any text is fetched. Every link is then in some verified pair or joins two documents that
verified links connect already, so the components are exact.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import arrowtext
from kindred.llm.components import components
from kindred.llm.shared import Scratch, by_batches, join_heavy, small_or_shuffled


@dataclass(frozen=True)
class JaccardSettings:
    """``percent`` of the union must be shared. ``ratio``: a band's largest size over its smallest."""

    width: int = 5
    percent: int = 80
    ratio: float = 1.3
    spared: int = 1
    parts: int = 3


class Bands:
    """Sizes by band, and for each band the difference bound and first-level partitions."""

    def __init__(self, s: JaccardSettings):
        self.s = s
        self.high = [1]
        while self.high[-1] < 1 << 40:
            self.high.append(max(self.high[-1] + 1, int(self.high[-1] * s.ratio)))
        self.subsets = list(combinations(range(s.parts), s.parts - s.spared))

    def of(self, size: int) -> int:
        return int(np.searchsorted(self.high, size))

    def range(self, size: int) -> range:
        """Bands of the sets that are as large or larger and may be similar."""
        return range(self.of(size), self.of(size * 100 // self.s.percent) + 1)

    def bound(self, band: int) -> int:
        """Elements in which similar sets differ at most, if the larger one is in this band."""
        p = self.s.percent
        return 2 * (100 - p) * self.high[band] // (100 + p)

    def signatures(self, held: np.ndarray) -> np.ndarray:
        """Signatures of a set for all its bands. Where no difference is allowed there are none: equal sets are one class."""
        out, n2 = [], self.s.parts
        with np.errstate(over="ignore"):
            spread = arrowtext.mix(held ^ np.uint64(0x5851F42D4C957F2D))
            for band in self.range(len(held)):
                k = self.bound(band)
                if k < 1:
                    continue
                n1 = -(-(k + 1) // (self.s.spared + 1))
                cell = (spread % np.uint64(n1 * n2)).astype(np.int64)
                order = np.argsort(cell, kind="stable")
                sums = np.zeros(len(held) + 1, np.uint64)
                np.cumsum(held[order], out=sums[1:])
                cuts = np.searchsorted(cell[order], np.arange(n1 * n2 + 1))
                part = arrowtext.mix(sums[cuts[1:]] - sums[cuts[:-1]] + np.diff(cuts).astype(np.uint64)).reshape(n1, n2)
                name = arrowtext.mix(np.arange(n1, dtype=np.uint64) + (np.uint64(band) << np.uint64(40)))
                for j, subset in enumerate(self.subsets):
                    key = name + np.uint64(j + 1) * arrowtext.STEP
                    for c in subset:
                        key = arrowtext.mix(key ^ part[:, c])
                    out.append(key)
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def set_keys(docs: DataFrame, s: JaccardSettings, id_column: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, key_a, key_b): the set's size and a 128-bit hash of it."""

    def work(batches):
        for batch in batches:
            for part, data, offsets in arrowtext.pieces(batch, text):
                sets = arrowtext.shingle_sets(arrowtext.words(data, offsets), s.width)
                with np.errstate(over="ignore"):
                    a = np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64)
                    b = np.array([arrowtext.mix(x + arrowtext.STEP).sum(dtype=np.uint64) for x in sets], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(id_column), pa.array([len(x) for x in sets], pa.int64()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["doc_id", "n_shingles", "key_a", "key_b"])

    return by_batches(docs.select(F.col(id_column).cast("long").alias(id_column), text), work, "doc_id long, n_shingles long, key_a long, key_b long")


#: Bytes of text that are signed together: a text makes several times its size in signatures.
SIGNED = 4 << 20


def signature_rows(docs: DataFrame, s: JaccardSettings, id_column: str, text: str) -> DataFrame:
    """(signature, hub, doc_id): within a batch a signature's least document has no hub yet, the others have that one."""

    def work(batches):
        bands = Bands(s)
        for batch in batches:
            signed, owners = [], []
            for part, data, offsets in arrowtext.pieces(batch, text):
                ids = part.column(id_column).to_numpy(zero_copy_only=False)
                made = [bands.signatures(x) for x in arrowtext.shingle_sets(arrowtext.words(data, offsets), s.width)]
                signed += made
                owners.append(np.repeat(ids, [len(x) for x in made]))
            if not signed:
                continue
            sig, doc = np.concatenate(signed), np.concatenate(owners).astype(np.int64)
            order = np.lexsort((doc, sig))
            sig, doc = sig[order].view(np.int64), doc[order]
            first = np.ones(len(sig), bool)
            first[1:] = sig[1:] != sig[:-1]
            hub = doc[first][np.cumsum(first) - 1] if len(sig) else doc
            kept = first | (doc != hub)
            yield pa.RecordBatch.from_arrays([pa.array(sig[kept]), pa.array(hub[kept], mask=first[kept]), pa.array(doc[kept])], names=["signature", "hub", "doc_id"])

    return by_batches(docs.select(F.col(id_column).cast("long").alias(id_column), text), work, "signature long, hub long, doc_id long", SIGNED)


def stars(rows: DataFrame) -> DataFrame:
    """(signature, hub, doc_id): rows with a hub as they are; of the others each but the least document of its signature.

    A stream of sorted rows; those that have a hub are dealt out by document.
    """

    def work(batches):
        last, least = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            done = batch.column("hub").is_valid().to_numpy(zero_copy_only=False)
            if done.any():
                yield batch.filter(pa.array(done))
            sig, doc = (batch.column(c).to_numpy(zero_copy_only=False)[~done] for c in ("signature", "doc_id"))
            if not len(sig):
                continue
            new = np.ones(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            new[0] = sig[0] != last
            begin = np.flatnonzero(new)
            hubs = np.full(len(sig), least if least is not None else 0, np.int64)
            if len(begin):
                hubs[begin[0] :] = np.repeat(doc[begin], np.diff([*begin, len(sig)]))
            last, least = sig[-1], hubs[-1]
            kept = ~new & (doc != hubs)
            if kept.any():
                yield pa.RecordBatch.from_arrays([pa.array(sig[kept]), pa.array(hubs[kept]), pa.array(doc[kept])], names=["signature", "hub", "doc_id"])

    dealt = rows.repartition(F.when(F.col("hub").isNull(), F.col("signature")).otherwise(F.xxhash64("doc_id")))
    return by_batches(dealt.sortWithinPartitions("signature", "doc_id"), work, "signature long, hub long, doc_id long")


#: A sketch has cells in a power of two within these bounds.
LEAST_CELLS, MOST_CELLS = 256, 4096
#: Rows of a block at most; rows from which a bucket is cut, into eight blocks at first; cells of the sketches that blocks are compared by.
BLOCK, WHOLE, FOLDED = 8192, 256, 256
#: Signatures that a row of a block brings along, so that a pair that meets in several buckets is given once.
LEAST = 32


def sketch(held: np.ndarray) -> bytes:
    bits = min(MOST_CELLS, max(LEAST_CELLS, len(held) // 2)).bit_length() - 1
    return np.minimum(255, np.bincount((held >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)).astype(np.uint8).tobytes()


def folded(held: list[bytes], cells: int) -> np.ndarray:
    """Sketches of one size as rows of fewer cells: neighbours are added up, which keeps the bound."""
    grid = np.frombuffer(b"".join(held), np.uint8).reshape(len(held), -1)
    return grid if grid.shape[1] == cells else np.minimum(255, grid.reshape(len(held), cells, -1).sum(axis=2)).astype(np.uint8)


def spread(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (np.maximum(a, b) - np.minimum(a, b)).sum(axis=1, dtype=np.int64)


def distances(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """L1 distances of sketches pair by pair, each at the smaller one's size."""
    sizes = np.array([[len(x) for x in a], [len(x) for x in b]])
    out = np.zeros(len(a), np.int64)
    for x, y in np.unique(sizes, axis=1).T.tolist():
        rows = np.flatnonzero((sizes[0] == x) & (sizes[1] == y))
        for k in range(0, len(rows), 2048):
            some = rows[k : k + 2048]
            out[some] = spread(folded([a[r] for r in some], min(x, y)), folded([b[r] for r in some], min(x, y)))
    return out


def sketches(texts: DataFrame, s: JaccardSettings) -> DataFrame:
    """(doc_id, n, sketch): set size and shingle counts by cell, at most 255 in a cell, which keeps the bound."""

    def work(batches):
        for batch in batches:
            for part, data, offsets in arrowtext.pieces(batch, "text"):
                sets = arrowtext.shingle_sets(arrowtext.words(data, offsets), s.width)
                made = [sketch(x) for x in sets]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(made, pa.binary())], names=["doc_id", "n", "sketch"])

    return by_batches(texts.select("doc_id", "text"), work, "doc_id long, n long, sketch binary")


def plausible(pairs: DataFrame, drawn: DataFrame, s: JaccardSettings) -> DataFrame:
    """The pairs (a, b, shared) whose sizes and sketches allow a link."""
    a, b = (drawn.toDF(c, f"n_{c}", f"sketch_{c}") for c in "ab")

    def work(batches):
        for batch in batches:
            if batch.num_rows:
                na, nb = (batch.column(f"n_{c}").to_numpy(zero_copy_only=False) for c in "ab")
                apart = distances(*(batch.column(f"sketch_{c}").to_pylist() for c in "ab"))
                yield batch.select(["a", "b", "shared"]).filter(pa.array(allowed(na, nb, apart, s)))

    return by_batches(pairs.join(a, "a").join(b, "b").select("a", "b", "shared", "n_a", "sketch_a", "n_b", "sketch_b"), work, "a long, b long, shared long").groupBy("a", "b").agg(F.max("shared").alias("shared"))


def folded_to(drawn: DataFrame, cells: int) -> DataFrame:
    """Sketches of no more than ``cells`` cells."""

    def work(batches):
        for batch in batches:
            held = [x if len(x) <= cells else folded([x], cells).tobytes() for x in batch.column("sketch").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n"), pa.array(held, pa.binary())], names=["doc_id", "n", "sketch"])

    return by_batches(drawn, work, "doc_id long, n long, sketch binary")


def allowed(na: np.ndarray, nb: np.ndarray, apart: np.ndarray, s: JaccardSettings) -> np.ndarray:
    """Whether sets of these sizes and sketch distances may be similar enough: a necessary condition."""
    total = na + nb
    least = -(-s.percent * total // (100 + s.percent))  # shared shingles that a link needs
    return (apart <= total - 2 * least) & (100 * np.minimum(na, nb) >= s.percent * np.maximum(na, nb))


def near_pairs(members: DataFrame, s: JaccardSettings) -> DataFrame:
    """Pairs (a, b) across components within each block pair of a bucket that sizes and sketches allow; pairs with a document's own hub are known.

    ``least`` has a document's least signatures in open buckets. A pair is given in the bucket of the
    least signature that both lists have, for all smaller ones are in the lists too; if they share none,
    in each bucket where it meets.
    """

    def pairs_of(rows: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        whole = pa.Table.from_batches(rows).combine_chunks()
        get = lambda c: whole.column(c).to_numpy()
        doc, hub, comp, n, block = get("doc_id"), get("hub"), get("component"), get("n"), get("block")
        drawn, signature = whole.column("sketch").to_pylist(), whole.column("signature")[0].as_py()
        listed = whole.column("least").combine_chunks()
        listed, starts = listed.flatten().to_numpy(), np.concatenate([[0], np.cumsum(listed.value_lengths().to_numpy())])
        owner, below = np.repeat(np.arange(len(doc)), np.diff(starts)), listed < signature
        listed, at = listed[below], np.searchsorted(owner[below], np.arange(len(doc) + 1))
        cells = min(map(len, drawn))
        grid = np.concatenate([folded([x], cells) for x in drawn])
        same = whole.column("low")[0].as_py() == whole.column("high")[0].as_py()
        left = np.arange(len(doc)) if same else np.flatnonzero(block == whole.column("low")[0].as_py())
        right = left if same else np.flatnonzero(block == whole.column("high")[0].as_py())
        found = []
        for i in left.tolist():
            to = right[right > i] if same else right
            to = to[(comp[to] != comp[i]) & (hub[to] != doc[i]) & (hub[i] != doc[to])]
            small, large = np.minimum(n[to], n[i]), np.maximum(n[to], n[i])
            to = to[100 * small >= s.percent * large]
            if len(to):
                to = to[allowed(n[to], n[i], spread(grid[to], grid[i]), s)]
                if len(to) and at[i] < at[i + 1]:
                    mine = set(listed[at[i] : at[i + 1]].tolist())
                    to = to[[mine.isdisjoint(listed[at[j] : at[j + 1]].tolist()) for j in to.tolist()]]
                if len(to):
                    found.append(np.stack([np.minimum(doc[to], doc[i]), np.maximum(doc[to], doc[i])]))
        if not found:
            return None
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def work(batches):
        held, name = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("signature", "low", "high")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                key = tuple(keys[:, x].tolist())
                if key != name and held:
                    out = pairs_of(held)
                    if out is not None:
                        yield out
                    held = []
                name = key
                held.append(batch.slice(x, y - x))
        if held and (out := pairs_of(held)) is not None:
            yield out

    return by_batches(members.repartition("signature", "low", "high").sortWithinPartitions("signature", "low", "high"), work, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, s: JaccardSettings) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough. ``texts``: (doc_id, text); only those of the pairs are dealt out."""
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = texts.join(small_or_shuffled(ids, ids.count()), "doc_id", "left_semi")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    # the smaller side of a star is its hub: members bring their own text once, and hubs repeat in the join
    both = pairs.join(right, "b").join(left, "a").sortWithinPartitions("a")

    def work(batches):
        known, mine = None, None
        for batch in batches:
            for part, data, offsets in arrowtext.pieces(batch, "text_b"):
                theirs = arrowtext.shingle_sets(arrowtext.words(data, offsets), s.width)
                keep = np.zeros(len(theirs), bool)
                for k, (own, other) in enumerate(zip(part.column("text_a"), theirs)):
                    if known is None or not own.equals(known):  # an id may have rows of several texts
                        known, mine = own, arrowtext.shingle_sets(arrowtext.words(*arrowtext.flat(part.column("text_a").slice(k, 1))), s.width)[0]
                    if 100 * min(len(mine), len(other)) < s.percent * max(len(mine), len(other)):
                        continue
                    shared = len(mine) + len(other) - len(np.union1d(mine, other))
                    keep[k] = shared > 0 and 100 * shared >= s.percent * (len(mine) + len(other) - shared)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return by_batches(both.select("a", "b", "text_a", "text_b"), work, "a long, b long")


def joined(found: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Components (id, component) with further links; as they are if there is none."""
    if not links.limit(1).count():
        return found
    return components(found.select(F.col("component").alias("a"), F.col("id").alias("b")).unionByName(links), scratch, name)


def jaccard_components(docs: DataFrame, s: JaccardSettings = JaccardSettings(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    A null or word-less text has an empty set, size 0, and is linked with nothing. Repeated ids
    are taken as documents of one id: their rows each get the row's set size and one component. A
    null id takes no part in links; its component is null. Other columns are not used.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    keys = scratch.keep("keys", set_keys(source, s, "doc_id", "text"))
    by = ["key_a", "key_b", "n_shingles"]
    named = keys.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = scratch.keep("classes", named.groupBy(by).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).where("copies > 1"))
    most = classes.agg(F.coalesce(F.max("copies"), F.lit(0))).first()[0]
    copies = scratch.keep("copies", join_heavy(named, classes.drop("copies"), by, most).select("doc_id", "rep").distinct())
    # an id goes no further if each of its rows is a copy of another document
    other = named.join(copies.where("doc_id != rep").select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.count_distinct(*by).alias("sets"))
    copied = copies.where("doc_id != rep").groupBy("doc_id").agg(F.count("*").alias("found"))
    dull = scratch.keep("dull", copied.join(other, "doc_id").where("found >= sets").select("doc_id"))
    n_dull = dull.count()
    single = source.where("doc_id IS NOT NULL").join(small_or_shuffled(dull, n_dull), "doc_id", "left_anti")
    met = scratch.keep("met", stars(signature_rows(single, s, "doc_id", "text")))
    pairs = scratch.keep("pairs", met.groupBy("hub", "doc_id").agg(F.count("*").alias("shared")).select(F.col("hub").alias("a"), F.col("doc_id").alias("b"), "shared"))
    ids = scratch.keep("ids", pairs.select("a").union(pairs.select("b")).distinct().toDF("doc_id"))
    texts = single.join(small_or_shuffled(ids, ids.count()), "doc_id", "left_semi")
    drawn = scratch.keep("sketches", sketches(texts, s).distinct())
    pairs = scratch.keep("near", plausible(pairs, drawn, s))

    # an id with rows of several sets connects their classes
    lead = copies.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a != last").drop("last")
    twice = copies.join(lead, "doc_id").where("rep != a").select("a", F.col("rep").alias("b"))
    twice = twice.unionByName(copies.where("doc_id != rep").join(small_or_shuffled(dull, n_dull), "doc_id", "left_anti").select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))

    best = pairs.groupBy("b").agg(F.max(F.struct("shared", (-F.col("a")).alias("m"))).alias("top")).select((-F.col("top.m")).alias("a"), "b")
    best = scratch.keep("best", best)
    links = scratch.keep("links-1", verified(best, single, s).unionByName(twice.distinct()))
    found = components(links, scratch, "first")

    def apart(candidates: DataFrame, known: DataFrame) -> DataFrame:
        """Candidate pairs whose components differ."""
        a, b = known.select(F.col("id").alias("a"), F.col("component").alias("ca")), known.select(F.col("id").alias("b"), F.col("component").alias("cb"))
        return candidates.join(a, "a", "left").join(b, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")

    rest = pairs.select("a", "b").join(best, ["a", "b"], "left_anti")
    found = joined(found, scratch.keep("links-2", verified(scratch.keep("rest", apart(rest, found)), single, s)), scratch, "second")

    # buckets that still hold several components: pairs across them that are not with the hub
    known = found.select(F.col("id").alias("doc_id"), "component")
    rows = met.unionByName(met.select("signature", "hub", F.col("hub").alias("doc_id")).distinct())
    rows = rows.groupBy("signature", "doc_id").agg(F.min("hub").alias("hub"))  # a hub among hubs belongs to the least of them
    member = rows.join(known, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    open_ = member.groupBy("signature").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("m")).where("x != y AND m > 2")
    member = scratch.keep("open", member.join(open_.select("signature", "m"), "signature"))
    parts = F.greatest(F.ceil(F.col("m") / BLOCK), F.least(F.lit(8), F.ceil(F.col("m") / WHOLE))).cast("int")
    least = member.groupBy("doc_id").agg(F.slice(F.sort_array(F.collect_list("signature")), 1, LEAST).alias("least"))
    member = member.join(folded_to(drawn, FOLDED).join(least, "doc_id"), "doc_id").withColumn("block", F.pmod(F.xxhash64("doc_id"), parts).cast("int"))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    member = member.select("signature", "doc_id", "hub", "component", "n", "sketch", "least", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    member = member.withColumn("least", F.filter("least", lambda x: x < F.col("signature")))  # those that can give a pair before this bucket
    across = near_pairs(member, s).distinct().withColumn("shared", F.lit(0).cast("long"))
    across = scratch.keep("across", plausible(across, drawn, s).select("a", "b"))
    found = scratch.keep("found", joined(found, scratch.keep("links-3", verified(across, single, s)), scratch, "third"))
    scratch.drop("met", "pairs", "ids", "near", "best", "rest", "open", "sketches", "across", "links-1", "links-2", "links-3", "dull", "copies")

    # rows of a class follow its least document, rows without a copy their own
    found = found.select(F.col("id").alias("rep"), "component")
    classes = classes.join(found, "rep", "left").withColumn("shared", F.coalesce("component", "rep")).select(*by, "shared")
    rows = keys.withColumn("set", F.when(F.col("n_shingles") > 0, F.col("doc_id")).isNotNull())
    linked = join_heavy(rows.where("set"), classes, by, most, "left")
    rows = linked.unionByName(rows.where("NOT set").withColumn("shared", F.lit(None).cast("long")))
    rows = rows.join(found, rows.doc_id == found.rep, "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("shared", "component", "doc_id").alias("component_id"))
