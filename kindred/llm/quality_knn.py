"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's features are its words, words right after themselves, and the 2- to 4-byte windows of its character classes, hashed
into a fixed number of cells, weighted by log(1 + tf) * idf; words and
classes are each scaled to length 1. A singular
value decomposition of a bounded, documented sample of labelled rows gives the latent space. The
sample's vectors and labels are broadcast (sample x dim floats at most); each text's exact
cosines to all of them are computed in blocks, and its nearest ones vote by similarity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm import arrowtext
from kindred.llm.shared import by_batches


@dataclass(frozen=True)
class KnnSettings:
    sample: int = 4000
    word_cells: int = 1 << 12
    class_cells: int = 1 << 12
    dim: int = 64
    neighbours: int = 25
    cut: float = 0.7
    seed: int = 11


#: Character classes: capitals, other letters, digits, white space and line feed; every other byte is its own.
CLASS = np.arange(256, dtype=np.uint8)
CLASS[65:91] = 65
CLASS[97:123] = 97
CLASS[128:] = 97
CLASS[48:58] = 48
CLASS[[9, 11, 12, 13]] = 32


def features(data: np.ndarray, offsets: np.ndarray, s: KnnSettings) -> np.ndarray:
    """Feature counts: texts x cells, float32."""
    n, width = len(offsets) - 1, s.word_cells + s.class_cells
    found = arrowtext.words(data, offsets)
    cells = [(found.hashes & np.uint64(s.word_cells - 1)).astype(np.int64)]
    owners = [found.texts]
    again = np.flatnonzero(found.hashes[1:] == found.hashes[:-1]) + 1
    again = again[owners[0][again] == owners[0][again - 1]]
    cells.append(np.full(len(again), s.word_cells))  # a word right after itself
    owners.append(owners[0][again])
    sums = arrowtext.prefix_hash(CLASS[data])
    owner = np.repeat(np.arange(n), np.diff(offsets))
    for size in (2, 3, 4):
        at = np.arange(max(0, len(data) - size + 1))
        if len(at):
            at = at[owner[at] == owner[at + size - 1]]
        h = arrowtext.range_hash(sums, at, at + size) + np.uint64(size)
        cells.append(s.word_cells + (h & np.uint64(s.class_cells - 1)).astype(np.int64))
        owners.append(owner[at])
    out = np.bincount(np.concatenate(owners) * width + np.concatenate(cells), minlength=n * width)
    return out.reshape(n, width).astype(np.float32)


def vectors(data: np.ndarray, offsets: np.ndarray, idf: np.ndarray, basis: np.ndarray | None, s: KnnSettings) -> np.ndarray:
    counts = features(data, offsets, s)
    np.log1p(counts, out=counts)
    counts *= idf
    for part in (counts[:, : s.word_cells], counts[:, s.word_cells :]):
        part /= np.maximum(1e-12, np.linalg.norm(part, axis=1, keepdims=True))
    if basis is None:
        return counts
    out = counts @ basis
    return out / np.maximum(1e-12, np.linalg.norm(out, axis=1, keepdims=True))


def blocks(texts: list[str], size: int = 64):
    for k in range(0, len(texts), size):
        yield arrowtext.flat(pa.array(texts[k : k + size], pa.string()))


class Sparse:
    """The sample's rows as their non-zero cells, block by block: the driver never holds them all in full."""

    def __init__(self, width: int):
        self.width = width
        self.held: list[tuple[int, np.ndarray, np.ndarray]] = []

    def add(self, rows: np.ndarray) -> None:
        at = np.flatnonzero(rows)
        self.held.append((len(rows), at.astype(np.int32), rows.ravel()[at]))

    def __iter__(self):
        for n, at, values in self.held:
            rows = np.zeros(n * self.width, np.float32)
            rows[at] = values
            yield rows.reshape(n, self.width)

    def times(self, y: np.ndarray) -> np.ndarray:
        """The rows times ``y``."""
        return np.concatenate([rows @ y for rows in self])

    def across(self, y: np.ndarray) -> np.ndarray:
        """The rows, transposed, times ``y``."""
        out, first = np.zeros((self.width, y.shape[1]), np.float32), 0
        for rows in self:
            out += rows.T @ y[first : first + len(rows)]
            first += len(rows)
        return out


def fit(texts: list[str], labels: list[int], s: KnnSettings = KnnSettings()) -> dict:
    """Latent basis, idf, and the sample's distinct vectors with their numbers and mean labels; without a sample no vectors."""
    width = s.word_cells + s.class_cells
    if not texts:
        return {"idf": np.ones(width, np.float32), "basis": np.zeros((width, 1), np.float32), "vectors": np.zeros((0, 1), np.float32), "labels": np.zeros(0), "counts": np.zeros(0), "prior": 0.5}
    df = sum((features(d, o, s) > 0).sum(axis=0) for d, o in blocks(texts))
    idf = np.log((1 + len(texts)) / (1 + df)).astype(np.float32) + np.float32(0.1)
    x = Sparse(width)
    for d, o in blocks(texts):
        x.add(vectors(d, o, idf, None, s))
    random = np.random.default_rng(s.seed)
    dim = min(s.dim, len(texts))
    q = np.linalg.qr(x.across(random.normal(size=(len(texts), dim + 8)).astype(np.float32)))[0]
    for _ in range(3):
        q = np.linalg.qr(x.across(x.times(q)))[0]
    _, _, rows = np.linalg.svd(x.times(q), full_matrices=False)
    basis = (q @ rows.T)[:, :dim].astype(np.float32)
    made = x.times(basis)
    made /= np.maximum(1e-12, np.linalg.norm(made, axis=1, keepdims=True))
    y = np.array(labels, np.float64)
    # rows of equal features have equal vectors, whatever the last bits of the products say
    _, first, group = np.unique(np.round(made, 5), axis=0, return_index=True, return_inverse=True)
    counts = np.bincount(group)
    order = np.argsort(first)
    return {"idf": idf, "basis": basis, "vectors": made[first[order]].astype(np.float32), "labels": (np.bincount(group, y) / counts)[order], "counts": counts[order].astype(np.float64), "prior": float(y.mean())}


def vote(m: dict, latent: np.ndarray, s: KnnSettings) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest sample rows.

    Sample rows of equal vectors are one vector with a number and a mean label, and vote together:
    where only some of them come within the rank, as many votes count, all with the mean label.
    Different vectors that tie at the rank are taken in the order of the sample.
    """
    if not len(m["vectors"]):
        return np.full(len(latent), m["prior"])
    k = min(s.neighbours, len(m["vectors"]))
    out = np.empty(len(latent))
    for a in range(0, len(latent), 256):
        near = latent[a : a + 256] @ m["vectors"].T
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        least = np.take_along_axis(near, top, axis=1).min(axis=1, keepdims=True)
        tied = np.flatnonzero((near >= least).sum(axis=1) > k)
        top[tied] = np.argsort(-near[tied], axis=1, kind="stable")[:, :k]
        cosine = np.take_along_axis(near, top, axis=1)
        order = np.lexsort((top, -cosine), axis=1)
        top, cosine = np.take_along_axis(top, order, axis=1), np.take_along_axis(cosine, order, axis=1)
        counts = m["counts"][top]
        votes = np.clip(s.neighbours - (np.cumsum(counts, axis=1) - counts), 0, counts)
        weight = votes * np.maximum(0, cosine).astype(np.float64) ** 4
        total = weight.sum(axis=1)
        out[a : a + 256] = np.where(total > 1e-9, (weight * m["labels"][top]).sum(axis=1) / np.maximum(total, 1e-9), m["prior"])
    return np.clip(out, 0, 1)


def learn(docs: DataFrame, labels: DataFrame, s: KnnSettings = KnnSettings(), text: str = "text") -> dict:
    """Fit on at most ``s.sample`` labelled documents, in the order of a hash of their ids.

    Rows with a null id, text or quality teach nothing.
    """
    ids = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("y"))
    ids = ids.orderBy(F.xxhash64("doc_id", F.lit(s.seed)), "doc_id").limit(2 * s.sample)  # at most: some ids may have no text
    known = docs.where(F.col(text).isNotNull()).select("doc_id", F.col(text).alias("t"))
    rows = known.join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id", F.lit(s.seed)), "doc_id", "t").limit(s.sample).collect()
    return fit([r.t for r in rows], [r.y for r in rows], s)


def score(docs: DataFrame, fitted: dict, s: KnnSettings = KnnSettings(), text: str = "text") -> DataFrame:
    """``docs`` with score and predicted (1 from ``s.cut`` on). Null or empty texts get the sample's share of label 1."""
    held = docs.sparkSession.sparkContext.broadcast(fitted)
    made = ["score", "predicted"]
    kept = [c for c in docs.columns if c not in made]
    fields = [docs.schema[c] for c in kept] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def work(batches):
        m = held.value
        for batch in batches:
            for part, data, offsets in arrowtext.pieces(batch, text, arrowtext.PIECE):
                values = np.concatenate([vote(m, vectors(*cut, m["idf"], m["basis"], s), s) for cut in row_blocks(data, offsets, 256)])
                cols = [part.column(c) for c in kept] + [pa.array(values), pa.array((values >= s.cut).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(cols, names=kept + made)

    return by_batches(docs, work, T.StructType(fields))


def row_blocks(data: np.ndarray, offsets: np.ndarray, rows: int):
    for a in range(0, len(offsets) - 1, rows):
        cuts = offsets[a : a + rows + 1]
        yield data[cuts[0] : cuts[-1]], cuts - cuts[0]
