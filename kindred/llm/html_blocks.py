"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks, with the path of open tags (their names, and the words
of class, id and role). Each block is a vector of its hashed path, the mean of the trained vectors
of all its hashed words, and a few shares (links, length, punctuation). A bidirectional LSTM in
numpy reads the sequence and labels every block as content or not, with the whole page as context.
It is trained on pages that a generator lays out, whose labels are known, so that nothing of the
input table is learned from.
"""

from __future__ import annotations

import hashlib
import inspect
import zlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from kindred.llm import arrowtext, layouts, markup
from kindred.llm.layouts import laid_out
from kindred.llm.markup import Block, blocks
from kindred.llm.shared import by_batches, finished, shared_dir

PATH, WORD, PLAIN = 512, 16, 6
WIDTH = PATH + WORD + PLAIN
#: Word vectors are looked up by hash; words beyond ASCII letters' punctuation and digits are kept whole.
CELLS = 1 << 12
LETTERS_ONLY = bytes(k + 32 if 65 <= k <= 90 else k if 97 <= k <= 122 or k > 127 else 32 for k in range(256))


def spread(words: list[str], width: int) -> np.ndarray:
    out = np.zeros(width, np.float32)
    for w in words:
        h = zlib.crc32(w.encode())
        out[h % width] += 1 if h & 65536 else -1
    return out


@lru_cache(4096)
def path_vector(path: tuple[str, ...]) -> np.ndarray:
    words = [w for step in path for w in step.split(" ")]
    deep = path[-1].split(" ") if path else []
    steps = sorted({f"{a}>{b}" for a, b in zip(path, path[1:])})
    return np.clip(spread(sorted(set(words)), PATH) + 0.5 * spread(["^" + w for w in deep] + steps, PATH), -2, 2)


@dataclass
class Encoded:
    """A page's blocks as numbers: rows of distinct paths and each block's row, plain shares, word cells and their blocks."""

    paths: np.ndarray
    path_of: np.ndarray
    plain: np.ndarray
    cells: np.ndarray = field(repr=False)
    owner: np.ndarray = field(repr=False)

    def __len__(self) -> int:
        return len(self.path_of)


def word_cells(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of all words of the texts, and which text each is in."""
    held = [t.encode("utf-8", "replace").translate(LETTERS_ONLY) for t in texts]
    cells, owners, first = [], [], 0
    while first < len(held):
        last, size = first, 0
        while last < len(held) and (last == first or size + len(held[last]) <= arrowtext.PIECE):
            size += len(held[last])
            last += 1
        offsets = np.concatenate([[0], np.cumsum([len(h) for h in held[first:last]])]).astype(np.int64)
        found = arrowtext.words(np.frombuffer(b"".join(held[first:last]), np.uint8), offsets, lower=False)
        cells.append((found.hashes & np.uint64(CELLS - 1)).astype(np.int32))
        owners.append((found.texts + first).astype(np.int32))
        first = last
    return (np.concatenate(cells), np.concatenate(owners)) if cells else (np.zeros(0, np.int32), np.zeros(0, np.int32))


def encoded(found: list[Block]) -> Encoded:
    known: dict[tuple[str, ...], int] = {}
    path_of = np.array([known.setdefault(b.path, len(known)) for b in found], np.int64)
    plain = np.empty((len(found), PLAIN), np.float32)
    for row, b in zip(plain, found):
        n = len(b.text)
        row[:] = (min(1.0, b.linked / n), np.log1p(n) / 6, np.log1p(b.text.count(" ") + 1) / 4, b.text.count(",") * 4 / n, float(b.text[-1] in ".!?"), len(b.path) / 8)
    return Encoded(np.stack([path_vector(p) for p in known]) if known else np.zeros((0, PATH), np.float32), path_of, plain, *word_cells([b.text for b in found]))


class BiLstm:
    """Two LSTMs over a padded batch of sequences and a logistic output on both states and the input."""

    def __init__(self, hidden: int = 16, seed: int = 3):
        r = np.random.default_rng(seed)
        self.h = hidden
        #: input to the gates of both directions and to the output, recurrent weights, output, word vectors
        self.p = {"in": r.normal(0, WIDTH**-0.5, (WIDTH, 8 * hidden + 1)).astype(np.float32)}
        self.p["in"][:, -1] *= 0.3
        self.p["bias"] = np.zeros(8 * hidden + 1, np.float32)
        for d in "fb":
            self.p["u" + d] = r.normal(0, hidden**-0.5, (hidden, 4 * hidden)).astype(np.float32)
        self.p["bias"][hidden : 2 * hidden] = self.p["bias"][5 * hidden : 6 * hidden] = 1  # remember at first
        self.p["o"] = r.normal(0, 0.1, 2 * hidden).astype(np.float32)
        self.p["word"] = r.normal(0, 0.3, (CELLS, WORD)).astype(np.float32)

    def word_means(self, page: Encoded) -> np.ndarray:
        """The mean vector of each block's words, from a bounded number of words at a time."""
        total = np.zeros((len(page), WORD), np.float32)
        for a in range(0, len(page.cells), 1 << 18):
            cells, owner = page.cells[a : a + (1 << 18)], page.owner[a : a + (1 << 18)]
            starts = np.flatnonzero(np.diff(owner, prepend=-1))
            total[owner[starts]] += np.add.reduceat(self.p["word"][cells], starts, axis=0)
        return total / np.maximum(1, np.bincount(page.owner, minlength=len(page)))[:, None].astype(np.float32)

    def projected(self, page: Encoded) -> np.ndarray:
        """Gate inputs of both directions and the direct output of each block; distinct paths are multiplied once."""
        w = self.p["in"]
        return (page.paths @ w[:PATH])[page.path_of] + self.word_means(page) @ w[PATH : PATH + WORD] + page.plain @ w[PATH + WORD :] + self.p["bias"]

    def run(self, into: np.ndarray, d: str, mask: np.ndarray, tape: list | None = None) -> np.ndarray:
        n, steps, _ = into.shape
        size, u = self.h, self.p["u" + d]
        h, c = np.zeros((n, size), np.float32), np.zeros((n, size), np.float32)
        out = np.zeros((n, steps, size), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = into[:, t] + h @ u
            gates = 1 / (1 + np.exp(-np.clip(g[:, : 3 * size], -40, 40)))
            i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
            q = np.tanh(g[:, 3 * size :])
            m = mask[:, t, None]
            c1 = (f * c + i * q) * m
            th = np.tanh(c1)
            h1 = o * th * m
            if tape is not None:
                tape.append((t, i, f, o, q, c, th, h, m))
            c, h = c1, h1
            out[:, t] = h
        return out

    def logits(self, into: np.ndarray, mask: np.ndarray, tapes: dict | None = None) -> np.ndarray:
        size = 4 * self.h
        cut = {"f": into[..., :size], "b": into[..., size : 2 * size]}
        both = np.concatenate([self.run(cut[d], d, mask, None if tapes is None else tapes.setdefault(d, [])) for d in "fb"], axis=2)
        if tapes is not None:
            tapes["both"] = both
        return both @ self.p["o"] + into[..., -1]

    def gradient(self, pages: list[Encoded], labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        tapes: dict = {}
        into, mask = padded([self.projected(p) for p in pages])
        y, x = np.zeros(mask.shape, np.float32), np.zeros((*mask.shape, WIDTH), np.float32)
        for k, (p, label) in enumerate(zip(pages, labels)):
            y[k, : len(p)] = label
            x[k, : len(p)] = np.concatenate([p.paths[p.path_of], self.word_means(p), p.plain], axis=1)
        e = (1 / (1 + np.exp(-np.clip(self.logits(into, mask, tapes), -40, 40))) - y) * mask / mask.sum()
        g = {"o": np.einsum("nt,nth->h", e, tapes["both"])}
        back = e[..., None] * self.p["o"]
        size = self.h
        gates = np.zeros((*mask.shape, 8 * size + 1), np.float32)
        gates[..., -1] = e
        for k, d in enumerate("fb"):
            u = self.p["u" + d]
            gu = np.zeros_like(u)
            dh = dc = np.zeros((len(x), size), np.float32)
            for t, i, f, o, q, c, th, h, m in reversed(tapes[d]):
                dh = (dh + back[:, t, k * size : (k + 1) * size]) * m
                dc = (dc + dh * o * (1 - th * th)) * m
                dg = np.concatenate([dc * q * i * (1 - i), dc * c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - q * q)], axis=1)
                gates[:, t, 4 * size * k : 4 * size * (k + 1)] = dg
                gu += h.T @ dg
                dh, dc = dg @ u.T, dc * f
            g["u" + d] = gu
        flat = gates.reshape(-1, gates.shape[-1])
        g["in"], g["bias"] = x.reshape(-1, WIDTH).T @ flat, flat.sum(axis=0)
        toward = gates @ self.p["in"][PATH : PATH + WORD].T
        g["word"] = np.zeros_like(self.p["word"])
        for k, p in enumerate(pages):
            if len(p.cells):
                share = toward[k, : len(p)] / np.maximum(1, np.bincount(p.owner, minlength=len(p)))[:, None]
                np.add.at(g["word"], p.cells, share[p.owner])
        return g


@lru_cache(1)
def trained(pages: int = 4000, epochs: int = 10, seed: int = 5) -> BiLstm:
    r = np.random.default_rng(seed)
    data = [(encoded(b), np.array(y, np.float32)) for b, y in (laid_out(r) for _ in range(pages)) if b]
    net = BiLstm()
    one = {k: np.zeros_like(v) for k, v in net.p.items()}
    two = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    data.sort(key=lambda d: len(d[1]))
    groups = [data[k : k + 32] for k in range(0, len(data), 32)]
    for epoch in range(epochs):
        for g in r.permutation(len(groups)):
            step += 1
            rate = 0.01 * (1 - 0.9 * epoch / epochs)
            for k, v in net.gradient(*zip(*groups[g])).items():
                one[k] = 0.9 * one[k] + 0.1 * v
                two[k] = 0.99 * two[k] + 0.01 * v * v
                net.p[k] = net.p[k] - (rate * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def stored(spark: SparkSession) -> BiLstm:
    """The trained labeller from the shared folder, where a session before this one left it; else it is trained and left there."""
    code = "".join(inspect.getsource(x) for x in (layouts, BiLstm, encoded, path_vector, trained))
    place = f"{shared_dir(spark)}/block-labeller-{hashlib.sha256(code.encode()).hexdigest()[:16]}"
    if finished(spark, place):
        net = BiLstm()
        net.p = {r.name: np.frombuffer(bytes(r.values), np.float32).reshape(r.shape) for r in spark.read.parquet(place).collect()}
        return net
    net = trained()
    rows = [(k, list(v.shape), bytearray(v.astype(np.float32).tobytes())) for k, v in net.p.items()]
    spark.createDataFrame(rows, "name string, shape array<int>, values binary").coalesce(1).write.mode("overwrite").parquet(place)
    return net


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    most = max(len(r) for r in rows)
    x, mask = np.zeros((len(rows), most, rows[0].shape[1]), np.float32), np.zeros((len(rows), most), np.float32)
    for k, r in enumerate(rows):
        x[k, : len(r)], mask[k, : len(r)] = r, 1
    return x, mask


def labels(net: BiLstm, pages: list[list[Block]], cells: int = 40_000) -> list[np.ndarray]:
    """Content flags of each page's blocks; pages of like length run together, within ``cells`` padded blocks."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    while order:
        size = max(1, min(256, cells // len(pages[order[0]])))
        some = order[:size]
        while len(some) > 1 and len(some) * len(pages[some[-1]]) > cells:
            some = some[: len(some) // 2]
        order = order[len(some) :]
        z = net.logits(*padded([net.projected(encoded(pages[k])) for k in some]))
        for k, row in zip(some, z):
            out[k] = row[: len(pages[k])] > 0
    return out


def main_text(pages: DataFrame, page: str = "html", net: BiLstm | None = None) -> DataFrame:
    """``pages`` (markup left out) with text and n_chars.

    The text is that of the content blocks in page order, one to a line. A null page is empty;
    a page without content has an empty text. Malformed markup never fails: a tag that the page
    ends in is dropped, an element that is never closed ends with its parent. Rows are
    independent of each other.
    """
    held = pages.sparkSession.sparkContext.broadcast((net or stored(pages.sparkSession)).p)
    made = ["text", "n_chars"]
    kept = [c for c in pages.columns if c != page and c not in made]
    fields = [pages.schema[c] for c in kept] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def work(batches):
        reader = BiLstm()
        reader.p = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                found = [blocks(p or "") for p in part.column(page).to_pylist()]
                texts = ["\n".join(b.text for b, keep in zip(f, flags) if keep) for f, flags in zip(found, labels(reader, found))]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=kept + made)

    return by_batches(pages, work, T.StructType(fields))
