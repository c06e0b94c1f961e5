"""Language identification: averaged hashed subword embeddings under a linear softmax.

Features of a text are its words and their 3- and 4-byte windows (lower case, runs of other
than letters as one space), hashed into a fixed number of buckets. Embeddings and the softmax
layer are trained by stochastic gradient descent on snippets of a bounded, documented sample.
A temperature and a rejection threshold are then fitted on sample documents held back from it.
For prediction the layer is folded into the table, which leaves one score row a bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.llm import arrowtext
from kindred.llm.shared import bounded_sample, by_batches

UNDETERMINED = "und"


@dataclass(frozen=True)
class LangIdSettings:
    """``sample``: labelled documents to learn from at most. ``doubt``: reject where a wrong answer is likelier than this."""

    sample: int = 4000
    buckets: int = 1 << 16
    dim: int = 16
    epochs: int = 4
    snippets: int = 6
    rate: float = 0.5
    doubt: float = 0.5
    seed: int = 7


#: Bytes of letters after lower-casing: a-z and all of multi-byte characters; others become a space.
LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True


def lowered(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw = [(t or "").lower().encode() for t in texts]
    offsets = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(r) for r in raw], out=offsets[1:])
    return np.frombuffer(b"".join(raw), np.uint8), offsets


def features(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features and the text that each belongs to (texts ascending)."""
    letters = LETTER[data]
    clean = np.where(letters, data, np.uint8(32))
    starts = np.zeros(len(data), bool)
    starts[offsets[:-1][offsets[:-1] < len(data)]] = True
    keep = letters.copy()
    if len(data):
        keep[1:] |= letters[:-1] & ~starts[1:]  # the one space after a word
    ends = np.cumsum(keep)
    sizes = np.concatenate([[0], ends])[offsets]
    clean, n = clean[keep], int(sizes[-1])
    sums = arrowtext.prefix_hash(clean)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(sizes))
    mask, found, texts = np.uint64(buckets - 1), [], []
    for width in (3, 4):
        at = np.arange(max(0, n - width + 1))
        at = at[owner[at] == owner[at + width - 1]] if len(at) else at
        if len(at):
            inner = clean[at + 1] != 32
            at = at[inner]
        found.append(arrowtext.range_hash(sums, at, at + width) + np.uint64(width) & mask)
        texts.append(owner[at])
    w = arrowtext.words(clean, sizes, lower=False)
    found.append(w.hashes & mask)
    texts.append(w.texts)
    return np.concatenate(found).astype(np.int64), np.concatenate(texts)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def means(table: np.ndarray, found: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    out = np.stack([np.bincount(texts, table[found, k], n) for k in range(table.shape[1])], axis=1)
    return out / np.maximum(1, np.bincount(texts, minlength=n))[:, None]


def snippets(texts: list[str], labels: np.ndarray, s: LangIdSettings, random) -> tuple[list[str], np.ndarray]:
    """Windows of 1 to 40 words at random places, so that short texts are met in training."""
    out, marks = [], []
    for t, y in zip(texts, labels):
        held = t.split()
        for _ in range(s.snippets if held else 0):
            size = int(random.integers(1, 41))
            at = int(random.integers(0, max(1, len(held) - size + 1)))
            out.append(" ".join(held[at : at + size]))
            marks.append(y)
    return out, np.array(marks, np.int64)


def train(texts: list[str], langs: list[str], s: LangIdSettings = LangIdSettings()) -> dict:
    """Fit table, classes, temperature and rejection threshold; an empty sample gives no classes."""
    classes = sorted(set(langs))
    if not classes:
        return {"classes": [], "table": np.zeros((1, 1), np.float32), "threshold": 1.0}
    random = np.random.default_rng(s.seed)
    y = np.array([classes.index(x) for x in langs], np.int64)
    order = random.permutation(len(texts))
    held = order[: len(order) // 5]
    fit = order[len(order) // 5 :]
    table = random.normal(0, 0.05, (s.buckets, s.dim)).astype(np.float32)
    layer = np.zeros((s.dim, len(classes)))
    weight = 1 / np.maximum(1, np.bincount(y[fit], minlength=len(classes)))
    weight = weight / (weight @ np.bincount(y[fit], minlength=len(classes)) / max(1, len(fit)))
    pieces, marks = snippets([texts[k] for k in fit], y[fit], s, random)
    for epoch in range(s.epochs):
        rate, mixed = s.rate * (1 - epoch / s.epochs), random.permutation(len(pieces))
        for k in range(0, len(mixed), 64):
            rows = mixed[k : k + 64]
            found, at = features(*lowered([pieces[r] for r in rows]), s.buckets)
            if not len(found):
                continue
            size = np.maximum(1, np.bincount(at, minlength=len(rows)))
            hidden = means(table, found, at, len(rows))
            error = softmax(hidden @ layer)
            error[np.arange(len(rows)), marks[rows]] -= 1
            error *= weight[marks[rows]][:, None]
            back = (error @ layer.T) / size[:, None]
            layer -= rate * hidden.T @ error / 8
            np.subtract.at(table, found, (rate * 8 * back[at]).astype(np.float32))
    folded = (table @ layer).astype(np.float32)
    calibration, truth = snippets([texts[k] for k in held], y[held], s, random)
    calibration += [texts[k] for k in held]
    truth = np.concatenate([truth, y[held]])
    temperature, threshold = 1.0, max(1 / len(classes), 1 - s.doubt)
    if len(calibration):
        cuts = [calibration[k : k + 200] for k in range(0, len(calibration), 200)]
        logits = np.concatenate([means(folded, *features(*lowered(c), s.buckets), len(c)) for c in cuts])
        tries = np.geomspace(0.05, 20, 60)
        nll = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in tries]
        temperature = float(tries[int(np.argmin(nll))])
        sure = softmax(logits / temperature)
        right, top = sure.argmax(axis=1) == truth, sure.max(axis=1)
        # the lowest confidence from which on, in bins of the calibration set, answers are wrong less often than ``doubt``
        for low in np.arange(1 / len(classes), 1, 0.05):
            near = (top >= low) & (top < low + 0.1)
            if near.sum() >= 20 and 1 - right[near].mean() > s.doubt:
                threshold = float(low + 0.05)
    return {"classes": classes, "table": (folded / temperature).astype(np.float32), "threshold": threshold}


def learn(docs: DataFrame, s: LangIdSettings = LangIdSettings(), text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict:
    """Train on at most ``s.sample`` of the given documents with text and label, drawn by a hash of ``key``."""
    some = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("y"))
    rows = bounded_sample(some, s.sample, s.seed, "k").collect()
    return train([r.t for r in rows], [r.y for r in rows], s)


def predict(docs: DataFrame, fitted: dict, s: LangIdSettings = LangIdSettings(), text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (the calibrated probability) and accepted.

    A text that is null or without a letter gets ``und``, score 0 and is not accepted. So does
    every text if nothing was learned. Rows are independent; the whole text is read.
    """
    held = docs.sparkSession.sparkContext.broadcast(fitted)
    made = ["lang_pred", "score", "accepted"]
    kept = [c for c in docs.columns if c not in made]
    fields = [docs.schema[c] for c in kept] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]

    def work(batches):
        m = held.value
        for batch in batches:
            for part, data, offsets in arrowtext.pieces(batch, text):
                texts = part.column(text).to_pylist()
                if m["classes"]:
                    low, cuts = lowered(texts)
                    p = softmax(means(m["table"], *features(low, cuts, s.buckets), len(texts)).astype(np.float64))
                    ascii_letters = np.concatenate([[0], np.cumsum((low >= 97) & (low <= 122))])
                    some = ascii_letters[cuts[1:]] > ascii_letters[cuts[:-1]]
                    known = np.array([bool(a) or any(map(str.isalpha, t or "")) for a, t in zip(some, texts)])
                    best, top = p.argmax(axis=1), p.max(axis=1)
                else:
                    known, best, top = np.zeros(len(texts), bool), np.zeros(len(texts), int), np.zeros(len(texts))
                names = [m["classes"][b] if k else UNDETERMINED for b, k in zip(best, known)]
                cols = [part.column(c) for c in kept] + [pa.array(names, pa.string()), pa.array(np.where(known, top, 0.0)), pa.array(known & (top >= m["threshold"]))]
                yield pa.RecordBatch.from_arrays(cols, names=kept + made)

    return by_batches(docs, work, T.StructType(fields))
