"""Quality classifier: a byte-level convolutional network in numpy.

Filters of WIDTH bytes (one weight per place and byte value) slide over the whole document; their
rectified responses are averaged within overlapping chunks of 2 * HALF bytes, one every HALF bytes;
the largest chunk average of each filter is kept, and a logistic layer over those maxima gives one
probability. Long documents only have more chunks. Training is Adam on the log loss; the gradient of
a maximum goes to the chunk that holds it.

Training draws the SAMPLE_PER_CLASS labelled ids of each class with the smallest hash and takes their
documents whole, however long (at most 2 * SAMPLE_PER_CLASS rows a class, should ids repeat), so the driver holds those texts; the class sizes of all labelled rows set the prior. Scores read the text only.

Defined cases: a null or empty text is scored as one empty chunk; null and unknown labels are not
learned from; several labels of one id are all learned from; if only one class has labels, every
score is that class's share; repeated rows get equal scores; empty tables give empty results; other
columns are not read. Memory is bounded by the longest single text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isarithm.llm import words as W
from isarithm.llm.carry import with_kernel

WIDTH = 4
FILTERS = 12
HALF = 128
EPOCHS = 12
#: Small samples get more epochs, up to this many steps.
STEPS = 500
BATCH = 64
RATE = 0.02
DECAY = 1e-5
SAMPLE_PER_CLASS = 1200
THRESHOLD = 0.7


class Net:
    """Weights: w (WIDTH, 256, FILTERS), b (FILTERS), v (FILTERS), c."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.w = rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.w[:, 0, :] = 0  # the byte that stands after a document's end weighs nothing
        self.b = np.zeros(FILTERS, np.float32)
        self.v = rng.normal(0, 0.5, FILTERS).astype(np.float32)
        self.c = np.zeros(1, np.float32)

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Rectified responses of the windows that begin at each byte."""
        padded = np.concatenate([data, np.zeros(WIDTH - 1, np.uint8)])
        out = self.w[0][data]
        for j in range(1, WIDTH):
            out += self.w[j][padded[j : j + len(data)]]
        out += self.b
        return np.maximum(out, 0, out=out)

    def halves(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of responses over consecutive half chunks of each document, their sizes and bounds."""
        per = np.maximum(-(-size // HALF), 1)
        bounds = np.concatenate([[0], np.cumsum(per)])
        start = np.repeat(at - bounds[:-1] * HALF, per) + np.arange(bounds[-1]) * HALF
        count = np.minimum(HALF, np.repeat(at + size, per) - start)
        total = np.zeros((len(start), FILTERS), np.float32)
        some = np.flatnonzero(count > 0)
        for lo in range(0, len(some), 2048):
            k = some[lo : lo + 2048]
            a, b = start[k[0]], start[k[-1]] + count[k[-1]]
            r = np.concatenate([self.responses(data[a : b + WIDTH - 1])[: b - a], np.zeros((1, FILTERS), np.float32)])
            total[k] = np.add.reduceat(r, np.stack([start[k] - a, start[k] + count[k] - a], axis=1).ravel(), axis=0)[::2]
        return total, count, bounds

    def pooled(self, data: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each document's largest chunk averages, and for each the chunk's first half, its bytes and the half bounds."""
        total, count, bounds = self.halves(data, at, size)
        last = np.zeros(len(count), bool)
        last[bounds[1:] - 1] = True
        both = total + np.where(last[:, None], 0, np.concatenate([total[1:], total[:1]]))
        n = count + np.where(last, 0, np.concatenate([count[1:], count[:1]]))
        mean = both / np.maximum(n, 1)[:, None]
        top = np.maximum.reduceat(mean, bounds[:-1], axis=0)
        return top, mean, n, bounds

    def score(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        top = self.pooled(*spaced(data, at))[0]
        return 1 / (1 + np.exp(-(top.astype(np.float64) @ self.v + self.c[0])))


def spaced(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents with WIDTH - 1 zero bytes after each, so that no window joins two; their starts and sizes."""
    size = np.diff(at)
    out = np.zeros(len(data) + (WIDTH - 1) * len(size), np.uint8)
    shift = np.arange(len(size)) * (WIDTH - 1)
    out[np.arange(len(data)) + np.repeat(shift, size)] = data
    return out, at[:-1] + shift, size


def gradient(net: Net, raw: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of the mean log loss and the decay of these documents; that of a maximum goes to the first chunk that holds it."""
    data, at, size = spaced(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    top, mean, n, bounds = net.pooled(data, at, size)
    p = 1 / (1 + np.exp(-(top @ net.v + net.c[0])))
    d = ((p - labels) / len(raw)).astype(np.float32)
    grad = {"v": top.T @ d + DECAY * net.v, "c": np.array([d.sum()], np.float32), "w": DECAY * net.w, "b": np.zeros(FILTERS, np.float32)}
    back = d[:, None] * net.v
    gw = np.zeros((WIDTH, 256, FILTERS), np.float64)
    padded = np.concatenate([data, np.zeros(WIDTH, np.uint8)])
    for f in range(FILTERS):
        # The chunk that holds each document's maximum, and the bytes where the filter is active there.
        best = np.array([lo + int(mean[lo:hi, f].argmax()) for lo, hi in zip(bounds, bounds[1:], strict=False)])
        some = n[best] > 0
        doc, best = np.flatnonzero(some), best[some]
        begin = at[doc] + (best - bounds[:-1][doc]) * HALF
        long = n[best]
        idx = np.repeat(begin - (np.cumsum(long) - long), long) + np.arange(long.sum())
        per = np.repeat(back[doc, f] / long, long)
        z = net.b[f] + sum(net.w[j, padded[idx + j], f] for j in range(WIDTH))
        live = z > 0
        idx, per = idx[live], per[live]
        for j in range(WIDTH):
            gw[j, :, f] += np.bincount(padded[idx + j], weights=per, minlength=256)
        grad["b"][f] = per.sum()
    gw[:, 0, :] = 0
    grad["w"] = grad["w"] + gw.astype(np.float32)
    return grad


def fit(texts: list[bytes], labels: np.ndarray, prior: float, seed: int = 7) -> Net:
    """A net trained on the texts; its offset is moved from the sample's class balance to the prior."""
    net = Net(seed)
    rng = np.random.default_rng(seed)
    share = labels.mean()
    shift = np.log(share / (1 - share))
    state = {k: (np.zeros_like(getattr(net, k)), np.zeros_like(getattr(net, k))) for k in "wbvc"}
    step = 0
    epochs = max(EPOCHS, -(-STEPS * BATCH // len(texts)))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            k = order[lo : lo + BATCH]
            grad = gradient(net, [texts[i] for i in k], labels[k])
            step += 1
            for key, g in grad.items():
                m, s = state[key]
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                rate = RATE * (1 - epoch / epochs)
                getattr(net, key)[...] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    net.c += np.float32(np.log(prior / (1 - prior)) - shift)
    return net


def held_out(id_col: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", seed: int = 7) -> Net | float:
    """The net learned from the labelled rows given, or the only class's share of them."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id IS NOT NULL AND y IN (0, 1)")
    sizes = {row[0]: row[1] for row in marks.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return float(next(iter(sizes), 1))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    # Ids are drawn from the labels alone: at most 2 * SAMPLE_PER_CLASS of them, so their texts take no shuffle.
    drawn = [marks.where(F.col("y") == label).distinct().orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_CLASS) for label in (0, 1)]
    sample = rows.join(F.broadcast(drawn[0].union(drawn[1])), "id").select("id", "text", "y")
    # An id can have many rows, so the rows drawn are bounded too; each task keeps no more of its own.
    place = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("text"), "id"))
    bounded = sample.withColumn("place", place).where(F.col("place") <= 2 * SAMPLE_PER_CLASS).drop("place")
    found = sorted(bounded.collect(), key=lambda r: (r["id"], r["text"], r["y"]))
    texts, y = [row["text"].encode() for row in found], [row["y"] for row in found]
    if len(set(y)) < 2:
        return sizes[1] / (sizes[0] + sizes[1])
    return fit(texts, np.array(y, np.float32), sizes[1] / (sizes[0] + sizes[1]), seed)


def score(docs: DataFrame, model: Net | float, text_col: str = "text", out_col: str = "score", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and the model's probability that a text is of class 1."""
    if isinstance(model, float):
        return docs.select(*[F.col(f"`{c}`") for c in keep if c != out_col], F.lit(model).alias(out_col))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kernel = lambda given: [pa.array(shared.value.score(*W.flat(given[0])))]
    return with_kernel(docs, [F.col(f"`{text_col}`").cast("string")], kernel, [(out_col, T.DoubleType())], list(keep), lambda batch: W.pieces(batch, 0, 1 << 20))
