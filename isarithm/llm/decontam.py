"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

Words are lower-cased runs of ASCII letters and digits and of bytes over 127. Every n-gram of a test
item is a seed, however many texts hold it: a count over texts would fall first on the seeds that
edits of a common item destroy. Each place where a text holds a seed of an item fixes a diagonal. The
best score that any order of the words around it could reach is an upper bound; where the bound
reaches `least` of the item's perfect score, the item is aligned with those words by local alignment
(match 2, mismatch and gap -1), and a pair is a leak if its score reaches it too.

The corpus is never collected. The test set is dealt in blocks of at most ITEMS_PER_BLOCK items, each
against all texts, so what is broadcast is bounded by that parameter and an item's length, and does
not grow with either table. Work grows with the places where texts hold seeds.

Defined cases: a null or empty text, and an item without words, match nothing; an item shorter than
n words is one seed and must occur whole; repeated rows are reported as one id and item pair with
the best score; rows with a null id, and items with a null id, are left out, as a pair could not name
them; equal test items under two ids are both reported; of equally good alignments of a pair the one that
ends last is told; very long texts are aligned only around their hits, in rows of at most ROW_CELLS cells,
and a task holds one of them whole. Only ids and texts are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isarithm.llm import words as W

SEED = 3
LEAST = 0.5
#: Test items that are broadcast at a time.
ITEMS_PER_BLOCK = 5_000
#: Cells of an alignment row that are held at a time.
ROW_CELLS = 4_000_000
#: Places of seeds, and words of items, that are looked at a time.
HITS = 1 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
U = np.uint64
_OTHER = np.ones(256, dtype=bool)
_OTHER[128:] = False
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    _OTHER[_low:_high] = False


def _fold(texts: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.utf8_lower(texts)


def _hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    w = W.split(*W.flat(_fold(texts)), blank=_OTHER)
    return W.word_hashes(w), w.first


class Index:
    """Words of the items, and their seeds in order of hash."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, n: int):
        self.ids, self.n = ids, n
        self.words, self.first = _hashed(texts)
        self.seeds, self.bounds = W.shingles(self.words, self.first, n)
        self.owner = np.repeat(np.arange(len(ids)), np.diff(self.bounds))
        self.place = np.arange(len(self.seeds)) - np.repeat(self.bounds[:-1], np.diff(self.bounds))
        order = np.argsort(self.seeds, kind="stable")
        self.seeds, self.owner, self.place = self.seeds[order], self.owner[order], self.place[order]
        self.keys = np.unique(self.seeds)
        self.known, self.code = np.unique(self.words, return_inverse=True)


def _hits(keys: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Indices of the shingles that are among the sorted keys."""
    if len(keys) == 0:
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, s), len(keys) - 1)
    return np.flatnonzero(keys[at] == s)


def _seeds_of(texts: pa.Array, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words and word bounds of the texts, and for each seed in them its hash and first word.

    Items shorter than n have a seed of all their words, so texts are also read for runs of 1 to n - 1 words
    where such items exist.
    """
    h, first = _hashed(texts)
    found, place = [], []
    short = set(np.diff(index.first)[np.diff(index.first) > 0].tolist())
    for n in sorted({min(k, index.n) for k in short}):
        s, bounds = W.shingles(h, first, n)
        hit = _hits(index.keys, s)
        doc = np.searchsorted(bounds, hit, side="right") - 1
        real = np.diff(first)[doc] >= n
        hit, doc = hit[real], doc[real]
        found.append(s[hit])
        place.append(first[doc] + hit - bounds[doc])
    if not found:
        return h, first, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return h, first, np.concatenate(found), np.concatenate(place)


def align(items: np.ndarray, sizes: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each row of items (rows, m) with its window (rows, w), and its end in the window.

    A zero in a window matches nothing; of an item only the first `sizes` words count. A gap along the
    window is a running maximum, so a row of the score table takes a few array operations.
    """
    k, width = windows.shape
    ramp = np.arange(width + 1, dtype=np.int32) * -GAP
    above = np.zeros((k, width + 1), np.int32)
    best, end = np.zeros(k, np.int32), np.zeros(k, np.int64)
    for r in range(items.shape[1]):
        same = (windows == items[:, r : r + 1]) & (r < sizes)[:, None]
        row = np.zeros((k, width + 1), np.int32)
        row[:, 1:] = np.maximum(above[:, :-1] + np.where(same, MATCH, MISMATCH), above[:, 1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + ramp, axis=1) - ramp
        row[r >= sizes] = 0
        top = row.argmax(axis=1)
        value = row[np.arange(k), top]
        better = value > best
        best[better], end[better] = value[better], top[better]
        above = row
    return best, end


def _candidates(index: Index, first: np.ndarray, seeds: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, item and band of each place where a text holds a seed of an item, each once.

    Hits of one item on diagonals that differ by less than half its length share a band.
    """
    size = np.diff(index.first)
    lo, hi = np.searchsorted(index.seeds, seeds), np.searchsorted(index.seeds, seeds, side="right")
    total = np.concatenate([[0], np.cumsum(hi - lo)])
    found, at = [np.zeros((3, 0), np.int64)], 0
    while at < len(seeds):
        to = max(at + 1, int(np.searchsorted(total, total[at] + HITS, side="right")) - 1)
        per = (hi - lo)[at:to]
        which = np.repeat(lo[at:to], per) + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        item, spot = index.owner[which], np.repeat(place[at:to], per)
        doc = np.searchsorted(first, spot, side="right") - 1
        band = (spot - index.place[which] - first[doc] + (1 << 40)) // np.maximum(size[item] // 2, 2)
        found.append(np.unique(np.stack([doc, item, band]), axis=1))
        at = to
    doc, item, band = np.unique(np.concatenate(found, axis=1), axis=1) if len(found) > 2 else found[-1]
    return doc, item, band


def _bounds(index: Index, held: np.ndarray, span: int, item: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Upper bounds of the alignment scores of items with the words begin to end.

    An item's word that occurs there counts as a match, any other one as a mismatch or gap; the best
    stretch of the item counts. `held` is the sorted code * span + place of all words known to the index.
    """
    size = np.diff(index.first)
    out = np.zeros(len(item), np.int64)
    most = int(size[item].max())
    step = max(1, HITS // most)
    for lo in range(0, len(item), step):
        k = slice(lo, lo + step)
        col = np.arange(most)
        code = index.code[np.minimum(index.first[item[k]][:, None] + col, len(index.code) - 1)]
        at = np.searchsorted(held, code * span + begin[k][:, None])
        there = held[np.minimum(at, len(held) - 1)]
        real = (at < len(held)) & (there < code * span + end[k][:, None])
        gain = np.where(col < size[item[k]][:, None], np.where(real, MATCH, max(MISMATCH, GAP)), 0)
        run = np.concatenate([np.zeros((len(gain), 1), np.int64), np.cumsum(gain, axis=1)], axis=1)
        out[k] = (run - np.minimum.accumulate(run, axis=1)).max(axis=1)
    return out


def _leaks(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        size = np.diff(index.first)
        for batch in batches:
            for piece in W.pieces(batch, 0):
                h, first, seeds, place = _seeds_of(piece.column(0), index)
                doc, item, band = _candidates(index, first, seeds, place)
                if len(doc) == 0:
                    continue
                slack = np.maximum(size[item] // 2, 2)
                begin = (band * slack) - (1 << 40) + first[doc] - slack
                length = size[item] + 3 * slack
                order = np.argsort(length, kind="stable")
                code = np.searchsorted(index.known, h)
                known = np.flatnonzero(index.known[np.minimum(code, len(index.known) - 1)] == h)
                span = len(h) + 1
                held = np.sort(code[known] * span + known)
                hopeful = []
                for lo in range(0, len(order), 1 << 14):
                    k = order[lo : lo + (1 << 14)]
                    # As wide as the widest of them, as rows that are aligned together share a width.
                    start, stop = np.maximum(begin[k], first[doc[k]]), np.minimum(begin[k] + length[k].max(), first[doc[k] + 1])
                    hopeful.append(k[_bounds(index, held, span, item[k], start, stop) >= least * MATCH * size[item[k]]])
                order = np.concatenate(hopeful)
                results, at = [], 0
                while at < len(order):
                    ahead = order[at : at + 256]
                    k = ahead[: max(1, int(np.searchsorted(np.cumsum(length[ahead]), ROW_CELLS)))]
                    at += len(k)
                    m, width = int(size[item[k]].max()), int(length[k].max())
                    cols = begin[k][:, None] + np.arange(width)
                    inside = (cols >= first[doc[k]][:, None]) & (cols < first[doc[k] + 1][:, None])
                    windows = np.where(inside, h[np.clip(cols, 0, max(len(h) - 1, 0))], U(0))
                    rows = np.minimum(index.first[item[k]][:, None] + np.arange(m), len(index.words) - 1)
                    score, end = align(index.words[rows], size[item[k]], windows)
                    part = score / (MATCH * size[item[k]])
                    good = part >= least
                    results.append((doc[k][good], item[k][good], part[good], (begin[k] + end - first[doc[k]])[good]))
                if results:
                    d, i, p, e = (np.concatenate(x) for x in zip(*results, strict=True))
                    ids = piece.column(1).to_numpy(zero_copy_only=False)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[d]), pa.array(index.ids[i]), pa.array(p), pa.array(e)], names=["id", "item", "score", "end"])

    return run


def _blocks(items: DataFrame, most: int) -> Iterator[pd.DataFrame]:
    """The test items in blocks of ascending ids; equal ids never fall in two blocks."""
    after = None
    while True:
        rest = items if after is None else items.where(F.col("item") > after)
        ids = [row[0] for row in rest.select("item").distinct().orderBy("item").limit(most).collect()]
        if not ids:
            return
        after = ids[-1]
        yield rest.where(F.col("item") <= after).distinct().orderBy("item", "text").toPandas()


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
    n: int = SEED, least: float = LEAST, block: int = ITEMS_PER_BLOCK,
) -> DataFrame:
    """(id, item, score, end): every text and test item that align, with the best score and the aligned part's end in words."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL AND text IS NOT NULL")
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("text")).where("item IS NOT NULL AND text IS NOT NULL")
    found = []
    for part in _blocks(items, block):
        index = Index(part["item"].to_numpy(), pa.array(part["text"], pa.string()), n)
        found.append(rows.mapInArrow(_leaks(spark.sparkContext.broadcast(index), least), "id long, item long, score double, end long"))
    if not found:
        return spark.createDataFrame([], f"{id_col} long, {item_col} long, score double, end long")
    best = reduce(DataFrame.unionByName, found).groupBy("id", "item").agg(F.max(F.struct("score", "end")).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "b.score", "b.end")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of texts that hold no test item; all columns as they were.

    Rows are judged by their texts alone, through a hash of 64 bits, so rows without an id go too and rows
    that share an id are told apart; `id_col` is not read.
    """
    key = F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("k")
    rows = docs.select(key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    hit = leaks(docs.select(key, F.col(f"`{text_col}`").alias("text")), benchmark, "k", "text", **params).select("k").distinct()
    return rows.join(hit, "k", "left_anti").select("row.*")
