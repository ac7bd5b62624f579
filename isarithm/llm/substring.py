"""Repeated passages across documents, found as sliding runs of consecutive sentences.

A sentence ends after a word whose last byte is one of . ! ? (before a blank) and before a line feed. Of
every CUT consecutive words without such an end, the one with the least hash ends a sentence too. That
depends on the words alone, so running text is cut alike wherever a passage stands, and no sentence has
more than CUT words. From every sentence the shortest run of at least RUN sentences and MIN_WORDS words
is hashed, forwards and backwards: a longer repeated run holds a shorter one, and each sentence of a
repeated passage lies in some run of it. Any repeat of MIN_WORDS + 4 * CUT - 3 words (54) holds a run,
in whatever text and at whatever offset; shorter ones of MIN_WORDS words and RUN sentences do where they
begin and end with sentences. Of a passage that begins or ends amid a sentence, up to 2 * CUT - 1 words
at that end can stay.

A document settles its own repetitions; its first run of each hash takes part in the global join. Runs
are first counted by 64 bits of hash, and a bitmap of BITS bits tells which of them occur twice; only
those are joined, on 128 bits. At 128 bits two of 3e12 different runs share a hash with a chance of
1e-14. A full bitmap lets every run through: more is shuffled then, but nothing is lost. The first
occurrence, by id, then text hash, then place, stays, and every sentence under any other one is removed.
Blanks between words do not count for equality; removed sentences take the blanks after them along.

Defined cases: a null text stays null and an empty one empty; a text with fewer sentences or words than a
run is never changed; rows without an id come last in the order; rows of equal id and equal text are one
document and are treated alike, rows of equal id and other text are documents of their own; an empty
table stays empty; all other columns pass through, whatever their names. Memory is bounded by the longest
single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isarithm.llm import words as W
from isarithm.llm.storage import cut

RUN = 3
MIN_WORDS = 25
#: Words without a stop of which one ends a sentence.
CUT = 8
#: Size of the bitmap of repeated hashes, which is broadcast: 16 MB.
BITS = 1 << 27
U = np.uint64
_RATIO = W.ODD[300]
_INVERSE = U(pow(int(_RATIO), -1, 2**64))
_LAST = 2**63 - 1


def _over(x: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Minimum or maximum of every `size` consecutive values, by doubling the reach."""
    pick, reach = np.minimum if least else np.maximum, 1
    while reach < size:
        step = min(reach, size - reach)
        x = pick(x[:-step], x[step:])
        reach += step
    return x


def sentences(w: W.Words) -> np.ndarray:
    """Index of each sentence's first word; the bounds of documents are bounds of sentences."""
    n = len(w.starts)
    if n == 0:
        return np.zeros(0, np.int64)
    last = w.data[w.ends - 1]
    stop = (last == ord(".")) | (last == ord("!")) | (last == ord("?"))
    lines = np.concatenate([[0], np.cumsum(w.data == ord("\n"))])
    new = np.zeros(n, bool)
    new[0] = True
    new[1:] = stop[:-1] | (lines[w.starts[1:]] > lines[w.ends[:-1]])
    new[w.first[:-1][w.first[:-1] < n]] = True
    if n >= CUT:
        part = np.cumsum(new)
        h = W.mix(W.word_hashes(w) ^ W.ODD[313]) | U(1)
        low = _over(h, CUT, True)
        low[part[CUT - 1 :] != part[: n - CUT + 1]] = 0  # these words hold an end already
        none = np.zeros(CUT - 1, np.uint64)
        new[1:] |= (h == _over(np.concatenate([none, low, none]), CUT, False))[:-1]
    return np.flatnonzero(new)


def runs(w: W.Words, first: np.ndarray, least: int = RUN, words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes (a row each), first sentence and end of all runs, as indices into `first`."""
    n = len(first)
    if n == 0:
        return np.zeros((2, 0), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = W.word_hashes(w)
    place = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    total = np.append(first, len(h))  # words before each sentence
    bounds = np.searchsorted(first, w.first)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    i = np.arange(n)
    end = np.maximum(np.searchsorted(total, total[:-1] + words), i + least)
    back = np.minimum(np.searchsorted(total, total[1:] - words, side="right") - 1, i + 1 - least)
    ahead = end <= bounds[doc + 1]
    behind = back >= bounds[doc]
    behind[behind] = end[back[behind]] != i[behind] + 1
    a, b = np.concatenate([i[ahead], back[behind]]), np.concatenate([end[ahead], i[behind] + 1])
    power = np.cumprod(np.full(n, _RATIO))
    under = np.cumprod(np.full(n, _INVERSE))
    out = []
    for salt in (U(0), W.ODD[314]):
        s = W.mix(np.add.reduceat(W.mix(h ^ salt) * W.ODD[310 + place % 128], first) ^ salt)
        sums = np.concatenate([[U(0)], np.cumsum(s * power)])
        out.append(W.mix(((sums[b] - sums[a]) * under[a]) ^ ((b - a).astype(np.uint64) * W.ODD[309])))
    return np.stack(out), a, b


def _once(h: np.ndarray, doc: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Mask of each document's first run of each hash."""
    order = np.lexsort((a, h[1], h[0], doc))
    same = (h[:, order[1:]] == h[:, order[:-1]]).all(axis=0) & (doc[order][1:] == doc[order][:-1])
    out = np.ones(h.shape[1], bool)
    out[order[1:][same]] = False
    return out


def _own_runs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, document and place (first sentence << 16 | length) of each document's first run of each hash."""
    w = W.split(*W.flat(column))
    first = sentences(w)
    h, a, b = runs(w, first)
    bounds = np.searchsorted(first, w.first)
    doc = np.searchsorted(bounds, a, side="right") - 1
    one = _once(h, doc, a)
    h, a, b, doc = h[:, one], a[one], b[one], doc[one]
    return h, doc, ((a - bounds[doc]) << 16) | (b - a)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in W.pieces(batch, 0):
            yield pa.RecordBatch.from_arrays([pa.array(_own_runs(piece.column(0))[0][0].view(np.int64))], names=["h"])


def _bit(h: Column, bits: int) -> Column:
    return F.pmod(h, F.lit(bits)) + 1


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bits of the given hashes; at most bits / 8 bytes reach the driver."""
    rows = hashes.groupBy(F.bitmap_bucket_number(_bit(F.col("h"), bits)).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(_bit(F.col("h"), bits))).alias("part")).collect()
    out = np.zeros(max(bits >> 3, 4096), np.uint8)
    for k, part in rows:
        out[(k - 1) * 4096 : k * 4096] = np.frombuffer(part, np.uint8)
    return out


def _repeated(shared, bits: int):
    """The runs whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for batch in batches:
            for piece in W.pieces(batch, 0):
                h, doc, at = _own_runs(piece.column(0))
                bit = h[0].view(np.int64) % bits
                use = (marks[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
                doc, number = doc[use], [piece.column(k).to_numpy(zero_copy_only=False) for k in (1, 2)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[0][use].view(np.int64)), pa.array(h[1][use].view(np.int64)), pa.array(number[0][doc]), pa.array(number[1][doc]), pa.array(at[use])], names=["h", "g", "id", "th", "at"]
                )

    return run


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the sentences under their spans, with the counts of sentences and of those removed."""
    for batch in batches:
        for piece in W.pieces(batch, 0):
            spans = piece.column(1)
            w = W.split(*W.flat(piece.column(0)))
            first = sentences(w)
            bounds = np.searchsorted(first, w.first)
            at = spans.flatten().to_numpy().astype(np.int64)
            owner = bounds[np.repeat(np.arange(piece.num_rows), np.asarray(spans.value_lengths().fill_null(0)))]
            h, a, b = runs(w, first)
            again = ~_once(h, np.searchsorted(bounds, a, side="right"), a)
            a, b = np.concatenate([a[again], owner + (at >> 16)]), np.concatenate([b[again], owner + (at >> 16) + (at & 65535)])
            cover = np.zeros(len(first) + 1, np.int64)
            np.add.at(cover, a, 1)
            np.add.at(cover, b, -1)
            gone = np.cumsum(cover)[:-1] > 0
            n_gone = np.diff(np.concatenate([[0], np.cumsum(gone)])[bounds])
            # A sentence's bytes run to the next one; what stands before the first word of a text is its own.
            begin = w.starts[first]
            some = np.diff(bounds) > 0
            begin[bounds[:-1][some]] = w.docs[:-1][some]
            edge = np.append(begin, len(w.data))
            kept: list[bytes | None] = []
            raw = w.data.tobytes()
            missing = np.asarray(piece.column(0).is_null())
            for d in range(piece.num_rows):
                lo, hi = bounds[d], bounds[d + 1]
                if missing[d]:
                    kept.append(None)
                elif n_gone[d] == 0:
                    kept.append(raw[w.docs[d] : w.docs[d + 1]])
                else:
                    turns = np.flatnonzero(np.diff(np.concatenate([[True], gone[lo:hi], [True]]))) + lo
                    kept.append(b"".join(raw[edge[j] : edge[k] if k < hi else w.docs[d + 1]] for j, k in turns.reshape(-1, 2)))
            new_text = pa.array(kept, pa.binary()).cast(pa.string())
            rest = [piece.column(k) for k in range(2, piece.num_columns)]
            yield pa.RecordBatch.from_arrays([new_text, pa.array(np.diff(bounds)), pa.array(n_gone), *rest], names=["text", "n_sentences", "n_removed", *piece.schema.names[2:]])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    text = F.col(f"`{text_col}`").cast("string")
    return [text.alias("text"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64(text).alias("th")]


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(id, th, spans) of the documents that hold a non-first occurrence; th is the hash of the text, a missing id the largest.

    A span is first sentence << 16 | number of sentences.
    """
    rows = docs.select(*_keyed(docs, id_col, text_col)).where("text IS NOT NULL")
    # Rows of equal id and text count as one document.
    twice = rows.select("text").mapInArrow(_hashes, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(twice, bits))
    found = cut(rows.mapInArrow(_repeated(shared, bits), "h long, g long, id long, th long, at long"))
    first = found.groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct("id", "th", "at")).alias("first")).where("n > 1").select("h", "g", "first")
    later = found.join(first, ["h", "g"]).where(F.struct("id", "th", "at") != F.col("first"))
    return later.groupBy("id", "th").agg(F.collect_set("at").alias("spans"))


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The rows without the sentences of every later occurrence of a repeated passage.

    Adds n_sentences and n_removed, the number of those that went; a clashing input column of that name is replaced.
    """
    spans = repeated_spans(docs, id_col, text_col, bits)
    names = [c for c in docs.columns if c not in (text_col, "n_sentences", "n_removed")]
    keyed = docs.select(*_keyed(docs, id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
    joined = keyed.join(spans, ["id", "th"], "left").select("text", "spans", "_row")
    layout = T.StructType().add("text", "string").add("n_sentences", "long").add("n_removed", "long").add("_row", joined.schema["_row"].dataType)
    out = joined.mapInArrow(_rewrite, layout)
    back = [F.col("text").alias(c) if c == text_col else F.col(f"_row.`{c}`") for c in docs.columns if c not in ("n_sentences", "n_removed")]
    return out.select(*back, "n_sentences", "n_removed")
