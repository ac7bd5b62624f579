"""Language identification by a linear-chain conditional random field over words.

A word is a run of ASCII letters and bytes over 127, lower-cased. Its features are its affixes (two
and three bytes at either end), its byte trigrams with the word's edges, and its entry in a lexicon of
words seen often in training, or a mark for words outside it. Weights of features and of transitions
between adjacent words' languages are learned together by the gradient of the chain's likelihood,
from sequences spliced of spans of documents in different languages, so that switches occur. A
text's words are labelled by forward-backward; the text's language is the one with the largest sum
of word posteriors, and its score that sum's share.

Training reads at most SAMPLE documents a language, those with the smallest hash of the id, and SPANS
spans of SPAN characters of each. Predictions read the whole text and nothing else.

Defined cases: null texts and texts without a letter get `und` and score 0; a text with letters always
gets a learned language; with no training rows every language is `und`; with one language that one
has score 1; rows with a null language or id are not learned from; repeated rows get equal results;
ties go to the language first in order; other columns are not read. Memory is bounded by the longest
single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isarithm.llm import words as W
from isarithm.llm.carry import with_kernel

BITS = 17
SAMPLE = 400
SPANS = 3
SPAN = 400
SEQUENCES = 6000
EPOCHS = 3
BATCH = 100
RATE = 0.3
LEXICON_AT = 3
U = np.uint64
_OTHER = np.ones(256, dtype=bool)
_OTHER[128:] = False
_OTHER[65:91] = False
_OTHER[97:123] = False


class Features:
    """Indices into the weight table of the words of a piece of text."""

    def __init__(self, w: W.Words, lexicon: np.ndarray):
        self.w = w
        slot = lambda code, kind: ((code + U(kind << 40)) * W.ODD[400 + kind] >> U(64 - BITS)).astype(np.int64)
        inside = np.zeros(len(w.data) + 2, np.int64)
        letters = ~_OTHER[w.data]
        inside[1:-1] = np.where(letters, w.data, 0)
        at = np.flatnonzero(letters)
        first, last = np.zeros(len(w.data), bool), np.zeros(len(w.data), bool)
        first[w.starts], last[w.ends - 1] = True, True
        left, right = np.where(first[at], 0, inside[at]), np.where(last[at], 0, inside[at + 2])
        self.grams = slot((left << 16 | inside[at + 1] << 8 | right).astype(np.uint64), 0)
        size = w.ends - w.starts
        self.gram_bounds = np.concatenate([[0], np.cumsum(size)])
        b = lambda k: np.where(k, 1, 0)
        data = np.concatenate([w.data, np.zeros(3, np.uint8)]).astype(np.int64)
        two, three = size >= 2, size >= 3
        head2 = data[w.starts] << 8 | data[w.starts + 1] * b(two)
        head3 = head2 << 8 | data[np.minimum(w.starts + 2, len(data) - 1)] * b(three)
        tail2 = data[w.ends - 1] << 8 | data[np.maximum(w.ends - 2, 0)] * b(two)
        tail3 = tail2 << 8 | data[np.maximum(w.ends - 3, 0)] * b(three)
        h = W.word_hashes(w)
        known = np.zeros(len(h), bool)
        if len(lexicon):
            known = lexicon[np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)] == h
        self.whole = np.stack([slot(x.astype(np.uint64), k) for k, x in enumerate((head2, head3, tail2, tail3, np.where(known, h, U(0))), 1)], axis=1)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """Each word's sum of weight rows."""
        if not len(self.whole):
            return np.zeros((0, table.shape[1]), table.dtype)
        out = np.add.reduceat(table[self.grams], self.gram_bounds[:-1], axis=0)
        for k in range(self.whole.shape[1]):
            out += table[self.whole[:, k]]
        return out

    def spread(self, rows: np.ndarray) -> np.ndarray:
        """The transpose of sums: each word's row added to all its features' rows."""
        where = np.concatenate([self.grams, self.whole.ravel()])
        word = np.concatenate([np.repeat(np.arange(len(rows)), np.diff(self.gram_bounds)), np.repeat(np.arange(len(rows)), self.whole.shape[1])])
        return np.stack([np.bincount(where, weights=rows[word, k], minlength=1 << BITS) for k in range(rows.shape[1])], axis=1)


def _steps(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains longest first, their first words, and how many of them are still running at each step."""
    length = np.diff(first)
    order = np.argsort(-length, kind="stable")
    left = length[order]
    running = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), side="right")
    return order, first[:-1][order], running


def _run(e: np.ndarray, first: np.ndarray, enter: np.ndarray, leave: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors and expected transitions of chains with given messages into their first and last words."""
    k = e.shape[1]
    order, base, running = _steps(first)
    enter, leave = enter[order], leave[order]
    alpha, beta = np.empty_like(e), np.empty_like(e)
    now = enter
    for step, m in enumerate(running):
        at = base[:m] + step
        now = (now[:m] @ t if step else now[:m]) * e[at]
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
    expected = np.zeros((k, k))
    after = leave[:0]
    for step in range(len(running) - 1, -1, -1):
        m = running[step]
        at = base[:m] + step
        if len(after):
            ahead = e[at[: len(after)] + 1] * after
            now = ahead @ t.T
            here = alpha[at[: len(after)]]
            expected += ((here / (here * now).sum(axis=1, keepdims=True)).T @ ahead) * t
            after = now / now.sum(axis=1, keepdims=True)
        if len(after) < m:  # chains whose last word this is
            after = np.concatenate([after, leave[len(after) : m]])
        beta[at] = after
    post = alpha * beta
    return post / post.sum(axis=1, keepdims=True), expected


def forward_backward(emit: np.ndarray, first: np.ndarray, start: np.ndarray, move: np.ndarray, block: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Posterior label probabilities of every word of the chains emit[first[i]:first[i + 1]].

    All chains advance together. Chains longer than a block are cut: each block's transfer matrix is
    formed for all blocks at once, messages then pass from block to block, and with these the blocks
    are run as chains of their own. That is exact, and a long text costs few steps. The second value
    is the expected number of each transition within blocks.
    """
    n, k = emit.shape
    if n == 0:
        return emit, np.zeros((k, k))
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    t = np.exp(move - move.max()).astype(e.dtype)
    begin = np.exp(start - start.max()).astype(e.dtype)
    length = np.diff(first)
    if length.max() <= block:
        return _run(e, first, np.tile(begin, (len(length), 1)), np.ones((len(length), k), e.dtype), t)
    per = -(-length // block)
    owner = np.concatenate([[0], np.cumsum(per)])
    total = owner[-1]
    cut = np.repeat(first[:-1] - owner[:-1] * block, per) + np.arange(total) * block
    order, base, running = _steps(np.append(cut, n))
    g = np.zeros((total, k, k), e.dtype)  # in order of `order`
    for step, m in enumerate(running):
        at = base[:m] + step
        g[:m] = np.einsum("nij,jk->nik", g[:m], t) * e[at][:, None, :] if step else np.eye(k, dtype=e.dtype) * e[at][:, None, :]
        g[:m] /= g[:m].sum(axis=(1, 2), keepdims=True)
    matrix = np.empty_like(g)
    matrix[order] = g
    enter, leave = np.tile(begin, (total, 1)), np.ones((total, k), e.dtype)
    for j in range(1, per.max()):
        b = owner[:-1][per > j] + j
        u = np.einsum("ni,nij->nj", enter[b - 1], matrix[b - 1]) @ t
        enter[b] = u / u.sum(axis=1, keepdims=True)
    for j in range(per.max() - 1, 0, -1):
        b = owner[:-1][per > j] + j
        u = np.einsum("nij,nj->ni", matrix[b], leave[b]) @ t.T
        leave[b - 1] = u / u.sum(axis=1, keepdims=True)
    return _run(e, np.append(cut, n), enter, leave, t)


class Crf:
    """Languages in order, a table of feature weights, and start and transition weights."""

    def __init__(self, languages: list[str]):
        k = len(languages)
        self.languages = languages
        self.table = np.zeros((1 << BITS, k))
        self.start, self.move = np.zeros(k), np.zeros((k, k))
        self.lexicon = np.zeros(0, np.uint64)
        self.narrow = self.table.astype(np.float32)

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors of all words of the texts, and each text's word bounds."""
        w = W.split(*W.flat(pc.utf8_lower(texts)), blank=_OTHER)
        return forward_backward(Features(w, self.lexicon).sums(self.narrow), w.first, self.start, self.move)[0], w.first

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        post, first = self.posteriors(texts)
        total = np.concatenate([np.zeros((1, len(self.languages))), np.cumsum(post, axis=0)])
        total = total[first[1:]] - total[first[:-1]]
        best = total.argmax(axis=1)
        n = np.diff(first)
        share = np.where(n > 0, total[np.arange(len(n)), best] / np.maximum(n, 1), 1 / len(self.languages))
        return [self.languages[b] for b in best], np.clip(share, 0, 1)


def fit(spans: list[tuple[str, str]], seed: int = 11) -> Crf:
    """A field learned from (language, text) spans, by AdaGrad on spliced sequences."""
    model = Crf(sorted({lang for lang, _ in spans}))
    rng = np.random.default_rng(seed)
    number = {lang: i for i, lang in enumerate(model.languages)}
    raw = [text.lower().encode() for _, text in spans]
    label = np.array([number[lang] for lang, _ in spans])
    w = W.split(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]), blank=_OTHER)
    values, counts = np.unique(W.word_hashes(w), return_counts=True)
    model.lexicon = values[counts >= LEXICON_AT]
    usable = np.flatnonzero(np.diff(w.first) > 0)
    by_lang = [usable[label[usable] == k] for k in range(len(model.languages))]
    by_lang = [x for x in by_lang if len(x)]
    memory = [np.full_like(x, 1e-3) for x in (model.table, model.start, model.move)]
    if not by_lang:
        return model
    for _ in range(EPOCHS * SEQUENCES // BATCH):
        words, truth, sizes = [], [], []
        for _ in range(BATCH):
            size = 0
            for _ in range(rng.integers(1, 4)):
                pool = by_lang[rng.integers(len(by_lang))]
                span = pool[rng.integers(len(pool))]
                lo, hi = w.first[span], w.first[span + 1]
                if hi - lo >= 4:
                    lo, hi = lo + 1, hi - 1  # the span's ends may cut words
                a = rng.integers(lo, hi)
                b = min(hi, a + int(rng.integers(3, 25)))
                words.append(np.arange(a, b))
                truth.append(np.full(b - a, label[span]))
                size += b - a
            sizes.append(size)
        pick, y = np.concatenate(words), np.concatenate(truth)
        first = np.concatenate([[0], np.cumsum(sizes)])
        # The picked words as a text of their own: their bytes with a blank after each.
        part = [w.data[a:b].tobytes() for a, b in zip(w.starts[pick], w.ends[pick], strict=True)]
        own = W.split(np.frombuffer(b" ".join(part), np.uint8), np.array([0, sum(map(len, part)) + len(part) - 1]), blank=_OTHER)
        f = Features(own, model.lexicon)
        post, expected = forward_backward(f.sums(model.table), first, model.start, model.move)
        grad = post
        grad[np.arange(len(y)), y] -= 1
        seen = np.zeros_like(expected)
        inner = np.setdiff1d(np.arange(len(y) - 1), first[1:-1] - 1)
        np.add.at(seen, (y[inner], y[inner + 1]), 1)
        steps = (f.spread(grad) / BATCH, grad[first[:-1]].sum(axis=0) / BATCH, (expected - seen) / BATCH)
        for value, g, m in zip((model.table, model.start, model.move), steps, memory, strict=True):
            m += g * g
            value -= RATE * g / np.sqrt(m)
    model.narrow = model.table.astype(np.float32)
    return model


def held_out(id_col: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Crf | None:
    """The field learned from the given rows; the number of different languages must fit the driver."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    sizes = {row[0]: row[1] for row in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    drawn = F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1_000_000))
    chance = F.create_map(*[x for lang, n in sorted(sizes.items()) for x in (F.lit(lang), F.lit(min(1_000_000, 2_000_000 * sample // n + 1)))])
    begin = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.greatest(F.lit(1), F.length("text") - SPAN)).cast("int") + 1
    spans = rows.where(drawn < F.element_at(chance, F.col("lang"))).select("lang", F.xxhash64("id", F.lit("langid")).alias("rank"), "id", *[F.col("text").substr(begin(k), F.lit(SPAN)).alias(f"s{k}") for k in range(SPANS)])
    # The first `sample` rows of each language by hash; each task keeps no more than that of its own.
    place = F.row_number().over(Window.partitionBy("lang").orderBy("rank", "id", "s0"))
    found = spans.withColumn("place", place).where(F.col("place") <= sample).orderBy("lang", "place").collect()
    return fit([(row["lang"], text) for row in found for text in dict.fromkeys(row[f"s{k}"] for k in range(SPANS))])


def predict(docs: DataFrame, model: Crf | None, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, lang_pred and score."""
    text = F.col(f"`{text_col}`").cast("string")
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in keep if c not in ("lang_pred", "score")], F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(given: list[pa.Array]) -> list[pa.Array]:
        lang, score = shared.value.predict(given[0])
        has = np.asarray(given[1])
        return [pa.array([x if ok else "und" for x, ok in zip(lang, has, strict=True)], pa.string()), pa.array(np.where(has, score, 0.0))]

    letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    return with_kernel(docs, [text, letter], kernel, [("lang_pred", T.StringType()), ("score", T.DoubleType())], list(keep), lambda batch: W.pieces(batch, 0))


def segments(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, segments): the runs of words of one language in each text, in order, with their numbers of words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, 0):
                post, first = shared.value.posteriors(piece.column(0))
                best = post.argmax(axis=1)
                out = []
                for a, b in zip(first, first[1:], strict=False):
                    cut = np.flatnonzero(np.diff(best[a:b])) + 1
                    edge = [0, *cut.tolist(), b - a] if b > a else [0]
                    out.append([{"lang": shared.value.languages[best[a + x]], "words": y - x} for x, y in zip(edge, edge[1:], strict=False)])
                kind = pa.list_(pa.struct([("lang", pa.string()), ("words", pa.int64())]))
                yield pa.RecordBatch.from_arrays([piece.column(1), pa.array(out, kind)], names=["id", "segments"])

    given = docs.select(F.col(f"`{text_col}`").cast("string").alias("_text"), F.col(f"`{id_col}`").cast("long").alias("id"))
    return given.mapInArrow(run, "id long, segments array<struct<lang: string, words: bigint>>").withColumnRenamed("id", id_col)
