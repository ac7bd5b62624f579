"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification.

Each distinct text has a MinHash signature of TREES labels of MAX_DEPTH values. A tree is the sorted
labels of all texts, cut at a prefix: texts with one prefix stand together. Matching begins at the
longest prefix. Texts that share it in some tree are compared, candidate pairs are verified exactly on
their whole shingle sets, and the links found estimate what was missed: a link of similarity s meets at
depth d with chance p = 1 - (1 - s^d)^TREES, so it stands for 1/p - 1 links that did not. While that
estimate leaves the recall under the target, or links at the threshold would meet with a chance under
SEEN (so that too few of them were there to count), all prefixes are shortened by one value and pairs
that meet only now are compared.

Pairs are never rows. A prefix with many texts is dealt out as cells of block against block, and a
cell hands on, for each of its texts, how many new links it has there and the smallest text it is
linked to. A pair that meets in several trees counts in the first of them only.

Defined cases: texts are equal byte by byte, and equal texts form one class that is compared once,
whatever ids their rows have; a text of 1 to n - 1 words has one shingle, of all its words; a text
without words has no shingle and no link, but groups with its equals; a null text is a class of its own;
rows without an id take part like all others, but name no class: text_id and class_id are null where no
row of the text, or of the class, has an id; one id on several texts names all their classes; repeated
rows come back as often as they occur. Very long texts fill a cell sooner and are verified in blocks of
BLOCK_BYTES: a task holds about two blocks of BLOCK texts of LONG characters, or of fewer longer ones.
Only the id and the text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isarithm.llm import words as W
from isarithm.llm.components import components
from isarithm.llm.storage import cut

TREES = 32
MAX_DEPTH = 5
THRESHOLD = 0.8
#: Share of all links that the forest is to meet, by its own estimate.
TARGET_RECALL = 0.999999
#: Least chance of meeting a link at the threshold at which the links found can be trusted as evidence.
SEEN = 0.9999
SHINGLE = 5
#: Texts of one prefix that a cell holds of either side, and bytes of texts that are verified at a time.
BLOCK = 256
BLOCK_BYTES = 8 << 20
#: Rows and bytes of cells that are held at a time, beyond one cell.
HELD_ROWS, HELD_BYTES = 1 << 14, 64 << 20
#: A text counts once more towards a cell's bound for each so many characters.
LONG = 1 << 15
#: A pair whose signatures agree in a smaller part than this, 8 standard errors under the threshold, is not verified.
SLACK = 8.0
U = np.uint64


def chance(similarity, depth: int, trees: int = TREES):
    """Of two texts to share a prefix of this length in some tree."""
    return 1 - (1 - np.asarray(similarity, float) ** depth) ** trees


def _least_agreement(threshold: float) -> int:
    n = TREES * MAX_DEPTH
    return int(n * max(0.0, threshold - SLACK * (threshold * (1 - threshold) / n) ** 0.5))


def signatures(data: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """MinHash values (texts, TREES, MAX_DEPTH) of every text, and its number of shingles."""
    w = W.split(data, at)
    s, bounds = W.shingles(W.word_hashes(w), w.first, n)
    count = np.diff(bounds)
    out = np.zeros((len(count), TREES * MAX_DEPTH), np.uint16)
    some = np.flatnonzero(count)
    if len(some):
        for k in range(out.shape[1]):
            least = np.minimum.reduceat(((s ^ W.ODD[40 + k]) * W.ODD[200 + k]) >> U(32), bounds[some]).astype(np.uint32)
            out[some, k] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out.reshape(-1, TREES, MAX_DEPTH), count


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of a 2-d array as one binary value each."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _sign(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in W.pieces(batch, 0):
                sig, count = signatures(*W.flat(piece.column(0)), n)
                weight = (1 + np.diff(W.flat(piece.column(0))[1]) // LONG).astype(np.int32)
                yield pa.RecordBatch.from_arrays([piece.column(1), piece.column(2), pa.array(np.where(count > 0, weight, 0), pa.int32()), _fixed(sig.reshape(len(sig), -1))], names=["id", "h", "weight", "sig"])

    return run


def _prefix(sig: Column, tree: Column, depth: int) -> Column:
    """The label's first `depth` values in a tree."""
    return sig.substr(tree * (2 * MAX_DEPTH) + 1, F.lit(2 * depth))


def _prefixes(sig: np.ndarray, depth: int) -> np.ndarray:
    """A 64-bit number for each text's and tree's prefix, (texts, TREES)."""
    h = np.zeros(sig.shape[:2], np.uint64)
    for d in range(depth):
        h = W.mix((h ^ sig[:, :, d].astype(np.uint64)) * W.ODD[30 + d])
    return h


def _pairs(group: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of equal group, which is in runs; at most about `most` pairs at a time."""
    end = np.searchsorted(group, group, side="right")
    count = end - np.arange(len(group)) - 1
    total = np.concatenate([[0], np.cumsum(count)])
    lo = 0
    while lo < len(group):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + most, side="right")) - 1)
        c = count[lo:hi]
        i = np.repeat(np.arange(lo, hi), c)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(c) - c, c)
        if len(i):
            yield i, j
        lo = hi


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches regrouped into tables of about HELD_ROWS rows or HELD_BYTES, so that no cell (column 0) is in two of them."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        while batch.num_rows:
            room = max(1, HELD_ROWS - rows) if sum(b.nbytes for b in held) < HELD_BYTES else 1
            if batch.num_rows < room:
                held.append(batch)
                rows += batch.num_rows
                break
            cell = batch.column(0).to_numpy(zero_copy_only=False)
            # The first row at or after the limit where a new cell begins.
            new = np.flatnonzero(np.diff(cell[room - 1 :]))
            if len(new) == 0:
                held.append(batch)
                rows += batch.num_rows
                break
            to = room + int(new[0])
            held.append(batch.slice(0, to))
            yield pa.Table.from_batches(held)
            held, rows, batch = [], 0, batch.slice(to)
    if held:
        yield pa.Table.from_batches(held)


def _new_pairs(table: pa.Table, depth: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a cell that met in no earlier tree and at no longer prefix, and agree enough to be verified."""
    col = lambda name: table.column(name).chunk(0)
    cell, tree = col("cell").to_numpy(), col("tree").to_numpy()
    own, other = col("own").to_numpy(), col("other").to_numpy()
    data, at = W.flat(col("sig"))
    sig = data.view(np.uint16).reshape(len(at) - 1, TREES, MAX_DEPTH)
    keys = _prefixes(sig, depth)
    longer = _prefixes(sig, depth + 1) if depth < MAX_DEPTH else None
    sig = sig.reshape(len(sig), -1)
    for i, j in _pairs(cell):
        use = (own[i] == other[i]) | (own[i] != own[j])
        i, j = i[use], j[use]
        for k in range(TREES):
            later = np.flatnonzero(tree[i] > k)
            seen = np.zeros(len(i), bool)
            seen[later] = keys[i[later], k] == keys[j[later], k]
            if longer is not None:
                seen |= longer[i, k] == longer[j, k]
            i, j = i[~seen], j[~seen]
        for lo in range(0, len(i), 1 << 15):
            a, b = i[lo : lo + (1 << 15)], j[lo : lo + (1 << 15)]
            close = (sig[a] == sig[b]).sum(1) >= least
            if close.any():
                yield a[close], b[close]


def _to_verify(depth: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            table = table.combine_chunks()
            need = np.zeros(table.num_rows, bool)
            for i, j in _new_pairs(table, depth, least):
                need[i], need[j] = True, True
            if need.any():
                yield from table.filter(pa.array(need)).to_batches()

    return run


def _overlaps(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sorted sets, through products of 0/1 matrices where pairs are many."""
    out = np.empty(len(i), np.int64)
    if len(i) < 200:
        for k, (a, b) in enumerate(zip(i, j, strict=True)):
            x, y = (sets[a], sets[b]) if len(sets[a]) <= len(sets[b]) else (sets[b], sets[a])
            at = np.searchsorted(y, x)
            out[k] = np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x)
        return out
    used = np.unique(np.concatenate([i, j]))
    values, code = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True)
    row = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
    shared = np.bincount(code, minlength=len(values)) > 1  # a shingle of one text meets nothing
    place = np.cumsum(shared) - 1
    keep = shared[code]
    row, code = row[keep], place[code[keep]]
    a, b = np.searchsorted(used, i), np.searchsorted(used, j)
    total = np.zeros((len(used), len(used)), np.float32)
    for lo in range(0, int(shared.sum()), 4096):
        part = (code >= lo) & (code < lo + 4096)
        m = np.zeros((len(used), 4096), np.float32)
        m[row[part], code[part] - lo] = 1
        total += m @ m.T
    return np.rint(total[a, b]).astype(np.int64)


def _sizes_and_overlaps(text: pa.Array, x: np.ndarray, y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of texts the sum of their numbers of shingles, and how many they share.

    Texts are taken in blocks of at most BLOCK_BYTES, and pairs by their two blocks, so long texts bound the work's memory too.
    """
    length = np.diff(W.flat(text)[1])
    block = (np.cumsum(length) - length) // BLOCK_BYTES
    total, both = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    pair = block[x] * (block[-1] + 1) + block[y]
    for p in np.unique(pair):
        k = np.flatnonzero(pair == p)
        used = np.unique(np.concatenate([x[k], y[k]]))
        w = W.split(*W.flat(text.take(pa.array(used))))
        s, bounds = W.shingles(W.word_hashes(w), w.first, n)
        sets = [np.unique(s[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
        size = np.array([len(v) for v in sets])
        i, j = np.searchsorted(used, x[k]), np.searchsorted(used, y[k])
        total[k], both[k] = size[i] + size[j], _overlaps(sets, i, j)
    return total, both


def _verify(n: int, depth: int, least: int, threshold: float):
    """(k, low, links, missed) of each text with links in a cell; `missed` is its half of the links that theirs stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            table = table.combine_chunks()
            ids, cell = table.column("k").to_numpy(), table.column("cell").to_numpy()
            found = list(_new_pairs(table, depth, least))
            if not found:
                continue
            i, j = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(i, kind="stable")
            i, j = i[order], j[order]
            links, least_id, missed = np.zeros(len(ids), np.int64), ids.copy(), np.zeros(len(ids))
            text = table.column("text").chunk(0)
            edges = np.flatnonzero(np.concatenate([[True], cell[i][1:] != cell[i][:-1]]))
            for lo, hi in zip(edges, [*edges[1:], len(i)], strict=True):
                a, b = i[lo:hi], j[lo:hi]
                mine = np.unique(np.concatenate([a, b]))
                x, y = np.searchsorted(mine, a), np.searchsorted(mine, b)
                total, both = _sizes_and_overlaps(text.take(pa.array(mine)), x, y, n)
                # Jaccard >= threshold without division: both >= t * (|A| + |B| - both)
                good = both * (1 + threshold) + 1e-9 >= threshold * total
                a, b = a[good], b[good]
                p = chance(both[good] / np.maximum(total[good] - both[good], 1), depth)
                np.add.at(missed, a, 1 / np.maximum(p, 1e-12) - 1)
                np.add.at(links, a, 1)
                np.add.at(links, b, 1)
                while True:  # smallest text of each linked part of the cell
                    low = np.minimum(least_id[a], least_id[b])
                    before = least_id[mine].copy()
                    np.minimum.at(least_id, a, low)
                    np.minimum.at(least_id, b, low)
                    if (before == least_id[mine]).all():
                        break
            some = links > 0
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(least_id[some]), pa.array(links[some]), pa.array(missed[some])], names=["k", "low", "links", "missed"])

    return run


def _links_at(reps: DataFrame, texts: DataFrame, depth: int, n: int, threshold: float, block: int) -> DataFrame:
    """The links of pairs that meet at this depth and at none below it, as _verify gives them."""
    least = _least_agreement(threshold)
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    # A text without shingles weighs nothing and stands in no tree.
    leaves = reps.where("weight > 0").select("k", "weight", "sig", trees).select("k", "weight", "tree", F.xxhash64("tree", _prefix(F.col("sig"), F.col("tree"), depth)).alias("key"))
    crowded = leaves.groupBy("key").agg(F.count("*").alias("n"), F.sum("weight").alias("m")).where("n > 1").drop("n")
    leaves = leaves.drop("weight")
    blocks = F.ceil(F.col("m") / block).cast("int")
    placed = leaves.join(crowded, "key").select("k", "tree", "key", blocks.alias("blocks"), F.pmod(F.xxhash64("k"), blocks).cast("int").alias("own"))
    cells = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("against")).select(
        F.xxhash64("key", F.least("own", "against"), F.greatest("own", "against")).alias("cell"), "k", "tree", "own", F.col("against").alias("other")
    )
    met = cells.join(reps.select("k", "sig"), "k").select("cell", "k", "tree", "own", "other", "sig")
    layout = "cell long, k long, tree int, own int, other int, sig binary"
    need = cut(met.repartition("cell").sortWithinPartitions("cell", "k").mapInArrow(_to_verify(depth, least), layout))
    # Whole texts of the few texts that have a pair to verify, once per cell.
    wanted = need.select("k").distinct().join(reps.select("k", "h"), "k")
    whole = texts.join(wanted, "h").groupBy("k").agg(F.first("text").alias("text"))
    verified = need.join(whole, "k").select("cell", "k", "tree", "own", "other", "sig", "text")
    return cut(verified.repartition("cell").sortWithinPartitions("cell", "k").mapInArrow(_verify(n, depth, least, threshold), "k long, low long, links long, missed double"))


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def text_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, block: int = BLOCK
) -> DataFrame:
    """(h, text_id, class_k, class_id, n_links) of every different text, h being its MD5.

    class_k numbers the classes of connected texts; text_id and class_id are the smallest ids of their rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("text IS NOT NULL")
    texts = rows.select(_digest(F.col("text")).alias("h"), "text")
    signed = rows.select("text", "id", _digest(F.col("text")).alias("h")).mapInArrow(_sign(n), "id long, h binary, weight int, sig binary")
    grouped = signed.groupBy("h").agg(F.min("id").alias("id"), F.first("weight").alias("weight"), F.first("sig").alias("sig"))
    # Texts are numbered once and for all by being written.
    reps = cut(grouped.select(F.monotonically_increasing_id().alias("k"), "*"))
    found: DataFrame | None = None
    for depth in range(MAX_DEPTH, 0, -1):
        links = _links_at(reps, texts, depth, n, threshold, block)
        found = links if found is None else found.unionByName(links)
        if chance(threshold, depth) >= SEEN:
            seen, missed = found.agg(F.coalesce(F.sum("links"), F.lit(0)) / 2, F.lit(0.0)).first()[0], links.agg(F.coalesce(F.sum("missed"), F.lit(0.0))).first()[0]
            if seen >= recall * (seen + missed):
                break
    counted = found.groupBy("k").agg(F.sum("links").alias("n_links"))
    linked = components(found.where("k <> low").select(F.col("k").alias("a"), F.col("low").alias("b"))).select(F.col("id").alias("k"), F.col("class_id").alias("class_k"))
    labelled = reps.select("k", "h", F.col("id").alias("text_id")).join(linked, "k", "left").join(counted, "k", "left")
    whole = labelled.select("h", "text_id", F.coalesce("class_k", "k").alias("class_k"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    names = whole.join(linked.select("class_k").distinct(), "class_k", "left_semi").groupBy("class_k").agg(F.min("text_id").alias("class_id"))
    return whole.join(names, "class_k", "left").select("h", "text_id", "class_k", F.coalesce("class_id", "text_id").alias("class_id"), "n_links")


def jaccard_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, block: int = BLOCK
) -> DataFrame:
    """(id, text_id, class_id, n_links) of every row.

    text_id is the smallest id with an equal text, n_links the number of different texts at or over
    the threshold, class_id the smallest id of the connected texts.
    """
    classes = text_classes(docs, id_col, text_col, n, threshold, recall, block)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.when(F.col(f"`{text_col}`").isNotNull(), _digest(F.col(f"`{text_col}`").cast("string"))).alias("h"))
    own = lambda c: F.when(F.col("h").isNull(), F.col("id")).otherwise(F.col(c)).alias(c)
    return rows.join(classes, "h", "left").select(F.col("id").alias(id_col), own("text_id"), own("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row of each class, with all its columns; rows of null texts stay.

    That of the smallest id stays (rows without an id come last), and of equal ids the smallest digest
    of the text; of rows that agree in both the one whose other columns have the smallest hash.
    """
    order = F.struct(F.col("text_id").isNull(), F.col("text_id"), F.col("h"))
    first = text_classes(docs, id_col, text_col, **params).groupBy("class_k").agg(F.min_by(F.struct("h", "text_id"), order).alias("f")).select("f.h", "f.text_id")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.when(F.col(f"`{text_col}`").isNotNull(), _digest(F.col(f"`{text_col}`").cast("string"))).alias("h"), F.col(f"`{id_col}`").cast("long").alias("id"), row)
    kept = rows.join(first, "h").where(F.col("id").eqNullSafe(F.col("text_id")))
    one = kept.groupBy("h").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*").unionByName(rows.where("h IS NULL").select("row.*"))
