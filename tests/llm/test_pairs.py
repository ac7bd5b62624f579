"""Near copies, repeated passages and benchmark leaks against plain versions."""

import collections
import functools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from isarithm.llm import components, decontam, jaccard, substring
from isarithm.llm import words as W
from tests.llm.conftest import SCHEMA, edge_rows, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_classes(rows, n=5, least=0.8):
    rep = {}
    for i, t in rows:
        if t is not None:
            rep[t] = min((x for x in (rep.get(t), i) if x is not None), default=None)
    sets = {}
    for t, i in rep.items():
        w = WORD.findall(t)
        if w:
            sets[t] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))}
    links, up = collections.Counter(), {t: t for t in rep}

    def root(t):
        while up[t] != t:
            t = up[t]
        return t

    texts = list(sets)
    for a in range(len(texts)):
        for b in range(a):
            x, y = sets[texts[a]], sets[texts[b]]
            if len(x & y) / len(x | y) >= least:
                links[texts[a]] += 1
                links[texts[b]] += 1
                up[root(texts[a])] = root(texts[b])
    low = {}
    for t, i in rep.items():
        low[root(t)] = min((x for x in (low.get(root(t)), i) if x is not None), default=None)
    return [(i, rep[t], low[root(t)], links[t]) if t is not None else (i, i, i, 0) for i, t in rows]


def key(rows):
    return sorted(rows, key=repr)


def test_jaccard_edges(edges, clashing):
    want = key(plain_classes([r[:2] for r in edge_rows()]))
    for df in (edges, clashing):
        assert key(map(tuple, jaccard.jaccard_classes(df).collect())) == want


def test_jaccard_on_documents(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert key(map(tuple, jaccard.jaccard_classes(docs).collect())) == key(plain_classes(rows))


def test_jaccard_counts_links_of_a_split_group(spark):
    rng = random.Random(2)
    base = text(rng, 18).split()
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"edit{rng.randrange(1000)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard.jaccard_classes(df, block=16).collect()  # the group is dealt over many cells
    assert key(map(tuple, got)) == key(plain_classes(rows))


def test_overlaps_by_blocks(monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    base = text(rng, 12).split()
    texts = pa.array([" ".join(base[:i] + ["x"] + base[i + 1 :]) for i in range(0, 60, 3)])
    x, y = (np.array(v) for v in zip(*[(a, b) for a in range(20) for b in range(a + 1, 20)], strict=True))
    whole = jaccard._sizes_and_overlaps(texts, x, y, 5)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 1500)
    parts = jaccard._sizes_and_overlaps(texts, x, y, 5)
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))


def test_jaccard_empty(edges):
    assert jaccard.jaccard_classes(edges.limit(0)).count() == 0


def test_texts_that_share_an_id_keep_their_links(spark):
    rng = random.Random(14)
    a, b = text(rng, 20), text(rng, 20)
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, text(rng, 20)), (None, a), (None, a + " z w")]
    got = jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert key(map(tuple, got)) == key(plain_classes(rows))
    assert {(r["doc_id"], r["n_links"]) for r in got if r["doc_id"] == 3} == {(3, 1)}


def near_pairs(rng, n, edits):
    """Pairs of texts, the second with words replaced at the places of one of the edits, and their exact similarity."""
    rows, similar = [], {}
    for k in range(n):
        w = [f"w{rng.randrange(10**6)}" for _ in range(121)]
        v = list(w)
        for at in rng.choice(edits):
            v[at] = "edited"
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(v))]
        x, y = ({tuple(u[a : a + 5]) for a in range(117)} for u in (w, v))
        similar[2 * k] = len(x & y) / len(x | y)
    return rows, similar


def test_prefixes_are_shortened_until_the_recall_is_reached(spark, monkeypatch):
    """Pairs near a low threshold need shorter prefixes than those far over a high one; every link is found."""
    depths = []
    real = jaccard._links_at
    monkeypatch.setattr(jaccard, "_links_at", lambda reps, texts, depth, *rest: depths.append(depth) or real(reps, texts, depth, *rest))
    for threshold, edits, last in ((0.8, [[50]], 5), (0.8, [[20, 60, 63]], 4), (0.3, [[20, 60, 90], range(4, 60, 7), range(4, 75, 7)], 1)):
        rows, similar = near_pairs(random.Random(3), 150, edits)
        depths.clear()
        got = {r["doc_id"]: r["n_links"] for r in jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold).collect()}
        assert {k for k in similar if got[k]} == {k for k, s in similar.items() if s >= threshold}
        assert depths[0] == jaccard.MAX_DEPTH and depths[-1] <= last and depths == sorted(depths, reverse=True)
        assert threshold > 0.5 or depths[-1] < 4


def test_chances_to_meet_and_to_be_verified():
    """A pair at the threshold meets by the last depth, and its signatures agree enough, but for a chance of 1e-6."""
    from math import comb

    assert 1 - jaccard.chance(0.8, 4) < 1e-7 and jaccard.chance(0.8, 5) >= jaccard.SEEN > jaccard.chance(0.3, 3)
    n, least = jaccard.TREES * jaccard.MAX_DEPTH, jaccard._least_agreement(0.8)
    assert sum(comb(n, k) * 0.8**k * 0.2 ** (n - k) for k in range(least)) < 1e-6


def test_one_row_of_each_class_stays(spark, edges, clashing):
    for df in (edges, clashing):
        rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
        kept = jaccard.keep_first(df)
        assert kept.columns == df.columns
        want, classes = [], plain_classes(rows)
        seen = set()
        for (i, t), (_, own, low, _) in sorted(zip(rows, classes, strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
            if t is None or (i == own == low and (low, t) not in seen):
                seen.add((low, t))
                want.append((i, t))
        assert key((r["doc_id"], r["text"]) for r in kept.collect()) == key(want)
    rng = random.Random(9)
    t, other = text(rng, 20), text(rng, 20)
    rows = [(1, t, "a"), (1, t, "b"), (2, t + " more", "c"), (None, t, "d"), (None, other, "e"), (None, other, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [key(map(tuple, jaccard.keep_first(d).collect())) for d in (df, df.repartition(3), df.orderBy(F.desc("source")))]
    assert got[0] == got[1] == got[2] and len(got[0]) == 2 and {r[1] for r in got[0]} == {t, other}
    assert jaccard.keep_first(df.limit(0)).count() == 0


def test_cells_are_never_parted(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "HELD_ROWS", 7)
    cell = np.repeat(np.arange(30), np.random.default_rng(0).integers(1, 12, 30))
    batch = pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.arange(len(cell)))], names=["cell", "k"])
    for size in (1, 5, 40, len(cell)):
        tables = list(jaccard._runs(batch.slice(a, size) for a in range(0, len(cell), size)))
        assert np.concatenate([t.column(1).to_numpy() for t in tables]).tolist() == list(range(len(cell)))
        assert sum(len(set(t.column(0).to_pylist())) for t in tables) == 30


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (7, 7), (None, 4), (3, 1)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["id"]: r["class_id"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10} | {100 + i: 100 for i in range(41)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@functools.cache
def word_hash(word):
    import pyarrow as pa

    w = W.split(*W.flat(pa.array([word])))
    return int((W.mix(W.word_hashes(w) ^ W.ODD[313]) | np.uint64(1))[0])


def cut_sentences(t):
    """Natural sentences, and within them a cut after the least word of every CUT consecutive ones."""
    natural, prev = [], None
    for m in WORD.finditer(t):
        if prev is None or prev.group()[-1] in ".!?" or "\n" in t[prev.end() : m.start()]:
            natural.append([])
        natural[-1].append(m)
        prev = m
    out = []
    for s in natural:
        h, ends = [word_hash(m.group()) for m in s], {len(s) - 1}
        for a in range(len(s) - substring.CUT + 1):
            part = h[a : a + substring.CUT]
            ends |= {a + k for k, x in enumerate(part) if x == min(part)}
        lo = 0
        for e in sorted(ends):
            out.append(s[lo : e + 1])
            lo = e + 1
    return out


def plain_removal(rows):
    occurrences, parts = collections.defaultdict(list), {}
    key = {n: (i is None, i or 0, t) for n, (i, t) in enumerate(rows)}
    for n, (_, t) in enumerate(rows):
        if t is None:
            continue
        s = parts[n] = cut_sentences(t)
        w, size = [[m.group() for m in x] for x in s], [len(x) for x in s]
        found = set()
        for a in range(len(s)):
            b = next((b for b in range(a + substring.RUN, len(s) + 1) if sum(size[a:b]) >= substring.MIN_WORDS), None)
            if b:
                found.add((a, b))
            c = next((c for c in range(a + 1 - substring.RUN, -1, -1) if sum(size[c : a + 1]) >= substring.MIN_WORDS), None)
            if c is not None:
                found.add((c, a + 1))
        for a, b in found:
            occurrences[tuple(map(tuple, w[a:b]))].append((a, b, n))
    gone = collections.defaultdict(set)
    for found in occurrences.values():
        # Of rows with one id and several texts the order is that of text hashes, which no test row depends on.
        first = min((*key[n], a) for a, b, n in found)
        for a, b, n in found:
            if (*key[n], a) != first:
                gone[n] |= set(range(a, b))
    out = []
    for n, (i, t) in enumerate(rows):
        if n not in parts:
            out.append((i, t, 0, 0))
            continue
        s = parts[n]
        at = [x[0].start() for x in s] + [len(t)]
        at[0] = 0
        new = "".join(t[at[k] : at[k + 1]] for k in range(len(s)) if k not in gone[n]) if gone[n] else t
        out.append((i, new, len(s), len(gone[n])))
    return out


def test_substring_edges(edges, clashing):
    want = key(plain_removal([r[:2] for r in edge_rows()]))
    assert any(r[3] for r in want)
    for df in (edges, clashing):
        out = substring.drop_repeats(df)
        assert key(map(tuple, out.select("doc_id", "text", "n_sentences", "n_removed").collect())) == want
        assert [c for c in out.columns if c in df.columns and c != "n_removed"] == [c for c in df.columns if c != "n_removed"]
    assert substring.drop_repeats(edges.limit(0)).count() == 0


def test_substring_on_documents(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    out = substring.drop_repeats(docs).select("doc_id", "text", "n_sentences", "n_removed")
    assert key(map(tuple, out.collect())) == key(plain_removal(rows))


def test_a_planted_passage_goes_everywhere_but_once(spark):
    rng = random.Random(11)
    passage = " ".join(text(rng, 1) for _ in range(9))
    assert len(passage.split()) > 50
    rows = [(i, text(rng, 5) + "\n" + passage + "\n" + text(rng, 5)) for i in range(30)]
    out = {r["doc_id"]: r["text"] for r in substring.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert passage in out[0] and not any(passage[:80] in out[i] or passage[-80:] in out[i] for i in range(1, 30))
    assert all(out[i].startswith(rows[i][1][:40]) and out[i].endswith(rows[i][1][-40:]) for i in out)


@pytest.mark.parametrize(("stops", "length"), [(0, 60), (0, 54), (20, 54), (40, 60)])
def test_passages_at_any_offset_are_found(spark, stops, length):
    """Passages that start and end in mid-sentence, in text without stops or with sentences of up to 20 or 40 words.

    The check knows words alone: all of a passage but up to 2 * CUT - 1 words at either end must go from its second copy.
    """
    rng = random.Random(31 + stops + length)

    def running(n):
        out = []
        while len(out) < n:
            k = rng.randrange(stops // 2, stops + 1) if stops else n
            out += [f"v{rng.randrange(10**6)}" for _ in range(k)]
            out[-1] += "." if stops else ""
        return out[:n]

    rows, passages = [], []
    for k in range(50):
        p = running(200)[70 : 70 + length]
        passages.append(p)
        for copy in range(2):
            rows.append((2 * k + copy, " ".join(running(rng.randrange(30, 90)) + p + running(rng.randrange(30, 90)))))
    out = {r["doc_id"]: r for r in substring.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    ends = 2 * substring.CUT - 1
    for k, p in enumerate(passages):
        first, later = out[2 * k], out[2 * k + 1]
        assert first["text"] == rows[2 * k][1] and first["n_removed"] == 0
        assert later["n_removed"] > 0 and not set(p[ends:-ends]) & set(later["text"].split())
        assert [x for x in rows[2 * k + 1][1].split() if x not in set(p)] == [x for x in later["text"].split() if x not in set(p)]


def test_a_passage_twice_in_one_text_goes_once(spark):
    p = [f"p{i}" for i in range(60)]
    body = [f"a{i}" for i in range(37)] + p + [f"b{i}" for i in range(21)] + p + [f"c{i}" for i in range(9)]
    [row] = substring.drop_repeats(spark.createDataFrame([(1, " ".join(body))], "doc_id long, text string")).collect()
    got = row["text"].split()
    assert got[:118] == body[:118] and got[-9:] == body[-9:] and row["n_removed"] > 0 and len(got) <= 118 + 30 + 9


def test_rows_of_one_id_or_none_are_documents_of_their_own(spark):
    rng = random.Random(19)
    passage, own = text(rng, 9), [text(rng, 6) for _ in range(5)]
    rows = [(1, own[0]), (1, own[1] + "\n" + passage + "\n" + own[2]), (2, passage), (None, own[3] + "\n" + passage), (None, own[4]), (2, passage)]
    out = substring.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert key(map(tuple, out.select("doc_id", "text", "n_sentences", "n_removed").collect())) == key(plain_removal(rows))
    texts = [r["text"] for r in out.collect()]
    assert sum(passage[:60] in t for t in texts) == 1


def test_a_full_bitmap_loses_nothing(spark, docs):
    """However few bits there are, the result is the same."""
    want = substring.drop_repeats(docs).select("doc_id", "n_sentences", "n_removed", F.md5("text"))
    few = substring.drop_repeats(docs, bits=1 << 15).select("doc_id", "n_sentences", "n_removed", F.md5("text"))
    assert key(map(tuple, want.collect())) == key(map(tuple, few.collect()))


def test_runs_with_one_equal_hash_are_told_apart(monkeypatch, spark):
    """With all first hashes equal the second one still separates the runs."""
    real = substring.runs

    def blind(w, first, *rest):
        h, a, b = real(w, first, *rest)
        return np.stack([h[0] * np.uint64(0), h[1]]), a, b

    rng = random.Random(23)
    passage = text(rng, 9)
    rows = [(k, text(rng, 6) + "\n" + passage + "\n" + text(rng, 6)) for k in range(4)] + [(9, text(rng, 30))]
    import pyarrow as pa

    arrays = pa.array([t for _, t in rows])
    h, doc, at = substring._own_runs(arrays)
    monkeypatch.setattr(substring, "runs", blind)
    g, doc2, at2 = substring._own_runs(arrays)
    assert not g[0].any() and sorted(zip(g[1], doc2, at2)) == sorted(zip(h[1], doc, at))


def plain_align(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max()


def test_alignment_matches_the_table():
    rng = np.random.default_rng(0)
    items, windows = rng.integers(1, 6, (40, 9)).astype(np.uint64), rng.integers(1, 6, (40, 25)).astype(np.uint64)
    sizes = rng.integers(1, 10, 40)
    score, _ = decontam.align(items, sizes, windows)
    assert score.tolist() == [plain_align(a[:n].tolist(), w.tolist()) for a, n, w in zip(items, sizes, windows, strict=True)]


def fold(t):
    return [w for w in re.split(r"[^0-9a-z\x80-\U0010ffff]+", t.lower()) if w]


def plain_leaks(rows, items, least=decontam.LEAST):
    """Whole-text alignment of every pair, without seeds."""
    out = {}
    for i, t in rows:
        for k, b in items:
            if i is None or t is None or k is None or not b or not fold(b):
                continue
            a = fold(b)
            if len(a) < decontam.SEED and " ".join(a) not in " ".join(fold(t)):
                continue
            score = plain_align(a, fold(t)) / (2 * len(a))
            if score >= least:
                out[(i, k)] = max(out.get((i, k), 0), score)
    return out


def test_leaks_of_edited_copies(spark, edges):
    rng = random.Random(4)
    items = [(k, " ".join(text(rng, 1).lower().rstrip(".") + f" mark{k}{j}" for j in range(3))) for k in range(12)]
    rows = [(100 + k, text(rng, 4)) for k in range(20)]
    for k, b in items:
        w = b.split()
        for j in range(3, len(w), 7):
            w[j] = "swapped"
        rows.append((k, text(rng, 3) + " " + " ".join(w).upper() + ", " + text(rng, 3)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (None, "x y z"), (52, "!!!")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontam.leaks(df, bench).collect()}
    want = plain_leaks(rows, items)
    assert set(got) == set(want) == {(k, k) for k, _ in items}
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    # In blocks of five items each, the answer is the same.
    blocks = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(df, bench, block=5).collect()}
    assert blocks == set(want)
    kept = decontam.decontaminate(df, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(100, 120))


def test_leaks_edges(spark, edges, clashing):
    item = edge_rows()[0][1]
    bench = spark.createDataFrame([(1, " ".join(item.split()[5:40])), (2, "one two")], "item_id long, text string")
    for df in (edges, clashing):
        got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(df, bench).collect()}
        assert got == {(1, 1), (2, 1), (3, 1), (8, 2), (9, 2)}
        assert decontam.decontaminate(df, bench).columns == df.columns
    assert decontam.leaks(edges.limit(0), bench).count() == 0
    assert decontam.leaks(edges, bench.limit(0)).count() == 0
    assert decontam.decontaminate(edges, bench.limit(0)).count() == edges.count()


def test_common_passages_keep_their_seeds(spark):
    """A benchmark passage that most of the corpus holds is found though none of its seeds is rare."""
    rng = random.Random(8)
    item = text(rng, 3)
    rows = [(i, text(rng, 2) + " " + (item if i % 3 else "") + " " + text(rng, 2)) for i in range(150)]
    got = decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert {r["doc_id"] for r in got.collect()} == {i for i in range(150) if i % 3}


def test_edited_copies_of_common_items_are_found(spark):
    """Of items that many texts hold, whole or in part, a copy whose rarest seeds are edited away is found."""
    rng = random.Random(21)
    items = [(k, " ".join(f"w{k}x{j}" for j in range(45))) for k in range(8)]
    rows, edited = [], []
    for k, b in items:
        w = b.split() if k % 2 else b.split()[5:38]
        rows += [(100 * k + j, text(rng, 2) + " " + " ".join(w) + " " + text(rng, 2)) for j in range(40)]
        for at in rng.sample(range(3, len(w) - 3), 9 if k % 2 else 3):
            w[at] = "swapped"
        edited.append((1000 + k, text(rng, 2) + " " + " ".join(w) + " " + text(rng, 2)))
    rows += edited + [(5000 + k, text(rng, 4)) for k in range(20)]
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontam.leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = plain_leaks(edited, items)
    assert len(want) == 8 and set(want) <= set(got)
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want) and len(got) == 8 * 41


def test_rows_without_an_id_are_judged(spark):
    rng = random.Random(12)
    item = text(rng, 4)
    leak, clean = text(rng, 2) + " " + item, text(rng, 5)
    rows = [(None, leak), (None, clean), (None, None), (1, leak), (1, clean), (2, clean), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = decontam.decontaminate(df, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert key(map(tuple, kept)) == key(r for r in rows if r[1] != leak)


def test_bounds_hold():
    """No alignment scores over the bound by which it is left out."""
    import pyarrow as pa

    rng = random.Random(6)
    items = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 25))) for _ in range(200)]
    index = decontam.Index(np.arange(200), pa.array(items), 3)
    for _ in range(5):
        h, _first = decontam._hashed(pa.array([" ".join(f"w{rng.randrange(60)}" for _ in range(80))]))
        code = np.searchsorted(index.known, h)
        known = np.flatnonzero(index.known[np.minimum(code, len(index.known) - 1)] == h)
        begin = np.array([rng.randrange(60) for _ in items])
        bound = decontam._bounds(index, np.sort(code[known] * 81 + known), 81, np.arange(200), begin, begin + 20)
        for k in range(200):
            assert plain_align(index.words[index.first[k] : index.first[k + 1]].tolist(), h[begin[k] : begin[k] + 20].tolist()) <= bound[k]
