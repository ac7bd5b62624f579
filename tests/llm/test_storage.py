"""Archives, shards, the pipeline, and that nothing else needs this subpackage."""

import collections
import hashlib
import io
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from isarithm.llm import sharding, warc
from tests.llm.conftest import edge_rows
from tests.llm.test_pairs import plain_classes, plain_leaks, plain_removal
from tests.llm.test_texts import plain_measures

SHARED = "<p>" + "same words here " * 100 + "</p>"
PAGES = [
    (1, "http://a/1", SHARED), (2, "http://a/2", SHARED), (9, None, SHARED), (9, None, SHARED), (3, "http://a/\r\nX: y", "small"), (4, "http://ü/ b", "small"), (5, "http://a/5", None), (6, "http://a/6", ""),
    (None, "http://a/n", SHARED), (7, "http://a/7", "ü" * 600 + "\r\n\r\nWARC/1.1\r\n"), (8, "x", "z" * 300_000),
]


def test_archives_roundtrip(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    manifest = warc.write(df)
    out = warc.read(manifest).collect()
    assert len(out) == len(PAGES) == manifest.agg(F.sum("records")).first()[0]
    text = {i: (h or "").encode() for i, _, h in PAGES}
    for r in out:
        raw = text[r["page_id"]]
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == hashlib.sha1(raw).hexdigest()
        if r["record_type"] == "response":
            assert bytes(r["payload"]) == raw
    kinds = sorted(((r["page_id"], r["record_type"], r["refers_to"]) for r in out), key=repr)
    want = [(i, "revisit", 9) if i in (1, 2) else (i, "response", None) for i, _, _ in PAGES]
    assert kinds == sorted(want, key=repr)
    assert warc.read(warc.write(df.limit(0))).count() == 0


def test_dictionary_leads_and_helps():
    rng = random.Random(1)
    rows = [warc.record(i, f"http://a/{i}", ("<html><body class='page'>" + " ".join(rng.choice(["foo", "bar", "baz"]) for _ in range(30))).encode(), None, "2024-01-01T00:00:00Z") for i in range(600)]
    whole = warc.archive(rows)
    assert whole[:4] == (0x184D2A5D).to_bytes(4, "little")
    assert list(warc.records_in(io.BytesIO(whole), 777)) == rows
    import zstandard

    assert len(whole) < sum(len(zstandard.ZstdCompressor().compress(r)) for r in rows)
    few = warc.archive(rows[:2])
    assert few[:4] == whole[:4] and list(warc.records_in(io.BytesIO(few))) == rows[:2]  # its records' bytes are the dictionary
    assert list(warc.records_in(io.BytesIO(warc.archive(rows[:1])), 3)) == rows[:1]
    with pytest.raises(ValueError):
        list(warc.records_in(io.BytesIO(whole[:-5])))
    broken = warc.record(1, "u", b"abc", None, "d").replace(b"abc", b"abd")
    with pytest.raises(ValueError):
        warc.parse(broken)


def test_shards_are_even_and_gapless(spark, docs, clashing):
    for df, even in ((docs, True), (clashing, False)):
        rows = sharding.shard(df, 8).collect()
        assert len(rows) == df.count()
        size, slots = collections.Counter(), collections.defaultdict(list)
        texts = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in df.select("doc_id", "text").collect())
        assert texts == collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
        for r in rows:
            size[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if even:
            assert max(size.values()) < 1.02 * min(size.values())
    assert sharding.shard(docs.limit(0), 8).count() == 0
    by = collections.defaultdict(set)
    for r in sharding.shard(clashing, 8).collect():
        by[r["doc_id"]].add(r["shard"])
    assert all(len(s) == 1 for s in by.values())


def plain_shards(sizes, shards):
    """The shard of each key, by walking the ring node by node; sizes: key's cell -> bytes."""
    nodes = sorted((int.from_bytes(hashlib.sha256(f"{s}/{v}".encode()).digest()[:8], "big") % sharding.CELLS, s) for s in range(shards) for v in range(sharding.VIRTUAL))
    bound, held, out = (1 + sharding.SLACK) * sum(sizes.values()) / shards, [0] * shards, {}
    for cell in sorted(sizes, key=lambda c: (-sizes[c], c)):
        at = next((k for k, (p, _) in enumerate(nodes) if p >= cell), 0)
        way = list(dict.fromkeys(s for _, s in nodes[at:] + nodes[:at]))
        to = next((s for s in way if held[s] + sizes[cell] <= bound), min(way, key=lambda s: (held[s], way.index(s))))
        held[to] += sizes[cell]
        out[cell] = to
    return out


def test_shards_equal_a_plain_walk(spark, docs):
    cells = docs.select("doc_id", sharding.cell_of(F.col("doc_id")).alias("c"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("n")).collect()
    for shards in (3, 8):
        sizes = collections.Counter()
        for r in cells:
            sizes[r["c"]] += r["n"]
        want = plain_shards(sizes, shards)
        assert {r["doc_id"]: r["shard"] for r in sharding.shard(docs, shards).collect()} == {r["doc_id"]: want[r["c"]] for r in cells}


def test_a_hot_key_is_cut_in_parts(spark):
    """Half of the rows share an id, a quarter have none: slots are gapless, and no task orders all of them."""
    rows = [(7 if i % 2 else None if i % 4 else i, f"text {i % 700}") for i in range(4000)]
    out = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 4)
    slots = collections.defaultdict(list)
    for r in out.collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == 4000
    assert len({r["shard"] for r in out.where("doc_id = 7").collect()}) == 1


def test_few_keys_move_when_a_shard_is_added():
    rng = np.random.default_rng(0)
    cell, load = np.arange(20000), rng.integers(1, 5000, 20000)
    a, b = sharding.walk(cell, load, 8), sharding.walk(cell, load, 9)
    assert 1 / 9 - 0.01 < load[a != b].sum() / load.sum() < 0.25
    held = np.bincount(a, weights=load)
    assert held.max() <= (1 + sharding.SLACK) * load.sum() / 8 + load.max()
    heavy = load.copy()
    heavy[7] = load.sum()  # one key with half of all bytes
    out = sharding.walk(cell, heavy, 8)
    rest = np.bincount(out, weights=heavy, minlength=8)
    assert rest[out[7]] - heavy[7] < rest.sum() / 8 and len(set(out)) == 8


def test_sharded_files(spark, docs, tmp_path):
    sharding.write(docs, str(tmp_path / "s"), 4)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4


def plain_pipeline(rows, items):
    from isarithm.llm import quality_rules

    def good(t):
        n, chars, symbols, dup, repeat = plain_measures(t)
        lines = len([x for x in (t or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")])
        upper = sum(c.isupper() and c.lower() != c or c in "ǅ" for c in t or "")
        return not (n < 50 or 100 * repeat > 50 * n or 10 * symbols > n or 10 * dup > 6 * lines or chars < 2 * n or chars > 15 * n or 10 * upper > 3 * chars or 10 * (t or "").count("!") > 2 * n or 10 * sum(c in "0123456789" for c in t or "") > 3 * chars)

    assert len(quality_rules.RULES) == 10
    rows = [r for r in rows if good(r[1])]
    first, kept = set(), []
    for (i, t), (_, own, low, _) in sorted(zip(rows, plain_classes(rows), strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0)):
        if i == own == low and (low, t) not in first:
            first.add((low, t))
            kept.append((i, t))
    rows = [(i, t) for i, t, n, gone in plain_removal(kept) if gone == 0 or gone < n]
    hit = {t for t in {t for _, t in rows} if items and plain_leaks([(0, t)], items)}
    return [(i, t) for i, t in rows if t not in hit]


def test_pipeline_on_edges(spark, edges, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES][0] == "quality_rules" and len(corpus_pipeline.STAGES) == 5
    rng = random.Random(77)
    lone = " ".join(f"{rng.choice(['river', 'stone', 'garden', 'window'])}{k} runs here." for k in range(40))
    more = spark.createDataFrame([(None, lone, "en", "b", 1), (None, lone, "en", "c", 2), (None, edge_rows()[10][1], "en", "b", 1)], edges.schema)
    edges = edges.unionByName(more)
    extra = edges.withColumns({c: F.lit(1) for c in ("id", "h", "k", "row", "_row", "n_removed", "n_sentences", "ids")})
    item = " ".join(edge_rows()[10][1].split()[3:30])
    extra.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()), key=repr)
    want = plain_pipeline([tuple(r) for r in edges.select("doc_id", "text").collect()], [(1, item)])
    assert got == sorted(want, key=repr) and (None, lone) in want
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert set(extra.columns) <= set(out.columns) and out.where("n_removed <> 1 OR n_sentences <> 1").count() == 0
    few = extra.drop("n_chars", "n_removed")  # the stages need no column but the id and the text
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, few, str(tmp_path)).columns == few.columns
    empty = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
        assert empty.count() == 0


def test_pipeline_on_documents(spark, docs, sf):
    import corpus_pipeline

    from isarithm.llm import decontam

    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(sf + "/benchmark.parquet").collect()]
    got = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.run(spark, sf).collect())
    before = plain_pipeline(rows, [])
    df = spark.createDataFrame(before, "doc_id long, text string")
    hit = {r["doc_id"] for r in decontam.leaks(df, spark.read.parquet(sf + "/benchmark.parquet")).collect()}
    exact = {i for i, t in before for _, b in items if " ".join(b.split()) in " ".join(t.split())}
    assert exact <= hit
    assert got == sorted((i, t) for i, t in before if i not in hit)


def test_the_rest_stands_alone(tmp_path):
    """With both folders gone, and the pipeline's file left, the entry and the rest's tests work."""
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(root, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    assert (tmp_path / "r" / "corpus_pipeline.py").exists()
    alone = os.environ | {"PYTHONPATH": str(tmp_path / "r")}
    code = "import __spark_entry__ as e; q = e.queries(); assert 'surface_cell_max' in q and not any(n.startswith('op') and n[2].isdigit() or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env=alone, check=True)
    subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-x", "--collect-only"], cwd=tmp_path / "r", env=alone, check=True)
    subprocess.run([sys.executable, "-m", "pytest", "tests/test_geometry.py", "-q", "-x"], cwd=tmp_path / "r", env=alone, check=True)
