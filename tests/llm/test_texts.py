"""Rules, classifiers, tokens and formatting against plain versions, round trips and held-out accuracy."""

import collections
import hashlib
import pathlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from isarithm.llm import bpe, chat, langid, quality_model, quality_rules
from isarithm.llm.queries import tokenizer_path
from tests.llm.conftest import edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(t):
    t = t or ""
    w = WORD.findall(t)
    grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + d for i in range(len(w) - 2) if grams[(w[i], w[i + 1], w[i + 2])] > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


HARD = [
    None, "", "   ", "a", "a b", "a b c", "a b c a b c", "of " * 300, "x\n\nx\n \nx", "## %% || <a> & $ *", "é b\x0bc\x0cd", "A!! B!! C!! " * 40, "\n".join(f"line {i % 7} has some words" for i in range(80)),
    "0123 4567 " * 60, "a b c d e f g a b c x y z d e f",
]


def test_rules_match_the_plain_version(spark, clashing):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(None, "x y z")]
    out = quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted(((r["doc_id"], *[r[n] for n in names], r["base_failed"]) for r in out), key=repr)
    want = [(i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]) for i, t in rows for m in [plain_measures(t)]]
    assert got == sorted(want, key=repr)
    assert all(not r["kept"] for r in out if r["base_failed"])
    kept = quality_rules.keep_good(clashing)
    assert kept.columns == clashing.columns
    good = [r[0] for r in edge_rows() if plain_measures(r[1])[0] >= 50]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(good, key=repr)
    assert quality_rules.quality_rules(clashing.limit(0)).count() == 0


def test_ablations_follow_from_the_bits(spark, docs):
    rows = quality_rules.ledger(quality_rules.measure(docs)).select("doc_id", "fail_bits")
    bits = [r["fail_bits"] for r in rows.collect()]
    for policy, names in quality_rules.POLICIES.items():
        whole = quality_rules.mask(names)
        got = {r["rule"]: (r["n_fail"], r["n_only"], r["n_kept_without"]) for r in quality_rules.ablations(rows, policy).collect()}
        for name in names:
            b = quality_rules.BIT[name]
            assert got[name] == (sum(x & b > 0 for x in bits), sum(x & whole == b for x in bits), sum(x & (whole - b) == 0 for x in bits))


def test_the_ledger_is_stored_and_serves_all_policies(spark, docs, tmp_path, monkeypatch):
    folder = str(tmp_path / "ledger")
    first = quality_rules.quality_rules(docs, "v2", folder=folder)
    stored = spark.read.parquet(folder)
    assert set(quality_rules.MEASURES) < set(stored.columns) and "text" not in stored.columns and stored.count() == docs.count()
    monkeypatch.setattr(quality_rules, "_measure", None)  # later policies measure nothing
    for policy in quality_rules.POLICIES:
        kept = {r["doc_id"] for r in quality_rules.judge(stored, policy).where("kept").collect()}
        assert kept == {r["doc_id"] for r in stored.collect() if not r["fail_bits"] & quality_rules.mask(quality_rules.POLICIES[policy])}
    assert key(first) == key(quality_rules.judge(stored, "v2"))


def test_the_pipeline_leaves_no_second_corpus(spark, clashing, tmp_path):
    from isarithm.llm.storage import fresh_dir

    stored = lambda: set(pathlib.Path(fresh_dir(spark, "x").removeprefix("file:")).parent.glob("ledger-*"))
    before = stored()
    kept = quality_rules.keep_good(clashing)
    assert key(kept) == key(quality_rules.keep_good(clashing, folder=str(tmp_path / "ledger")))
    assert stored() == before
    assert kept._jdf.queryExecution().executedPlan().toString().count("array_remove(split(") == 1  # one pass measures


def key(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_bpe_equals_the_library(spark, docs, clashing):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokenizer_path())
    for df in (docs, clashing):
        coded = bpe.encode(df, tokenizer_path())
        back = bpe.decode(coded, tokenizer_path()).select("text", "n_tokens", "ids", "decoded").collect()
        for r in back:
            ids = tk.encode(r["text"] or "", add_special_tokens=False).ids
            assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
            assert r["decoded"] == tk.decode(ids, skip_special_tokens=False)
        assert coded.columns == [c for c in df.columns if c not in ("n_tokens", "ids")] + ["n_tokens", "ids"]
    assert bpe.encode(docs.limit(0), tokenizer_path()).count() == 0


def test_the_tokens_stage_keeps_one_worker_a_task(spark, docs, clashing):
    import corpus_pipeline

    for df in (docs, clashing):
        got = corpus_pipeline.tokens(spark, df, "")
        back = bpe.decode(bpe.encode(df, tokenizer_path(), keep_text=False), tokenizer_path(), out_col="text")
        assert got.columns == [c for c in df.columns if c not in ("n_tokens", "ids")] + ["n_tokens", "ids"]
        assert key(got) == key(back.select(*[F.col(f"`{c}`") for c in got.columns]))
        assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_bpe_hard_texts():
    from tokenizers import Tokenizer

    tk, own = Tokenizer.from_file(tokenizer_path()), bpe.Bpe(open(tokenizer_path(), encoding="utf-8").read())
    texts = ["", " ", "aaaaaaa aaaa", "<|endoftext|><|endoftext|>x<|endoftext", "\n\n \t x", "don't we'LL 'tis I've", "日本語😀½²", "=" * 999, "a\u0085b c", "\x00\x7f", "ǅ ß İ"]
    rng = np.random.default_rng(1)
    texts += ["".join(map(chr, rng.integers(32, 0x2FFF, 200))) for _ in range(60)]
    ids, bounds = own.encode(texts)
    for t, a, b, back in zip(texts, bounds, bounds[1:], own.decode(ids.astype(np.int64), bounds), strict=False):
        want = tk.encode(t, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want and back == tk.decode(want, skip_special_tokens=False)
    own.forget()
    again, _ = own.encode(texts[::-1])
    assert sorted(again.tolist()) == sorted(ids.tolist())
    assert own.decode(np.array([10**9, -1, 0]), np.array([0, 2, 3])) == ["", "!"]


def fb_plain(e, s, m):
    import itertools

    n, k = e.shape
    p, z = np.zeros((n, k)), 0
    for path in itertools.product(range(k), repeat=n):
        w = np.exp(s[path[0]] + sum(e[i, x] for i, x in enumerate(path)) + sum(m[a, b] for a, b in zip(path, path[1:], strict=False)))
        z += w
        for i, x in enumerate(path):
            p[i, x] += w
    return p / z


@pytest.mark.parametrize("block", [2, 3, 128])
def test_forward_backward(block):
    rng = np.random.default_rng(0)
    first = np.array([0, 7, 7, 8, 12])
    e, s, m = rng.normal(size=(12, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    got = langid.forward_backward(e, first, s, m, block)[0]
    for a, b in zip(first, first[1:], strict=False):
        if b > a:
            assert np.allclose(got[a:b], fb_plain(e[a:b], s, m))


def test_language_of_held_out_documents(spark, sf):
    from isarithm.llm.queries import op7_language_id

    docs = spark.read.parquet(sf.replace("sf0.001", "sf0.01") + "/documents.parquet")
    out = op7_language_id(spark, sf.replace("sf0.001", "sf0.01")).join(docs, "doc_id").where("held_out").collect()
    assert len(out) > 250 and np.mean([r["lang_pred"] == r["lang"] for r in out]) > 0.97
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in out)


def test_language_edges(spark, docs, clashing):
    model = langid.train(docs)
    got = langid.predict(clashing, model, keep=tuple(clashing.columns)).collect()
    assert len(got) == clashing.count()
    assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["text"] or "")) for r in got)
    assert {r["lang_pred"] for r in got} <= {"und", *model.languages}
    assert langid.predict(clashing.limit(0), model).count() == 0
    assert langid.train(docs.limit(0)) is None
    assert {r["lang_pred"] for r in langid.predict(docs, None).collect()} == {"und"}
    one = langid.train(docs.where("lang = 'en'"))
    assert {r["lang_pred"] for r in langid.predict(docs, one).collect()} == {"en"}


def test_words_of_switched_text(docs):
    model = langid.train(docs)
    by = {r["lang"]: r["text"] for r in docs.where("length(text) > 600").collect()}
    a, b = by["en"][:400], by["de"][:400]
    post, first = model.posteriors(pa.array([a + " " + b]))
    n = len(langid.W.split(*langid.W.flat(pa.array([a])), blank=langid._OTHER).starts)
    lang = [model.languages[i] for i in post.argmax(1)]
    assert lang[: n - 5].count("en") > 0.9 * (n - 5) and lang[n + 5 :].count("de") > 0.9 * (len(lang) - n - 5)
    runs = langid.segments(docs.limit(3), model).collect()
    assert all(sum(s["words"] for s in r["segments"]) >= 0 for r in runs)


def test_quality_of_held_out_documents(spark, sf):
    from isarithm.llm.queries import op2_quality_classifier

    big = sf.replace("sf0.001", "sf0.01")
    out = op2_quality_classifier(spark, big).join(spark.read.parquet(big + "/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = [r for r in out if r["quality"] == 1], [r for r in out if r["quality"] == 0]
    assert np.mean([r["predicted"] for r in good]) > 0.95 and np.mean([r["predicted"] for r in bad]) < 0.35


def plain_score(net, raw):
    """Every filter at every byte, the means of all chunks, their maxima, one probability; loops alone."""
    top = []
    for f in range(quality_model.FILTERS):
        out = []
        for i in range(len(raw)):
            z = net.b[f] + sum(net.w[j, raw[i + j], f] for j in range(quality_model.WIDTH) if i + j < len(raw))
            out.append(max(0.0, float(z)))
        half = quality_model.HALF
        chunks = [out[a : a + 2 * half] for a in range(0, max(1, len(raw)), half)]
        top.append(max(sum(c) / max(1, len(c)) for c in chunks))
    return 1 / (1 + np.exp(-(float(np.dot(top, net.v)) + net.c[0])))


def test_scores_equal_a_plain_convolution():
    rng, net = random.Random(2), quality_model.Net()
    raws = [bytes(rng.randrange(1, 256) for _ in range(n)) for n in (0, 1, 3, 127, 128, 129, 255, 256, 257, 700)]
    got = net.score(np.frombuffer(b"".join(raws), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raws])]))
    assert np.allclose(got, [plain_score(net, r) for r in raws], atol=1e-4)


def test_the_gradient_is_that_of_the_loss():
    rng, net = random.Random(5), quality_model.Net(3)
    for name in "wbvc":
        setattr(net, name, getattr(net, name).astype(np.float64))
    raws, labels = [bytes(rng.choice(b"abcdef") for _ in range(n)) for n in (40, 200, 300, 500)], np.array([0.0, 1.0, 1.0, 0.0])

    def loss():
        p = np.array([plain_score(net, r) for r in raws])
        rest = quality_model.DECAY / 2 * ((net.w**2).sum() + (net.v**2).sum())
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p)) + rest

    grad = quality_model.gradient(net, raws, labels)
    places = [("w", (j, ord(c), f)) for j, c, f in ((0, "a", 0), (2, "d", 5), (3, "f", 11))] + [("b", (4,)), ("v", (0,)), ("v", (7,)), ("c", (0,))]
    for name, at in places:
        value = getattr(net, name)
        keep = value[at]
        value[at] = keep + 1e-4
        up = loss()
        value[at] = keep - 1e-4
        down = loss()
        value[at] = keep
        assert abs((up - down) / 2e-4 - grad[name][at]) < 2e-4 + 0.02 * abs(grad[name][at])


def test_the_sample_is_bounded_when_ids_repeat(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "SAMPLE_PER_CLASS", 5)
    monkeypatch.setattr(quality_model, "STEPS", 5)
    seen = []
    monkeypatch.setattr(quality_model, "fit", lambda texts, y, prior, seed: seen.append(len(texts)) or 0.5)
    rows = [(i % 4, f"text {i}") for i in range(400)]
    quality_model.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, quality int"))
    assert seen == [20]


def test_languages_of_few_words_are_learned(spark):
    rows = [(i, "хлеб соль", "ru") if i % 2 else (i, "bread salt", "en") for i in range(60)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = langid.predict(spark.createDataFrame(rows[:2], "doc_id long, text string, lang string"), model).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {0: "en", 1: "ru"}


def test_quality_edges(spark, docs, sf, clashing):
    labels = spark.read.parquet(sf + "/labels.parquet")
    net = quality_model.train(docs, labels)
    alone = {r["doc_id"]: r["score"] for r in quality_model.score(docs, net).collect()}
    for r in docs.limit(5).collect():  # a score depends on nothing but the text
        raw = r["text"].encode()
        assert abs(net.score(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0] - alone[r["doc_id"]]) < 1e-9
    got = quality_model.score(clashing, net, keep=tuple(clashing.columns)).collect()
    assert len(got) == clashing.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not r["text"]}) == 1
    assert quality_model.score(clashing.limit(0), net).count() == 0
    assert quality_model.train(docs, labels.limit(0)) == 1.0
    assert quality_model.train(docs, labels.where("quality = 0")) == 0.0
    assert quality_model.score(docs, 0.0).agg(F.max("score")).first()[0] == 0.0
    odd = labels.union(spark.createDataFrame([(None, 1, 0), (3, None, None), (4, 9, 9)], labels.schema))
    assert isinstance(quality_model.train(docs, odd), quality_model.Net)


TURNS = [
    (1, 0, "system", "s"), (1, 1, "user", "<|turn|>user<|body|>\\ <| <\\| \\\\"), (1, 2, "assistant", "line\n<|end|>\n"), (2, 0, "assistant", "first"), (3, 0, "user", None), (3, 1, "assistant", ""),
    (4, 0, None, "x<"), (4, 1, "tool", "|y"), (None, None, "user", "q"), (5, 1, "assistant", "b"), (5, 0, "user", "a"), (5, 1, "assistant", "b"), (6, 0, "user", "end with <"), (6, 1, "assistant", "|> ü😀"),
]


def test_chat_reads_back(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumn("_id", F.lit(1))
    out = chat.format_conversations(df).withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.loss_text(F.col("segments"))}).collect()
    groups = collections.defaultdict(list)  # the one row without a conversation's id is one by itself
    for c, n, r, t in TURNS:
        groups[c].append((-1 if n is None else n, r or "", t or ""))
    assert {r["conv_id"] for r in out} == set(groups)
    for r in out:
        want = [(role, t) for _, role, t in sorted(groups[r["conv_id"]])]
        assert [tuple(x) for x in r["turns"]] == want
        assert r["loss"] == "".join(t for role, t in want if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
    state = {r["conv_id"]: (r["state"], r["valid"]) for r in out}
    assert state[1] == state[3] == state[6] == ("answered", True)
    assert state[2] == state[4] == state[5] == ("error", False) and state[None] == ("asked", False)
    assert chat.format_conversations(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat.format_conversations(df, chat.TURNS._replace(opens="[turn]"))


def plain_machine(roles, template):
    state, out = template.start, []
    for role in roles:
        to = template.moves.get((state, role))
        state = to or template.error
        out.append((state, role in template.trained and (to is not None or template.error_trains)))
    return out


def test_the_machine_emits_states_and_losses(spark):
    rng = random.Random(17)
    legal = ["system"] + ["user", "assistant"] * 100
    cases = [[], ["assistant"], ["user"], legal, legal[1:131], legal[:60] + ["user"] + legal[60:], [None, "user"], ["user", "tool", "assistant"]]
    cases += [[rng.choice(["user", "assistant", "system"]) for _ in range(rng.randrange(1, 9))] for _ in range(40)] + [["user", "assistant"] * k for k in (31, 32, 33, 64)]
    df = spark.createDataFrame([(i, [x or "" for x in c]) for i, c in enumerate(cases)], "i long, roles array<string>")
    for template in (chat.TURNS, chat.STRICT):
        for r in df.select("i", chat.machine(F.col("roles"), template).alias("out")).collect():
            assert [tuple(x) for x in r["out"]] == plain_machine([x or "" for x in cases[r["i"]]], template)


def test_a_strict_template_does_not_learn_past_an_error(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "assistant", "c"), (1, 3, "user", "d"), (1, 4, "assistant", "e"), (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for template, want in ((chat.TURNS, "bce"), (chat.STRICT, "b")):
        out = chat.format_conversations(df, template).withColumn("l", chat.loss_text(F.col("segments"))).collect()
        assert [r["l"] for r in out if r["conv_id"] == 1] == [want]
        assert sorted(r["state"] for r in out if r["conv_id"] is None) == ["asked", "error"]


def test_chat_query_holds_the_hard_conversation(spark, sf):
    from isarithm.llm.queries import op5_chat

    hard = "\\### Assistant: </turn> ok"
    row = op5_chat(spark, sf).where("conv_id = -7").first()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{hard}\nassistant\n{hard}\n".encode()).hexdigest()
    assert row["loss_sha256"] == hashlib.sha256(hard.encode()).hexdigest() and row["loss_chars"] == len(hard)


def test_quality_learns_from_long_documents(spark, monkeypatch):
    """All documents of a class are over 30,000 bytes long."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(("zzqx", "qqzk", "xkzz")) for _ in range(6200))) if i % 2 else (i, " ".join(rng.choice(("the", "and", "tree")) for _ in range(60))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(quality_model, "STEPS", 30)
    net = quality_model.train(docs, spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int"))
    assert isinstance(net, quality_model.Net)
    got = {r["doc_id"]: r["score"] for r in quality_model.score(docs, net).collect()}
    assert min(got[i] for i in range(1, 40, 2)) > max(got[i] for i in range(0, 40, 2))
