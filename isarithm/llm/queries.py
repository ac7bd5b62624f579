"""The driver's queries over this subpackage's operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isarithm.llm import bpe, chat, decontam, jaccard, langid, quality_model, quality_rules, sharding, substring, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item that align, with the share of the item's perfect score."""
    return decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the network learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    net = quality_model.train(docs, _table(spark, sf_dir, "labels").where(~quality_model.held_out()))
    verdict = (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted")
    return quality_model.score(docs, net).select("doc_id", quality_model.held_out().alias("held_out"), "score", verdict)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages say about every page."""
    manifest = warc.write(_table(spark, sf_dir, "pages"))
    return warc.read(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
h AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS head FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND head <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND head <> page_id THEN head END AS refers_to
FROM h
"""


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's measures, base verdict and the v2 policy's verdict of every document."""
    rows = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", *quality_rules.MEASURES, "fail_bits", "base_failed", "kept")


OP4_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS l
  FROM t),
tri AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM tri) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM hit) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, len(l) AS n_lines,
         length(t) - length(regexp_replace(t, '\\p{Lu}', '', 'g')) AS n_upper,
         length(t) - length(replace(t, '!', '')) AS n_exclaim,
         length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS n_digits,
         len(list_filter(l, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS n_ellipsis_lines,
         len(list_filter(l, lambda x: starts_with(x, '- ') OR starts_with(x, '* ') OR starts_with(x, '• '))) AS n_bullet_lines
  FROM w LEFT JOIN rep ON rep.doc_id = w.doc_id),
b AS (
  SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 10 * n_upper > 3 * word_chars THEN 32 ELSE 0 END) + (CASE WHEN 10 * n_exclaim > 2 * n_words THEN 64 ELSE 0 END)
    + (CASE WHEN 10 * n_digits > 3 * word_chars THEN 128 ELSE 0 END)
    + (CASE WHEN 10 * n_ellipsis_lines > 3 * n_lines THEN 256 ELSE 0 END)
    + (CASE WHEN 10 * n_bullet_lines > 9 * n_lines THEN 512 ELSE 0 END) AS INTEGER) AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_exclaim, n_digits,
       n_ellipsis_lines, n_bullet_lines, fail_bits, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept
FROM b
"""


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each rule of the v2 policy: documents that fail it, that fail it alone, and that pass without it."""
    rows = quality_rules.ledger(quality_rules.measure(_table(spark, sf_dir, "documents")))
    return quality_rules.ablations(rows, "v2")


ABLATION_SQL = (
    OP4_SQL[: OP4_SQL.rindex("SELECT doc_id, n_words")]
    + """, r(rule, bit) AS (VALUES ('few_words', 1), ('repeated_trigrams', 2), ('many_symbols', 4), ('duplicate_lines', 8), ('word_length', 16),
  ('upper_case', 32), ('exclamations', 64), ('many_digits', 128), ('ellipsis_lines', 256), ('bullet_lines', 512))
SELECT rule, bit, count(*) FILTER (WHERE (fail_bits & bit) <> 0) AS n_fail, count(*) FILTER (WHERE fail_bits = bit) AS n_only,
       count(*) FILTER (WHERE fail_bits = 0 OR fail_bits = bit) AS n_kept_without
FROM b, r GROUP BY rule, bit
"""
)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one more that holds control strings, read back from their formatted text."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), hard.alias("text"))
    done = chat.format_conversations(rows.unionByName(more))
    told = done.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"), "state", "valid")
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return told.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "state", "valid",
    )


OP5_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (
  SELECT *, 8 + 8 + 8 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS t,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS l,
         CAST(sum(chars) AS BIGINT) AS formatted_chars, arg_max(role, (turn, role, text)) AS last_role,
         bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') ELSE (before || '>' || role) IN ('system>user', 'user>assistant', 'assistant>user') END) AS ok
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(t) AS turns_sha256, length(l) AS loss_chars, sha256(l) AS loss_sha256, formatted_chars,
       CASE WHEN NOT ok THEN 'error' WHEN last_role = 'system' THEN 'instructed' WHEN last_role = 'user' THEN 'asked' ELSE 'answered' END AS state,
       ok AND last_role = 'assistant' AS valid
FROM g
"""


def tokenizer_path() -> str:
    """The tokenizer file that the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every text's ids, and the digest of what they decode to."""
    coded = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), keep_text=False)
    back = bpe.decode(coded, tokenizer_path())
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by the field learned from the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document at five words and 0.8."""
    return jaccard.jaccard_classes(_table(spark, sf_dir, "documents"))


def op9_consistent_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document among eight, by the law of near equal bytes."""
    rows = sharding.shard(_table(spark, sf_dir, "documents"), 8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later occurrences of repeated passages."""
    return substring.drop_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_sentences", "n_removed", "text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_decontamination": op1_decontamination, "op2_quality_classifier": op2_quality_classifier, "op3_warc": op3_warc, "op4_quality_rules": op4_quality_rules, "op5_chat": op5_chat, "op6_bpe": op6_bpe, "op7_language_id": op7_language_id, "op8_jaccard_join": op8_jaccard_join, "op9_consistent_hash": op9_consistent_hash, "op10_substring_dedup": op10_substring_dedup, "quality_rule_ablations": quality_rule_ablations}


def oracle_sql() -> dict[str, str]:
    return {"op3_warc": OP3_SQL, "op4_quality_rules": OP4_SQL, "op5_chat": OP5_SQL, "quality_rule_ablations": ABLATION_SQL}
