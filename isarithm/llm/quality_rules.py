"""Quality rules as a stored bitmask ledger, in DataFrame expressions only.

Every rule is evaluated once per document. Its verdict is one bit of `fail_bits`, its measurement a
column, and both are written: the ledger is a Parquet table. Policies are masks over its bits, so a
verdict, a new policy or an ablation reads the ledger and never the texts.

Defined cases: a null text has no words and no lines, like an empty one; a null anywhere else is
carried through; repeated rows and rows that share an id each get their own row; ties do not occur, as a
rule looks at one document alone; very long texts are measured whole, by a task that holds one text and
its words at a time; an empty table gives an empty ledger. Input columns other than the id and the text
are not read, or carried as they are, so their names cannot clash.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isarithm.llm.storage import fresh_dir

BLANKS = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"


class Rule(NamedTuple):
    """A rule's bit is its place in RULES; the document fails it where the SQL condition holds."""

    name: str
    fails: str


#: Append only: a rule's position is its bit in stored ledgers.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_trigrams", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "10 * n_symbols > 1 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 6 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("upper_case", "10 * n_upper > 3 * word_chars"),
    Rule("exclamations", "10 * n_exclaim > 2 * n_words"),
    Rule("many_digits", "10 * n_digits > 3 * word_chars"),
    Rule("ellipsis_lines", "10 * n_ellipsis_lines > 3 * n_lines"),
    Rule("bullet_lines", "10 * n_bullet_lines > 9 * n_lines"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}
#: Rules whose failure is the contract's base_failed.
BASE = ("few_words", "repeated_trigrams")
#: Versioned policies: a document is kept if it fails none of the named rules.
POLICIES = {
    "base": BASE,
    "v1": (*BASE, "many_symbols", "duplicate_lines", "word_length"),
    "v2": tuple(rule.name for rule in RULES),
}
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim",
    "n_digits", "n_ellipsis_lines", "n_bullet_lines",
)


def mask(names: tuple[str, ...]) -> int:
    return sum(BIT[name] for name in names)


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _covered(s: Column) -> Column:
    """Words under any of the repeated windows, from the windows' (hash, position) in order."""
    repeated = F.filter(
        F.transform(s, lambda x, j: F.when((x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["i"])),
        lambda p: p.isNotNull(),
    )
    return F.aggregate(
        F.sort_array(repeated),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, MEASURES...): everything that the rules read, one pass over each whole text."""
    return _measure(docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_text")), id_col)


def _measure(rows: DataFrame, key: str) -> DataFrame:
    """Measures of the column _text, beside the column `key`, which goes through as it is."""
    text = F.coalesce(F.col("_text").cast("string"), F.lit(""))
    count = lambda pattern: F.regexp_count("_t", F.lit(pattern)).cast("long")
    lines_that = lambda holds: F.size(F.filter("_l", holds)).cast("long")
    base = rows.select(key, text.alias("_t")).select(
        key, "_t", F.array_remove(F.split("_t", BLANKS), "").alias("_w"), F.filter(F.split("_t", "\n", -1), lambda line: line.rlike(WORD_CHAR)).alias("_l")
    )
    wide = base.select(
        key,
        F.size("_w").cast("long").alias("n_words"),
        (F.length("_t") - count(r"[\x20\x09-\x0D]")).alias("word_chars"),
        count(f"[{SYMBOLS}]").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.slice(F.transform("_w", lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2))), F.lit(1), F.greatest(F.lit(0), F.size("_w") - 2)).alias("_h"),
        count(r"\p{Lu}").alias("n_upper"),
        count("!").alias("n_exclaim"),
        count("[0-9]").alias("n_digits"),
        lines_that(lambda line: line.endswith("...") | line.endswith("…")).alias("n_ellipsis_lines"),
        lines_that(lambda line: line.startswith("- ") | line.startswith("* ") | line.startswith("• ")).alias("n_bullet_lines"),
    )
    repeats = F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        _let(F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))), _covered),
    )
    return wide.withColumn("n_repeat_words", F.coalesce(repeats, F.lit(0)).cast("long")).select(key, *MEASURES)


def _with_bits(measured: DataFrame) -> DataFrame:
    """Adds fail_bits: bit i is set where RULES[i] fails."""
    bits = [F.when(F.expr(rule.fails), F.lit(1 << i)).otherwise(0) for i, rule in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measured.withColumn("fail_bits", total.cast("int"))


def ledger(measured: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes the measured rows with fail_bits, now, and reads them back."""
    folder = folder or fresh_dir(measured.sparkSession, "ledger")
    _with_bits(measured).write.parquet(folder)
    return measured.sparkSession.read.parquet(folder)


def apply_policy(rows: DataFrame, policy: str = "v2", column: str = "kept") -> DataFrame:
    """Adds whether a document passes the policy; the stored bits are all that it needs."""
    return rows.withColumn(column, F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[policy]))) == 0)


def ablations(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """One row per rule of the policy: how many documents fail it, fail it alone, and pass without it.

    The ledger is first reduced to a count per bit pattern (at most 2 ** len(RULES) rows), then each
    rule is a bitwise condition over those counts.
    """
    whole = mask(POLICIES[policy])
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(whole)).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).alias("bit")) for name in POLICIES[policy]]))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    rest = F.col("bits").bitwiseAND(F.lit(whole) - F.col("r.bit"))
    count = lambda where: F.sum(F.when(where, F.col("n")).otherwise(0)).cast("long")
    return (
        patterns.select("bits", "n", rules.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"), F.col("r.bit").alias("bit"))
        .agg(count(hit).alias("n_fail"), count(hit & (rest == 0)).alias("n_only"), count(rest == 0).alias("n_kept_without"))
    )


def judge(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """Adds base_failed and kept to the rows of a ledger; what fails the base rules is not kept under any policy."""
    both = apply_policy(apply_policy(rows, "base", "base_failed"), policy)
    return both.withColumns({"kept": F.col("base_failed") & F.col("kept"), "base_failed": ~F.col("base_failed")})


def quality_rules(docs: DataFrame, policy: str = "v2", id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Measurements, fail_bits, base_failed and kept of every document, from a ledger that is written for it."""
    return judge(ledger(measure(docs, id_col, text_col), folder), policy)


def keep_good(docs: DataFrame, policy: str = "v2", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """The rows of documents that pass the base rules and the policy, with all their columns.

    Each row is judged by its bits in the pass that measures it. A ledger is written only where a folder
    is named, since it carries the rows beside their bits: a second copy of the corpus.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").alias("_text"))
    measured = _measure(rows, "_row")
    # Not deterministic for the planner, which would else measure once more for each condition on the bits.
    once = F.when(F.monotonically_increasing_id() >= 0, F.col("fail_bits"))
    bits = ledger(measured, folder) if folder else _with_bits(measured).withColumn("fail_bits", once)
    return judge(bits, policy).where("kept").select("_row.*")
