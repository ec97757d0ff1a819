"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps the measurements and
one bit per failed rule; versioned policies are masks over those bits, so a new
policy, or the question what a policy would keep without one of its rules, needs
the ledger and never the texts.

All of it is Spark SQL expressions within the row of a document: no shuffle, no
Python, and a text of any length costs n log n. Null texts count as empty: they
have no words and fail ``few_words``. Repeated rows are judged one by one. Other
columns, whatever their names, are not looked at. Windows are told apart by 64-bit
hashes within one document.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .texts import table

WINDOW = 5


class Rule(NamedTuple):
    name: str
    fails: str  # SQL over the measurements


class Policy(NamedTuple):
    """Rejects a document that fails a fatal rule, or more than ``tolerated`` of the others."""

    name: str
    version: int
    fatal: Sequence[str]
    counted: Sequence[str] = ()
    tolerated: int = 0


# The place of a rule is its bit: append new ones, never reorder.
RULES = [
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "n_symbols > n_words"),
    Rule("shouting", "2 * n_capitals > word_chars"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 25 * n_words"),
]
BASE = ("few_words", "repeated_words")
POLICIES = [
    Policy("base", 1, BASE),
    Policy("standard", 1, (*BASE, "symbols", "shouting"), ("repeated_lines", "short_words", "long_words"), 1),
    Policy("strict", 1, tuple(r.name for r in RULES)),
]
STANDARD = POLICIES[1]
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals")


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    places = {r.name: k for k, r in enumerate(rules)}
    return sum(1 << places[n] for n in set(names))


def measure(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and the measurements of ``text``."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select(*keep, text.alias("_text")).select(
        "*",
        F.array_remove(F.split(F.translate("_text", "\t\n\x0b\x0c\r", "     "), " "), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike("[^ \\t-\\r]")).alias("_lines"),
    )
    counted = words.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.aggregate("_words", F.lit(0).cast("long"), lambda total, w: total + F.length(w)).alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    window = F.transform(
        F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
        lambda i: F.xxhash64(*(F.get("_hashes", i + k) for k in range(WINDOW))),
    )
    places = counted.withColumn("_windows", F.when(F.col("n_words") > WINDOW, window))
    # Most texts repeat no window: only those that do are sorted.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("window"), i.alias("place")))
    )
    places = places.withColumn("_ordered", F.when(repeats, ordered)).drop("_windows", "_hashes")
    same = lambda x, i: F.coalesce(F.get("_ordered", i)["window"] == x["window"], F.lit(False))
    twice = F.filter("_ordered", lambda x, i: same(x, i - 1) | same(x, i + 1))
    starts = F.sort_array(F.transform(twice, lambda x: x["place"]))
    nothing = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("words"))
    covered = F.aggregate(
        starts,
        nothing,
        lambda seen, at: F.struct(
            at.alias("last"), (seen["words"] + F.least(F.lit(WINDOW), at - seen["last"])).alias("words")
        ),
        lambda seen: seen["words"],
    )
    measured = places.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    # Unfolded from one struct: a filter on a measurement is not pushed below this, where
    # each measurement would be computed once per use.
    return measured.select(*keep, F.inline(F.array(F.struct(*MEASURES))))


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep``, the measurements, and ``failed_bits``: bit k is set if rule k fails."""
    bits = (F.when(F.expr(r.fails), F.lit(1 << k).cast("long")).otherwise(0) for k, r in enumerate(rules))
    return measure(docs, keep).withColumn("failed_bits", reduce(Column.bitwiseOR, bits))


def rejects(policy: Policy, rules: Sequence[Rule] = RULES, without: Column | None = None) -> Column:
    """Whether ``policy`` rejects a row of the ledger; ``without``: bits to leave aside."""
    bits = F.col("failed_bits")
    if without is not None:
        bits = bits.bitwiseAND(F.bitwise_not(without))
    fatal, counted = (F.lit(mask(names, rules)).cast("long") for names in (policy.fatal, policy.counted))
    return (bits.bitwiseAND(fatal) != 0) | (F.bit_count(bits.bitwiseAND(counted)) > policy.tolerated)


def apply_policies(entries: DataFrame, policies: Sequence[Policy] = POLICIES) -> DataFrame:
    """The ledger with a column ``kept_<policy>_v<version>`` for each policy."""
    return entries.withColumns({f"kept_{p.name}_v{p.version}": ~rejects(p) for p in policies})


def ablation(
    entries: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Per policy and rule: documents that fail the rule, that the policy rejects, and
    that it would keep if it did not have this rule.

    The ledger folds to one row per distinct set of bits before anything is
    compared, so the rest costs (sets of bits) x (policies) x (rules).
    """
    folded = entries.groupBy("failed_bits").agg(F.count("*").alias("documents"))
    places = F.array(
        *(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << k).cast("long").alias("bit")) for k, r in enumerate(rules))
    )
    each = folded.withColumn("_place", F.explode(places)).select("*", "_place.*").drop("_place")
    verdicts = F.array(
        *(
            F.struct(
                F.lit(p.name).alias("policy"),
                F.lit(p.version).alias("version"),
                rejects(p, rules).alias("rejected"),
                rejects(p, rules, F.col("bit")).alias("still"),
            )
            for p in policies
        )
    )
    judged = each.withColumn("_verdict", F.explode(verdicts)).select("*", "_verdict.*")
    amount = lambda holds: F.sum(F.when(holds, F.col("documents")).otherwise(0))
    return judged.groupBy("policy", "version", "rule").agg(
        amount(F.col("failed_bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        amount(F.col("rejected")).alias("n_rejected"),
        amount(F.col("rejected") & ~F.col("still")).alias("n_rejected_by_it_alone"),
    )


def keep_good(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The rows of ``docs`` that ``policy`` keeps, all columns as they were.

    A row is unfolded from its verdict and not filtered by it: a filter would be pushed
    below the measurements, and each of them computed once per use.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    entries = ledger(docs.select(row, F.col("text")), keep=["_row"])
    return entries.select(F.inline(F.when(~rejects(policy), F.array("_row"))))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = ledger(table(spark, sf_dir, "documents"))
    base = F.col("failed_bits").bitwiseAND(F.lit(mask(BASE)).cast("long")) != 0
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & ~rejects(STANDARD)).alias("kept"), "failed_bits",
    )


_SPACE = r"[^\x20\x09-\x0D]"

MEASURED_SQL = rf"""
texts AS (
    SELECT row_number() OVER () AS r, {{columns}}, coalesce(text, '') AS body FROM {{source}}
),
words AS (SELECT r, regexp_extract_all(body, '{_SPACE}+') AS ws FROM texts),
grams AS (
    SELECT r, unnest(range(len(ws) - 4)) AS p, ws FROM words WHERE len(ws) >= 5
),
windows AS (SELECT r, p, list_slice(ws, p + 1, p + 5) AS g FROM grams),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(p, p + 5)) AS place FROM twice) GROUP BY r
),
split_lines AS (SELECT r, unnest(string_split(body, chr(10))) AS line FROM texts),
lines AS (
    SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
    FROM split_lines WHERE regexp_matches(line, '{_SPACE}') GROUP BY r
),
measured AS (
    SELECT texts.*, len(ws)::BIGINT AS n_words, length(array_to_string(ws, '')) AS word_chars,
        length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
        coalesce(n_lines, 0) AS n_lines,
        length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')) AS n_capitals
    FROM texts JOIN words USING (r) LEFT JOIN covered USING (r) LEFT JOIN lines USING (r)
),
judged AS (
    SELECT *, ({" + ".join(f"CASE WHEN {r.fails} THEN {1 << k} ELSE 0 END" for k, r in enumerate(RULES))})::BIGINT
        AS failed_bits
    FROM measured
),
verdicts AS (
    SELECT *, failed_bits & {mask(BASE)} <> 0 AS base_failed,
        failed_bits & {mask(STANDARD.fatal)} = 0
        AND bit_count(failed_bits & {mask(STANDARD.counted)}) <= {STANDARD.tolerated} AS kept
    FROM judged
)"""

QUERIES = {"op10_quality_rules": op10_quality_rules}
SQL = {
    "op10_quality_rules": "WITH "
    + MEASURED_SQL.format(columns="doc_id", source="documents")
    + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    kept AND NOT base_failed AS kept, failed_bits
FROM verdicts"""
}
