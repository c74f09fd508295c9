"""Quality rules as a bitmask ledger (DataFrame functions only).

Each text is measured once and every rule is evaluated once. The ledger keeps
the measurements and one BIGINT whose bit ``i`` is set when rule ``i`` fails.
A policy is a named, versioned set of rules, i.e. a mask: a document is kept
under a policy when ``failures & mask = 0``. Policies can therefore be changed,
compared and ablated on the stored ledger without reading a text again.

Everything up to the verdict is one narrow projection over the scan (no
shuffle). The ablation report first collapses the ledger to its distinct
failure masks (at most ``2 ** len(RULES)`` rows, with a map-side partial
count), then works on those.

Defined results: a null or empty text has no words, so all measurements are 0
and the word-count rule fails. Repeated rows are measured one by one; row
order and ties play no part. Input columns other than ``doc_id`` and ``text``
are not read by :func:`ledger`, so clashing names do no harm. An empty table
gives an empty ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts")

# Rule name -> SQL condition under which a document FAILS it. The position in
# this table is the bit number; append new rules, never renumber.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbol_density": "100 * n_symbols > 20 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 2 * n_words or word_chars > 15 * n_words",
    "shouting": "100 * n_shouts > 20 * n_words",
}
BASE_RULES = ("too_few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A named, versioned set of rules."""

    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return mask_of(self.rules)


def mask_of(rules: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(r) for r in set(rules))


BASE_POLICY = Policy("base", 1, BASE_RULES)
STANDARD_POLICY = Policy("standard", 1, tuple(RULES))


def _measured(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Words and lines as arrays, then counts. Repeated three-word windows are found by
    sorting (window hash, position) pairs of the document and looking at neighbours, and
    only for documents where the distinct hashes are fewer than the windows."""
    split = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    ).select("doc_id", "_text", words(F.col("_text")).alias("_w"),
             F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    hashed = split.select(
        "doc_id",
        F.size("_w").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        _count("_text", r"[#*$%&|<>]").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        _count("_text", "!").alias("n_shouts"),
        F.expr("transform(slice(_w, 1, greatest(size(_w) - 2, 0)), "
               "(x, i) -> xxhash64(x, _w[i + 1], _w[i + 2]))").alias("_h"),
    )
    paired = hashed.withColumn(
        "_s", F.expr("case when size(array_distinct(_h)) < size(_h) "
                     "then array_sort(transform(_h, (x, i) -> struct(x as h, i as i))) end"))
    return paired.withColumn("_hit", F.expr(
        "transform(filter(_s, (x, i) -> x.h <=> get(_s, i - 1).h or x.h <=> get(_s, i + 1).h), x -> x.i)")) \
        .withColumn("n_repeat_words", F.expr(
            "coalesce(size(array_distinct(flatten(transform(_hit, i -> array(i, i + 1, i + 2))))), 0)")
            .cast("bigint")) \
        .select("doc_id", *MEASURES)


def _count(column: str, pattern: str) -> Column:
    text = F.col(column)
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("bigint")


def failures() -> Column:
    """The failure mask, from the measurement columns."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
            for i, rule in enumerate(RULES.values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the measurements and ``failures``: one row per input row.

    The columns leave through a one-row generator: Spark copies a projected expression into
    every filter it pushes down, but none below a generator, so a filter on the ledger does not
    measure the texts again.
    """
    book = _measured(docs, doc_id, text).withColumn("failures", failures())
    return book.select("doc_id", F.inline(F.array(F.struct(*MEASURES, "failures"))))


def passes(policy: Policy, column: str = "failures") -> Column:
    return F.col(column).bitwiseAND(F.lit(policy.mask).cast("bigint")) == 0


def apply_policy(book: DataFrame, policy: Policy = STANDARD_POLICY) -> DataFrame:
    """Ledger rows with ``base_failed`` and the policy's verdict ``kept``."""
    return (book.withColumn("base_failed", ~passes(BASE_POLICY))
            .withColumn("kept", ~F.col("base_failed") & passes(policy)))


def ablation(book: DataFrame, policies: tuple[Policy, ...] = (STANDARD_POLICY,)) -> DataFrame:
    """Per policy and rule: ``n_failed`` rows that fail the rule, and ``n_only`` rows the
    policy would keep without it. Works on counts per distinct mask, by bit operations."""
    per_mask = book.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    order = list(RULES)
    entries = F.explode(F.array(*[
        F.struct(F.lit(p.name).alias("policy"), F.lit(p.version).alias("version"), F.lit(r).alias("rule"),
                 F.lit(1 << order.index(r)).cast("bigint").alias("bit"), F.lit(p.mask).cast("bigint").alias("mask"))
        for p in policies for r in order if r in p.rules]))
    seen = per_mask.select("failures", "n", entries.alias("e")).select("failures", "n", "e.*")
    failed = F.col("failures").bitwiseAND(F.col("mask"))
    return (seen.groupBy("policy", "version", "rule")
            .agg(F.sum(F.when(failed.bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(failed == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only")))


def keep_documents(docs: DataFrame, policy: Policy = STANDARD_POLICY,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pipeline form: the rows of ``docs`` (all columns) that the policy keeps.

    The whole row rides along as one struct, so no column of ``docs`` can clash with a
    measurement and nothing is shuffled.
    """
    row = docs.select(F.struct(*docs.columns).alias("_row"))
    book = apply_policy(ledger(row.select(F.col("_row").alias("_id"), F.col(f"_row.{text}").alias("_text")),
                               "_id", "_text"), policy)
    return book.filter("kept").select("doc_id.*")


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS rid FROM documents),
w AS (SELECT rid, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
             len(l)::BIGINT AS n_lines, len(regexp_extract_all(text, '!'))::BIGINT AS n_shouts
      FROM w LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
              + CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END
              + CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
              + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END
              + CASE WHEN 100 * n_shouts > 20 * n_words THEN 32 ELSE 0 END)::BIGINT AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouts, failures,
       base_failed, failures = 0 AS kept FROM f
"""
