"""Line de-duplication with a fixed-depth log-template tree (DataFrame functions only).

Lines are parsed like log messages. A line's path in the tree is its token count
and its first ``depth`` tokens; tokens that hold a digit are variable from the
start. A leaf holds any number of templates: one for every choice of ``agree`` of
``SEGMENTS`` equal stretches of the tokens and the words on them; the other
stretches are the template's variable fields. So a line belongs to a template
whatever other lines its leaf holds. A template that occurs in enough different
texts is boilerplate: all its lines are dropped. Copies of one text count once, so
a text's copies, however many, never drop its lines. Templates of ``LONG_TOKENS``
tokens need ``long_docs`` texts, shorter ones ``short_docs``.

All state is plain aggregates with map-side partial sums. Leaves that too few
documents reach hold no template and leave first. Equal lines in enough documents
are settled next, once per line text and not per document; only the lines left
over (each in few documents) are counted under all their choices. A line that a
third of all documents hold therefore never meets in one task. Only (document
key, line number, hashes) rows are shuffled for this; the texts are shuffled
once, to meet their dropped line numbers.

A template needs constant words. A line with fewer than ``LEAST_CONSTANT`` tokens
without a digit, or with more variable tokens than constant ones (years, prices,
rows of a table), recurs only as it stands, digits included. A choice of stretches
with fewer than ``LEAST_CONSTANT`` constant tokens is no template either.

Defined results: lines without tokens are never dropped; null and empty texts
have no lines to drop and come back as they are. Rows with equal doc_id and text
are one document (and all come back); a null doc_id is a value like others. The
result does not depend on row order. Extra columns are not read. Empty table: no
rows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import WORD_BREAK
from playtally.session import materialize

DEPTH = 5          # leading tokens on a line's path
SEGMENTS = 6
AGREE = 4          # stretches on which a template's lines agree, at least
LEAST_CONSTANT = 3  # tokens without a digit that a template holds, at least
LONG_TOKENS = 20
LONG_DOCS = 5
SHORT_DOCS = 10


def _key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def parsed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH) -> DataFrame:
    """``key, doc, copy, line, n_tokens, leaf, exact, s0.., c0..`` per line with tokens, stored; ``key``:
    of id and text, ``copy``: of the text alone, ``c``: constant tokens on a stretch."""
    lines = docs.select(_key(F.col(doc_id), F.col(text)).alias("key"), F.col(doc_id).alias("doc"),
                        F.xxhash64(text).alias("copy"), F.posexplode(F.split(F.col(text), "\n")).alias("line", "_l"))
    own_columns = ["key", "doc", "copy", "line"]
    masked = lines.select(*own_columns, "_l", F.regexp_replace("_l", r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", "<*>").alias("_m"))
    tokens = masked.select(*own_columns, "_l", F.array_remove(F.split("_m", WORD_BREAK), "").alias("_w")).filter(F.size("_w") > 0)
    edge = lambda i: f"cast(size(_w) * {i} div {SEGMENTS} as int)"
    stretch = lambda i: f"slice(_w, {edge(i)} + 1, {edge(i + 1)} - {edge(i)})"
    stretches = [F.expr(f"hash({stretch(i)})").alias(f"s{i}") for i in range(SEGMENTS)]
    constant = [F.expr(f"size(array_remove({stretch(i)}, '<*>'))").alias(f"c{i}") for i in range(SEGMENTS)]
    cut = tokens.select(
        *own_columns, "_l", F.size("_w").alias("n_tokens"), F.xxhash64(F.size("_w"), F.slice("_w", 1, depth)).alias("leaf"),
        F.xxhash64("_w").alias("exact"), *stretches, *constant)
    n_constant = sum(F.col(f"c{i}") for i in range(SEGMENTS))
    general = (n_constant >= LEAST_CONSTANT) & (2 * n_constant >= F.col("n_tokens"))
    own = F.xxhash64(F.array_remove(F.split("_l", WORD_BREAK), ""), F.lit("unmasked"))
    return materialize(cut.select(
        *own_columns, "n_tokens", *[F.when(general, F.col(c)).otherwise(own).alias(c) for c in ("leaf", "exact")],
        *[f"s{i}" for i in range(SEGMENTS)], *[F.col(f"c{i}") for i in range(SEGMENTS)]), "template-lines")


def _enough(docs_column: str, long_tokens: int, long_docs: int, short_docs: int) -> Column:
    need = F.when(F.col("n_tokens") >= long_tokens, long_docs).otherwise(short_docs)
    return F.col(docs_column) >= need


def _choices(lines: DataFrame, agree: int, *columns: str) -> DataFrame:
    """A row per line and choice of ``agree`` stretches: the hash of its template."""
    hashes = [F.when(sum(F.col(f"c{k}") for k in some) >= LEAST_CONSTANT,
                     F.xxhash64("leaf", F.lit(i), *[F.col(f"s{k}") for k in some]))
              for i, some in enumerate(combinations(range(SEGMENTS), agree))]
    return lines.select(*columns, F.explode(F.array_compact(F.array(*hashes))).alias("template"))


def recurring(lines: DataFrame, agree: int = AGREE, long_tokens: int = LONG_TOKENS, long_docs: int = LONG_DOCS,
              short_docs: int = SHORT_DOCS) -> DataFrame:
    """``exact`` of the lines whose template recurs: lines in enough texts, and lines with a choice
    of stretches that enough texts hold."""
    need = (long_tokens, long_docs, short_docs)
    shared = materialize(
        lines.groupBy("leaf", "copy").agg(F.first("n_tokens").alias("n_tokens"))
        .groupBy("leaf").agg(F.first("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("docs"))
        .filter(_enough("docs", *need)).select("leaf"), "template-leaves")
    stretches = [f"{x}{i}" for x in "sc" for i in range(SEGMENTS)]
    held = materialize(lines.join(shared, "leaf", "left_semi").groupBy("exact", "copy")
                       .agg(*[F.first(c).alias(c) for c in ("leaf", "n_tokens", *stretches)]), "template-held")
    texts = materialize(held.groupBy("exact").agg(*[F.first(c).alias(c) for c in ("leaf", "n_tokens", *stretches)],
                                                  F.count(F.lit(1)).alias("docs")), "template-texts")
    alike = texts.filter(_enough("docs", *need))
    rare = texts.filter(~_enough("docs", *need))
    # A template of a line that recurs itself recurs; the others' texts are counted.
    counted = (_choices(held.join(alike.select("exact"), "exact", "left_anti"), agree, "copy", "n_tokens")
               .groupBy("template", "copy").agg(F.first("n_tokens").alias("n_tokens"))
               .groupBy("template").agg(F.first("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("docs"))
               .filter(_enough("docs", *need)).select("template"))
    templates = materialize(_choices(alike, agree).union(counted).distinct(), "template-choices")
    general = _choices(rare, agree, "exact").join(templates, "template", "left_semi").select("exact").distinct()
    return materialize(alike.select("exact").union(general), "template-exact")


def clean_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH,
                    **thresholds) -> DataFrame:
    """``doc_id, n_lines, n_dropped, n_tokens_dropped, text`` per row of ``docs``: the text
    without the lines of recurring templates."""
    lines = parsed_lines(docs, doc_id, text, depth)
    # A semi join on stored keys, so that Spark can split a hot one.
    dropped = (lines.select("key", "doc", "line", "n_tokens", "exact")
               .join(recurring(lines, **thresholds), "exact", "left_semi")
               .groupBy("key", "doc", "line").agg(F.first("n_tokens").alias("n"))
               .groupBy("key", "doc").agg(F.collect_list("line").alias("_gone"), F.sum("n").cast("bigint").alias("_tokens"))
               .withColumnRenamed("key", "_k"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    same = (_key(F.col("doc_id"), F.col("_text")) == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("doc"))
    joined = (rows.join(materialize(dropped, "template-dropped"), same, "left")
              .withColumn("_lines", F.split("_text", "\n"))
              .withColumn("_gone", F.coalesce("_gone", F.array().cast("array<int>"))))
    n_lines = F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint")
    kept = F.expr("transform(array_except(sequence(0, size(_lines) - 1), _gone), i -> _lines[i])")
    return joined.select(
        "doc_id", F.when(F.col("_text").isNull(), F.lit(0).cast("bigint")).otherwise(n_lines).alias("n_lines"),
        F.size("_gone").cast("bigint").alias("n_dropped"),
        F.coalesce("_tokens", F.lit(0).cast("bigint")).alias("n_tokens_dropped"),
        F.when(F.size("_gone") == 0, F.col("_text")).otherwise(F.array_join(kept, "\n")).alias("text"))


# Choices of four of the six stretches, by number.
_CHOICES = ", ".join("[" + ", ".join(str(k + 1) for k in some) + "]" for some in combinations(range(SEGMENTS), AGREE))
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, string_split(text, chr(10)) AS l FROM documents),
x AS (SELECT rid, text, i, regexp_extract_all(l[i], '[^\x20\x09-\x0D]+') AS w
      FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM d)),
m AS (SELECT *, len(w) AS n, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN w] AS v FROM x WHERE len(w) > 0),
g AS (SELECT *, len([t FOR t IN v IF t <> '<*>']) AS c FROM m),
n AS (SELECT rid, text, i, n, c >= 3 AND 2 * c >= n AS general,
             CASE WHEN c >= 3 AND 2 * c >= n THEN 'm ' || array_to_string(v, ' ') ELSE 'o ' || array_to_string(w, ' ') END AS exact,
             n || ':' || array_to_string(v[1:5], ' ') AS leaf, [v[n * k // 6 + 1:n * (k + 1) // 6] FOR k IN range(6)] AS s FROM g),
t AS (SELECT DISTINCT exact, leaf, n, text, choice, [s[k] FOR k IN choice] AS parts
      FROM (SELECT *, unnest([@CHOICES@]) AS choice FROM n WHERE general)
      WHERE len([u FOR u IN flatten([s[k] FOR k IN choice]) IF u <> '<*>']) >= 3),
r AS (SELECT leaf, choice, parts FROM t GROUP BY ALL HAVING count(DISTINCT text) >= CASE WHEN any_value(n) >= @LONG@ END),
e AS (SELECT exact FROM n GROUP BY exact HAVING count(DISTINCT text) >= CASE WHEN any_value(n) >= @LONG@ END
      UNION SELECT DISTINCT exact FROM t JOIN r USING (leaf, choice, parts)),
a AS (SELECT rid, list(i) AS gone, sum(n)::BIGINT AS tokens FROM n WHERE exact IN (SELECT exact FROM e) GROUP BY rid)
SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_dropped,
       coalesce(tokens, 0)::BIGINT AS n_tokens_dropped,
       CASE WHEN gone IS NULL THEN text
            ELSE array_to_string([l[j] FOR j IN range(1, len(l) + 1) IF NOT list_contains(gone, j)], chr(10)) END AS text
FROM d LEFT JOIN a USING (rid)
""".replace("@CHOICES@", _CHOICES).replace("@LONG@", f"{LONG_TOKENS} THEN {LONG_DOCS} ELSE {SHORT_DOCS}")
