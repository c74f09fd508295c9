"""Quality classifier: a generalised additive model with pairwise interactions.

Training is cyclic gradient boosting: round after round, every feature in turn
gets one shallow tree on that feature alone (three splits, so four leaves) fitted
to the logistic residuals, shrunk by the learning rate and added to the feature's
lookup table over its quantile bins. Then the most promising feature pairs
(largest drop of residual error on a coarse grid) are boosted the same way with
two-dimensional trees (one split on each feature), which add to pair tables. The
model is nothing but an intercept and these tables, so a score is a sum of table
entries, computed for whole Arrow batches by bin lookups.

Features are measured by Spark's own functions from the text alone; labels,
language, source and doc_id never enter a score. Rows whose
``crc32(doc_id) mod 5`` is 0 are held out: their labels are not read. The model
is fitted on the driver on at most ``SAMPLE_ROWS`` labelled rows (those with the
smallest id hashes; the bound is a parameter), as plain feature rows; scoring
covers every document in one narrow pass, without a shuffle.

Defined results: null and empty texts have all-zero features and get the score
the tables give those; with no usable labels, or one class only, every score is
the smoothed share of label 1 (0.5 without labels). Labels that are null or not
0/1 are not used; of a doc_id's repeated labels the largest counts. Rows with a
null doc_id are scored and not held out. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import share_package, words

SAMPLE_ROWS = 40_000     # labelled rows the model is fitted on, at most
FOLDS = 5
THRESHOLD = 0.3
BINS = 32
ROUNDS = 120
RATE = 0.15
PAIRS = 6
PAIR_ROUNDS = 40
PAIR_BINS = 8

FEATURES = ("n_words", "word_length", "word_length_spread", "symbols", "marks", "bars", "upper", "digits",
            "punctuation", "distinct_words", "repeated_neighbours", "line_words", "duplicate_lines",
            "short_words", "sentence_ends", "capital_words")


def features(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and FEATURES (doubles): ratios measured on the whole text."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    split = base.select("doc_id", "_t", words(F.col("_t")).alias("_w"),
                        F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"))
    n, chars = F.col("_n"), F.col("_c")
    gone = lambda pattern: F.col("_len") - F.char_length(F.regexp_replace("_t", pattern, ""))
    per_word = lambda x: x / F.greatest(n, F.lit(1.0))      # noqa: E731
    per_char = lambda x: x / F.greatest(chars, F.lit(1.0))
    lengths = split.withColumns({
        "_len": F.char_length("_t"), "_n": F.size("_w").cast("double"),
        "_c": F.char_length(F.array_join("_w", "")).cast("double"),
        "_sizes": F.transform("_w", lambda w: F.char_length(w))})
    squares = F.aggregate("_sizes", F.lit(0).cast("bigint"), lambda a, x: a + x * x).cast("double")
    mean = per_word(chars)
    return lengths.select(
        "doc_id", n.alias("n_words"), mean.alias("word_length"),
        F.sqrt(F.greatest(per_word(squares) - mean * mean, F.lit(0.0))).alias("word_length_spread"),
        per_word(gone(r"[#*$%&<>@~^=+_\\]")).alias("symbols"), per_word(gone("!")).alias("marks"),
        per_word(gone(r"\|")).alias("bars"), per_char(gone(r"\p{Lu}")).alias("upper"),
        per_char(gone(r"\p{N}")).alias("digits"), per_word(gone(r"[.,;:?]")).alias("punctuation"),
        per_word(F.size(F.array_distinct("_w")).cast("double")).alias("distinct_words"),
        per_word(F.expr("aggregate(zip_with(_w, slice(_w, 2, greatest(size(_w), 1)), (a, b) -> if(a <=> b, 1, 0)), "
                        "0, (a, x) -> a + x)").cast("double")).alias("repeated_neighbours"),
        (n / F.greatest(F.size("_l"), F.lit(1))).alias("line_words"),
        ((F.size("_l") - F.size(F.array_distinct("_l"))) / F.greatest(F.size("_l"), F.lit(1))).alias("duplicate_lines"),
        per_word(F.size(F.filter("_sizes", lambda x: x <= 2)).cast("double")).alias("short_words"),
        per_word(F.regexp_count("_t", F.lit(r"[.!?](?=[\x20\x09-\x0D]|$)")).cast("double")).alias("sentence_ends"),
        per_word(F.regexp_count("_t", F.lit(r"(?<![^\x20\x09-\x0D])\p{Lu}")).cast("double")).alias("capital_words"))


@dataclass
class Gam:
    """Intercept and lookup tables. ``edges[f]``: bin borders of feature ``f``; ``pairs``:
    (f, g, borders of f, borders of g, table)."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of features."""
        total = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        for f, g, ef, eg, table in self.pairs:
            total += table[np.searchsorted(ef, x[:, f], side="right"), np.searchsorted(eg, x[:, g], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _borders(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else np.zeros(0)


def _tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A three-split tree over ordered bins: each bin's leaf value (Newton step)."""
    leaves = [(0, len(gradient))]
    g, w = np.concatenate(([0], np.cumsum(gradient))), np.concatenate(([0], np.cumsum(weight)))
    fit = lambda a, b: (g[b] - g[a]) ** 2 / (w[b] - w[a] + 1)
    for _ in range(3):
        best, at = 1e-9, None
        for i, (a, b) in enumerate(leaves):
            if b - a > 1:
                cut = np.arange(a + 1, b)
                gain = fit(a, cut) + fit(cut, b) - fit(a, b)
                if gain.max() > best:
                    best, at = gain.max(), (i, int(cut[gain.argmax()]))
        if at is None:
            break
        a, b = leaves.pop(at[0])
        leaves += [(a, at[1]), (at[1], b)]
    value = np.zeros(len(gradient))
    for a, b in leaves:
        value[a:b] = (g[b] - g[a]) / (w[b] - w[a] + 1)
    return value


def _pair_tree(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """One split on each feature of a pair: the best quadrants' gain and values."""
    def corner(m: np.ndarray) -> np.ndarray:
        out = np.zeros((m.shape[0] + 1, m.shape[1] + 1))
        out[1:, 1:] = m.cumsum(0).cumsum(1)
        return out

    g, w = corner(gradient), corner(weight)
    best, found = 0.0, np.zeros_like(gradient)
    for i in range(1, gradient.shape[0]):
        j = np.arange(1, gradient.shape[1])
        if not len(j):
            break
        sums = [(s[i, j], s[i, -1] - s[i, j], s[-1, j] - s[i, j], s[-1, -1] - s[i, -1] - s[-1, j] + s[i, j])
                for s in (g, w)]
        gain = sum(a * a / (b + 1) for a, b in zip(*sums, strict=True))
        if gain.max() > best:
            k = int(gain.argmax())
            values = [a[k] / (b[k] + 1) for a, b in zip(*sums, strict=True)]
            best, found = float(gain.max()), np.zeros_like(gradient)
            found[:i, :k + 1], found[:i, k + 1:], found[i:, :k + 1], found[i:, k + 1:] = values
    return best, found


def fit_gam(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE, pairs: int = PAIRS,
            pair_rounds: int = PAIR_ROUNDS) -> Gam:
    """Fit on features ``x`` and labels ``y`` (0 or 1)."""
    share = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(share / (1 - share)))
    edges = [_borders(x[:, f], BINS) for f in range(x.shape[1])]
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Gam(intercept, edges, tables, [])
    if not len(y) or y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)]
    total = np.full(len(y), intercept)
    for _ in range(rounds):
        for f, table in enumerate(tables):
            p = 1 / (1 + np.exp(-total))
            step = rate * _tree(np.bincount(bins[f], y - p, len(table)), np.bincount(bins[f], p * (1 - p), len(table)))
            table += step
            total += step[bins[f]]
    coarse = [_borders(x[:, f], PAIR_BINS) for f in range(x.shape[1])]
    small = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]

    def grid(f: int, g: int, values: np.ndarray) -> np.ndarray:
        shape = len(coarse[f]) + 1, len(coarse[g]) + 1
        return np.bincount(small[f] * shape[1] + small[g], values, shape[0] * shape[1]).reshape(shape)

    p = 1 / (1 + np.exp(-total))
    ranked = sorted(((-_pair_tree(grid(f, g, y - p), grid(f, g, p * (1 - p)))[0], f, g)
                     for f in range(x.shape[1]) for g in range(f + 1, x.shape[1])))[:pairs]
    chosen = [(f, g, np.zeros((len(coarse[f]) + 1, len(coarse[g]) + 1))) for gain, f, g in ranked if gain < 0]
    for _ in range(pair_rounds):
        for f, g, table in chosen:
            p = 1 / (1 + np.exp(-total))
            step = rate * _pair_tree(grid(f, g, y - p), grid(f, g, p * (1 - p)))[1]
            table += step
            total += step[small[f], small[g]]
    model.pairs = [(f, g, coarse[f], coarse[g], table) for f, g, table in chosen]
    return model


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Gam:
    """Fit on the labelled rows that are not held out, at most ``sample_rows`` of them."""
    usable = (labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y"))
              .filter(F.col("_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("_id")))
              .groupBy("_id").agg(F.max("_y").alias("_y")))
    chosen = usable.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    slim = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"))
    # The chosen ids are bounded by sample_rows, hence the broadcast.
    rows = slim.join(F.broadcast(chosen), slim["_doc"] == chosen["_id"])
    measured = features(rows.select(F.struct("_doc", "_y").alias("_k"), "_text"), "_k", "_text")
    # One row per chosen id, whatever the table repeats: never more than sample_rows rows.
    table = (measured.groupBy(F.col("doc_id._doc").alias("_doc"), F.col("doc_id._y").cast("double").alias("_y"))
             .agg(F.min(F.struct(*FEATURES)).alias("_x")).select("_doc", "_y", "_x.*").toArrow())
    matrix = np.stack([table[c].to_numpy() for c in ("_doc", "_y", *FEATURES)], axis=1) if len(table) else \
        np.zeros((0, 2 + len(FEATURES)))
    matrix = matrix[np.lexsort(matrix.T[::-1])]  # the same rows in the same order on every run
    return fit_gam(matrix[:, 2:], matrix[:, 1])


def score_documents(docs: DataFrame, model: Gam, doc_id: str = "doc_id", text: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""

    @F.arrow_udf("double")
    def score(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            yield pa.array(model.score(np.stack([c.to_numpy(zero_copy_only=False) for c in columns], axis=1)))

    share_package(docs.sparkSession)
    scored = features(docs, doc_id, text).select("doc_id", score(*FEATURES).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score_documents(docs, train(docs, labels, **options))
