"""Mixing sources to target weights (DataFrame functions only).

1. *Targets.* Sources in code-point order (null last) weigh 1, 2, 3, 1, 2, 3, ...
   and share 100 % of all words. A target stops at ``max_passes`` times its
   source's size; the excess goes to the others by weight. That is water
   filling: with sources sorted by ``cap / weight``, the level at the first
   source that stays below its cap gives every target at once.
2. *Whole passes and a cutoff.* Each document has a pseudo-random position in
   [0, 2**63) from its id. A source gives ``passes`` whole copies of itself plus
   the documents at positions up to ``cutoff`` and up to FILLS later documents,
   each the largest that still fits, the last the nearest. The cutoff comes from a radix selection over 12-bit position
   buckets (two levels, then the documents of one bucket in 16.7 million), so no
   task holds a source, however hot.
3. *Blocks.* Consecutive positions form blocks of about ``block_words`` words; a
   source's quota is its number of whole and partial passes in blocks.
4. *Splitting tree.* The quotas are split over output shards from the root down:
   at each node the left half receives a multivariate hypergeometric draw from
   the node's quotas (one univariate draw per source, by inverse distribution
   function within 12 standard deviations of the mode). Quotas add up exactly at
   every node.
5. *Disjoint permuted blocks.* A source's blocks are permuted by an affine map
   and shard ``k`` takes the next ``quota`` of them. Rows of a shard are then
   ordered by a second hash (``shuffle`` in :func:`mixed_documents`).

All state between the steps is per source, per (source, shard) or per block;
documents are only hashed, counted and joined to their block. Draws depend on
ids and seeds alone, so reruns agree.

Defined results: a null text or a text without words has size 0 and takes 0
words; a source of size 0 has target 0. Null sources are one source, last in
order. Rows that share a doc_id (nulls too) and a source share a position: they
are taken together. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playtally.llm.common import shuffle_width, words
from playtally.session import materialize

SEED = 42
WEIGHTS = (1, 2, 3)
MAX_PASSES = 3
BLOCK_WORDS = 50_000      # a block's words, about
SHARD_WORDS = 5_000_000   # an output shard's words, about
DEAL_LEVELS = 6           # levels of the splitting tree between two deals of its nodes over all tasks
FILLS = 5                 # documents beyond the cutoff that may fill a source's gap


@dataclass(frozen=True)
class Mix:
    """``sizes``: one slim row per document. ``sources``: target, passes, cutoff and blocks
    per source. ``draws``: one row per drawn (source, pass, block) with its shard."""

    sizes: DataFrame
    sources: DataFrame
    draws: DataFrame


def _position(doc_id: Column, seed: int) -> Column:
    return F.xxhash64(doc_id, F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))


def document_sizes(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                   seed: int = SEED) -> DataFrame:
    """``_row, doc_id, source, size, pos``, stored: the texts are read once."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       F.size(words(F.col(text))).cast("bigint").alias("size"),
                       _position(F.col(doc_id), seed).alias("pos"),
                       F.monotonically_increasing_id().alias("_row"))
    return materialize(slim, "mix-sizes")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_passes: int = MAX_PASSES) -> DataFrame:
    """``source, weight, source_size, target``: one row per source (water filling)."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    # One row per source from here on: the windows see the source catalogue only.
    ranked = per.withColumn("_rn", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    weighed = ranked.withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]),
                               ((F.col("_rn") - 1) % len(weights) + 1).cast("int")).cast("double"))
    cap = (F.col("source_size") * max_passes).cast("double")
    order = Window.orderBy(F.col("_level"), F.col("_rn"))
    everything = Window.partitionBy()
    filled = (weighed.withColumn("_cap", cap).withColumn("_level", F.col("_cap") / F.col("weight"))
              .withColumn("_total", F.sum("source_size").over(everything).cast("double"))
              .withColumn("_caps_before", F.coalesce(
                  F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
              .withColumn("_weights_from", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("_fill", (F.col("_total") - F.col("_caps_before")) / F.col("_weights_from"))
              .withColumn("_capped", F.col("_level") < F.col("_fill"))
              .withColumn("_final", F.max(F.when(~F.col("_capped"), F.col("_fill"))).over(everything)))
    return filled.select("source", "weight", "source_size",
                         F.when(F.col("_capped"), F.col("_cap"))
                         .otherwise(F.least(F.col("_cap"), F.col("weight") * F.col("_final"))).alias("target"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _radix_step(sizes: DataFrame, wanted: DataFrame, shift: int) -> DataFrame:
    """Narrow each source's wanted position by 12 bits.

    ``wanted``: ``s, lo, base, rest`` (positions from ``lo`` on hold the cutoff, ``base`` words
    lie below ``lo``, ``rest`` words are wanted). Picks the first 12-bit bucket at which the
    running sum exceeds ``rest``; with none, the last one. The group of a window is at most
    4,096 bucket rows.
    """
    inside = sizes.join(wanted, _same("source", "s")
                        & (F.shiftright("pos", shift + 12) == F.shiftright("lo", shift + 12)))
    buckets = (inside.groupBy("s", "base", "rest", F.shiftright("pos", shift).alias("b"))
               .agg(F.sum("size").alias("n")))
    run = Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    summed = buckets.withColumn("cum", F.col("base") + F.sum("n").over(run))
    pick = F.when(F.col("cum") > F.col("rest"), F.struct("b", F.col("cum") - F.col("n")))
    return (summed.groupBy("s", "rest")
            .agg(F.coalesce(F.min(pick), F.max(F.struct("b", F.col("cum") - F.col("n")))).alias("p"))
            .select("s", F.shiftleft("p.b", shift).alias("lo"), F.col("p.col2").alias("base"), "rest"))


def _cutoffs(sizes: DataFrame, planned: DataFrame) -> DataFrame:
    """``s, cutoff, extra``: the partial pass takes the documents at positions up to ``cutoff``,
    as many as fit, and up to FILLS later documents (positions ``extra``), each the largest that
    still fits (the last the nearest)."""
    wanted = planned.filter("rest > 0").select(
        F.col("source").alias("s"), F.lit(0).cast("bigint").alias("lo"), F.lit(0).cast("bigint").alias("base"), "rest")
    for shift in (51, 39):
        wanted = materialize(_radix_step(sizes, wanted, shift), "mix-radix")
    last = (sizes.join(wanted, _same("source", "s") & (F.shiftright("pos", 39) == F.shiftright("lo", 39)))
            .groupBy("s", "lo", "base", "rest", "pos").agg(F.sum("size").alias("n")))
    run = Window.partitionBy("s").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    fits = F.col("cum") <= F.col("rest")
    cut = materialize(
        last.withColumn("cum", F.col("base") + F.sum("n").over(run)).groupBy("s").agg(
            F.coalesce(F.max(F.when(fits, F.col("pos"))), F.min("lo") - 1).alias("cutoff"),
            (F.first("rest") - F.coalesce(F.max(F.when(fits, F.col("cum"))), F.first("base"))).alias("gap"),
            F.array().cast("array<bigint>").alias("extra")), "mix-cutoff")
    for turn in range(FILLS):
        # The last one may go over, if that comes nearer.
        most = F.col("gap") if turn < FILLS - 1 else 2 * F.col("gap")
        best = (sizes.join(cut, _same("source", "s") & (F.col("pos") > F.col("cutoff")) & (F.col("size") > 0)
                           & (F.col("size") <= most) & ~F.array_contains("extra", F.col("pos")))
                .groupBy(F.col("s").alias("_s"))
                .agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "pos", "size")).alias("best")))
        cut = materialize(cut.join(best, _same("s", "_s"), "left").select(
            "s", "cutoff", (F.col("gap") - F.coalesce("best.size", F.lit(0))).alias("gap"),
            F.when(F.col("best").isNotNull(), F.array_append("extra", F.col("best.pos")))
            .otherwise(F.col("extra")).alias("extra")),
            "mix-cutoff")
    return cut.select("s", "cutoff", "extra")


def _ln_factorial(x: str) -> str:
    """SQL for ln(x!): Stirling's series at x + 9, moved back by eight factors."""
    z = f"({x} + 9.0D)"
    back = " * ".join(f"({x} + {k}.0D)" for k in range(1, 9))
    return (f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1.0D / (12.0D * {z}) "
            f"- 1.0D / (360.0D * {z} * {z} * {z}) - ln({back}))")


def _hypergeometric(total: str, kind: str, drawn: str, uniform: str) -> str:
    """SQL for one draw: how many of ``drawn`` items, out of ``total``, are of the ``kind`` items.

    Inverse distribution function over the support within 12 standard deviations of the mode.
    """
    lo, hi = f"greatest(0L, {drawn} - ({total} - {kind}))", f"least({kind}, {drawn})"
    mode = f"(({drawn} + 1L) * ({kind} + 1L) div ({total} + 2L))"
    sd = (f"cast(ceil(12.0D * sqrt(cast({drawn} as double) * {kind} / greatest({total}, 1L) + 1.0D)) as bigint)")
    lw = lambda x: (f"-({_ln_factorial(x)} + {_ln_factorial(f'({kind} - {x})')} + "          # noqa: E731
                    f"{_ln_factorial(f'({drawn} - {x})')} + {_ln_factorial(f'({total} - {kind} - {drawn} + {x})')})")
    start, stop = f"greatest({lo}, least({hi}, {mode}) - {sd})", f"least({hi}, greatest({lo}, {mode}) + {sd})"
    weights = (f"transform(sequence({start}, {stop}), x -> named_struct('x', x, 'w', "
               f"exp({lw('x')} - ({lw(f'greatest({lo}, least({hi}, {mode}))')}))))")
    return (f"aggregate(array({weights}), {lo}, (a0, ws) -> aggregate(ws, named_struct('left', {uniform} * "
            f"aggregate(ws, 0.0D, (a, e) -> a + e.w), 'x', {lo}), (a, e) -> named_struct("
            f"'left', a.left - e.w, 'x', if(a.left > 0.0D, e.x, a.x)), a -> a.x))")


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``source, shard, first, past``: ranges of permuted blocks per source and shard.

    ``quotas``: ``source, quota``. The root holds all quotas as one array, one entry per
    source; each level draws the left half's quotas and leaves the rest to the right half.
    The nodes of some levels are dealt over all tasks, which go on with the trees below them.
    """
    tree = quotas.groupBy().agg(
        F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("null"), "source", "quota"))).alias("all")) \
        .select(F.transform("all", lambda q: q["source"]).alias("names"),
                F.transform("all", lambda q: q["quota"]).alias("q"),
                F.lit(0).alias("lo"), F.lit(shards).alias("hi"))
    depth = max(0, (shards - 1).bit_length())
    for level in range(depth):
        if level and level % DEAL_LEVELS == 0:
            tree = tree.repartition(shuffle_width(quotas.sparkSession), "lo")
        left = _left_expression(seed)
        node = (tree.withColumn("n", F.expr("aggregate(q, 0L, (a, x) -> a + x)"))
                .withColumn("mid", F.expr("lo + (hi - lo + 1) div 2"))
                .withColumn("w", F.expr("cast(n * (mid - lo) div greatest(hi - lo, 1) as bigint)")))
        drawn = node.withColumn("left", F.expr(left))
        tree = drawn.select("names", F.explode(F.expr(
            "filter(array(named_struct('q', left, 'lo', lo, 'hi', cast(mid as int)), "
            "named_struct('q', zip_with(q, left, (a, b) -> a - b), 'lo', cast(mid as int), 'hi', hi)), "
            "x -> x.hi > x.lo)")).alias("c")).select("names", "c.*")
    leaves = tree.select(F.col("lo").alias("shard"), F.explode(F.arrays_zip("names", "q")).alias("e")) \
        .select("shard", F.col("e.names").alias("source"), F.col("e.q").alias("quota"))
    run = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    return (leaves.withColumn("past", F.sum("quota").over(run))
            .select("source", "shard", (F.col("past") - F.col("quota")).alias("first"), "past"))


def _left_expression(seed: int) -> str:
    """SQL for the left child's quotas: a fold over the sources, each draw conditional on
    what the earlier sources left of the node's total and of the left child's share."""
    uniform = f"((xxhash64(lo, hi, e.i, {seed}) & 9007199254740991L) / 9007199254740992.0D)"
    draw = _hypergeometric("a.total", "e.k", "a.want", uniform)
    return (f"aggregate(transform(q, (k, i) -> named_struct('k', k, 'i', i)), "
            f"named_struct('total', n, 'want', w, 'got', cast(array() as array<bigint>)), "
            f"(a, e) -> aggregate(array({draw}), a, (b, x) -> named_struct('total', b.total - e.k, "
            f"'want', b.want - x, 'got', concat(b.got, array(x)))), a -> a.got)")


def plan_mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
             weights: tuple[int, ...] = WEIGHTS, max_passes: int = MAX_PASSES, block_words: int = BLOCK_WORDS,
             shard_words: int = SHARD_WORDS, seed: int = SEED) -> Mix:
    sizes = document_sizes(docs, doc_id, source, text, seed)
    planned = materialize(
        source_targets(sizes, weights, max_passes)
        .withColumn("passes", F.when(F.col("source_size") > 0,
                                     F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("bigint")),
        "mix-targets")
    cut = _cutoffs(sizes, planned)
    sources = materialize(
        planned.join(cut, _same("source", "s"), "left")
        .withColumn("cutoff", F.coalesce("cutoff", F.lit(-1).cast("bigint")))
        .withColumn("extra", F.coalesce("extra", F.array().cast("array<bigint>")))
        .withColumn("quota", F.col("passes") * F.col("blocks")
                    + F.when((F.col("cutoff") >= 0) | (F.size("extra") > 0), _last_block() + 1).otherwise(0))
        .select("source", "weight", "source_size", "target", "passes", "cutoff", "extra", "blocks", "quota"),
        "mix-sources")
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, round(total / shard_words))
    ranges = materialize(split_quotas(sources.select("source", "quota"), shards, seed), "mix-ranges")
    return Mix(sizes, sources, materialize(_draws(sources, ranges, seed), "mix-draws"))


def _last_block() -> Column:
    """Block in which the partial pass ends; it also gets the extra documents."""
    return _block(F.greatest("cutoff", F.lit(0).cast("bigint")))


def _block(pos: Column) -> Column:
    """Block of a position: positions spread evenly over ``blocks``."""
    return F.floor(F.shiftright(pos, 10) / float(1 << 53) * F.col("blocks")).cast("bigint")


def _draws(sources: DataFrame, ranges: DataFrame, seed: int) -> DataFrame:
    """``source, pass, block, shard``: permuted slot ``k`` holds block item ``(a k + b) mod quota``.

    ``a`` is a prime that does not divide the quota, so the map is a bijection of the slots and
    shards get disjoint items.
    """
    slots = (ranges.filter("past > first")
             .withColumnRenamed("source", "s")
             .select("s", "shard", F.explode(F.sequence(F.col("first"), F.col("past") - 1)).alias("k")))
    per = sources.filter("quota > 0").select("source", "blocks", "quota")
    shift = F.pmod(F.xxhash64("source", F.lit(seed + 1)), F.col("quota"))
    prime = F.when(F.col("quota") % 2_147_483_647 != 0, 2_147_483_647).otherwise(1_073_741_789)
    item = F.pmod(F.col("k") * prime.cast("bigint") + shift, F.col("quota"))
    return (slots.join(per, _same("source", "s")).withColumn("_item", item)
            .select("source", F.expr("_item div blocks").alias("pass"),
                    F.pmod("_item", "blocks").alias("block"), "shard"))


def _copies(rows: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` (``source``, ``pos``, more) once per pass that takes them, with ``shard``."""
    per = mix.sources.select(F.col("source").alias("_s"), "passes", "cutoff", "extra", "blocks")
    early = F.col("pos") <= F.col("cutoff")
    partial = early | F.array_contains("extra", F.col("pos"))
    taken = (rows.join(per, _same("source", "_s"))
             .withColumn("_last", F.col("passes") - 1 + F.when(partial, 1).otherwise(0)).filter("_last >= 0")
             .withColumn("_pass", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_last").cast("bigint"))))
             .withColumn("_block", F.when((F.col("_pass") == F.col("passes")) & ~early, _last_block())
                         .otherwise(_block(F.col("pos")))))
    draws = mix.draws.select(F.col("source").alias("_ds"), F.col("pass").alias("_dp"),
                             F.col("block").alias("_db"), F.col("shard").alias("_shard"))
    return (taken.join(draws, _same("source", "_ds") & (F.col("_pass") == F.col("_dp"))
                       & (F.col("_block") == F.col("_db")))
            .drop("_s", "_ds", "_dp", "_db", "passes", "cutoff", "extra", "blocks", "_last"))


def taken_words(mix: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` per document, counted over the drawn rows."""
    drawn = (_copies(mix.sizes.select("_row", "source", "pos"), mix)
             .groupBy("_row").agg(F.count(F.lit(1)).alias("copies")))
    per = mix.sources.select(F.col("source").alias("_s"), "source_size", "target")
    return (mix.sizes.join(per, _same("source", "_s")).join(drawn, "_row", "left")
            .withColumn("copies", F.coalesce("copies", F.lit(0).cast("bigint")))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies"))


def mixed_documents(docs: DataFrame, mix: Mix, doc_id: str = "doc_id", source: str = "source",
                    shuffle: bool = True, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs`` (its columns) as often as it is drawn.

    With ``shuffle``, rows are grouped by shard and in random order inside it.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_doc")).select(
        "_doc", F.col(f"_doc.{source}").alias("source"), _position(F.col(f"_doc.{doc_id}"), seed).alias("pos"))
    out = _copies(rows, mix)
    if shuffle:
        out = (out.repartition("_shard")
               .sortWithinPartitions("_shard", F.xxhash64("pos", "_pass", F.lit(seed + 2))))
    return out.select("_doc.*")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """Pipeline form: plan the mix of ``docs`` and return it (columns of ``docs``)."""
    return mixed_documents(docs, plan_mix(docs, **options))
