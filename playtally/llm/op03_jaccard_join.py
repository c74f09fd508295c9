"""N-gram Jaccard similarity join by grouped prefixes, as connected components.

A document's set is its distinct ``width``-word shingles (64-bit hashes). Two
documents link when ``100 * intersection >= percent * union``.

1. *Frequencies.* Documents are dealt to parts of about 24 MB once. A part's task
   sorts its shingles by shingle bucket into packed arrays (a shingle that a third of
   all documents share costs two entries per part); a bucket's task counts them and
   sends each part the shingles that occur more than once. Four bytes a shingle travel
   in rows of one (part, bucket): some 3,000 shingles each over 30 GB, 100 over 1 TB.
2. *Prefixes.* A part's documents meet those counts. Shingles are ordered rarest
   first; a set of size n keeps its first ``n - ceil(p n) + 1`` (a pair that
   links shares one of them). Shingles that occur once cannot match: they fill
   the prefix but are not kept, so most documents keep none.
3. *Equal sets* become one class (two 64-bit sums over the set), and classes
   with the same size and prefix one group.
4. *Groups meet.* Per prefix shingle, each group is paired with the group that
   holds it earliest (the hub) if sizes and positions allow a link, and expanded
   to its members, which also meet their group's first member. Pairs are verified on the whole sets, links
   become components. Then groups of one shingle that are still in different
   components are paired, again under the size and position filters, expanded
   to their members and verified. Members of one component are never paired
   with each other, so a group of thousands of near copies costs one pair each,
   not all pairs; no pair that could join two components is left out.
5. *Links are counted* inside each component whose pairs are not all found yet: its
   sets are spread over blocks, a task takes two blocks and multiplies their
   shingle incidence matrices, and only a count per class leaves it.

Defined results: texts without words (null, empty, white space) have size 0 and
are linked with nothing; their component is their own doc_id. A text of fewer
words than ``width`` is one shingle. Rows with equal doc_id are one node. A row
with null doc_id carries the component its text belongs to, null if only such
rows have that text. Ties break by the smaller doc_id. Extra columns are not
read. Empty table: no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import share_package
from playtally.llm.graph import components
from playtally.llm.textscan import NOT_SPACE, mix, scan_words, shards
from playtally.session import materialize

WIDTH = 4
PERCENT = 85
PART_BYTES = 24 << 20     # text of a document part, about
SLICE_BYTES = 3 << 20     # text handled at once inside a task
LEAST_PARTS = 32
BLOCK_SETS = 2048         # sets of a component in a block, about, and their bytes
BLOCK_BYTES = 8 << 20
HOT_COMPONENT = 256       # nodes of a component from which its rows are salted, and the salts
SALTS = 64

# Low bits of a shingle kept inside a bucket. Buckets hold a few million shingles at any input
# size, so about one in a thousand is counted together with another one. That changes the
# order of shingles, equally in all documents, and no result.
_BITS = np.uint64(32)
_LOW = np.uint64((1 << 32) - 1)

BLOB_SCHEMA = "bucket int, part int, low binary"
SHARED_SCHEMA = "part int, bucket int, low binary, counts binary"
SET_SCHEMA = ("doc_id bigint, n bigint, sum1 bigint, sum2 bigint, tokens array<bigint>, ranks array<bigint>, "
              "shingles binary")


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, ascending, and where each text's begin."""
    ids, edges = scan_words(texts, NOT_SPACE)
    sizes = np.diff(edges)
    n_shingles = np.where(sizes == 0, 0, np.maximum(sizes - width + 1, 1))
    doc = np.repeat(np.arange(len(sizes)), n_shingles)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + edges[doc]
    value = np.zeros(len(doc), np.uint64)
    short = np.flatnonzero(sizes[doc] < width)  # a short text is one shingle of all its words
    with np.errstate(over="ignore"):
        for k in range(width):
            word = ids[np.minimum(at + k, len(ids) - 1)]
            after = mix(value * np.uint64(0x9E3779B97F4A7C15) + word + np.uint64(k + 1))
            ended = short[k >= sizes[doc[short]]]
            after[ended] = value[ended]
            value = after
    by = np.argsort(value)
    by = by[np.argsort(doc[by].astype(np.uint16 if len(sizes) < 1 << 16 else np.int64), kind="stable")]
    doc, value = doc[by], value[by]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(len(sizes) + 1))


def _bucket(shingles: np.ndarray, buckets: int) -> np.ndarray:
    return ((shingles >> _BITS) % np.uint64(buckets)).astype(np.int64)


def _packed(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary values: the bytes of ``data`` between neighbouring ``edges``."""
    offsets = (edges * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _blobs(buckets: int, width: int) -> Callable:
    """A part's documents to BLOB_SCHEMA: a bucket's shingles of the part, each once or, where
    more texts hold it, twice."""

    def cut(key: tuple, docs: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.uint64)]
        for batch in docs.to_batches():
            for piece in shards(pc.fill_null(batch["text"], ""), SLICE_BYTES):
                value, _ = shingle_sets(piece, width)
                found.append((_bucket(value, buckets).astype(np.uint64) << _BITS) | (value & _LOW))
        cells = np.concatenate(found)
        del found
        cells.sort()
        third = np.zeros(len(cells), bool)
        third[2:] = (cells[2:] == cells[1:-1]) & (cells[2:] == cells[:-2])
        cells = cells[~third]
        low, bucket = (cells & _LOW).astype("<u4"), (cells >> _BITS).astype(np.int32)
        edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
        return pa.table({"bucket": pa.array(bucket[edges[:-1]], pa.int32()),
                         "part": pa.array(np.full(len(edges) - 1, key[0].as_py()), pa.int32()),
                         "low": _packed(low, edges)})

    return cut


def _count_bucket(key: tuple, table: pa.Table) -> pa.Table:
    """One bucket: per part, its shingles that occur more than once in all, with saturated counts."""
    lows = [np.frombuffer(x.as_buffer(), "<u4") for x in table["low"]]
    parts = np.repeat(table["part"].to_numpy(), [len(x) for x in lows])
    values, where, counts = np.unique(np.concatenate(lows), return_inverse=True, return_counts=True)
    often = counts[where] > 1
    pairs = np.unique(parts[often].astype(np.int64) * len(values) + where[often])
    part, which = pairs // len(values), pairs % len(values)
    edges = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    return pa.table({"part": pa.array(part[edges[:-1]], pa.int32()),
                     "bucket": pa.array(np.full(len(edges) - 1, key[0].as_py()), pa.int32()),
                     "low": _packed(values[which], edges),
                     "counts": _packed(np.minimum(counts[which], 65535).astype("<u2"), edges)})


def _prefixes(buckets: int, width: int, percent: int) -> Callable:
    """A part's documents and counts to SET_SCHEMA rows."""

    def join(docs: pa.Table, shared: pa.Table) -> pa.Table:
        lows = shared["low"].to_pylist()
        keys = np.frombuffer(b"".join(lows), "<u4").astype(np.uint64) | np.repeat(
            shared["bucket"].to_numpy().astype(np.uint64) << _BITS, [len(x) // 4 for x in lows])
        counts = np.frombuffer(b"".join(shared["counts"].to_pylist()), "<u2")
        by = np.argsort(keys, kind="stable")
        keys, counts = keys[by], counts[by]
        out = []
        for batch in docs.to_batches():
            at = 0
            for piece in shards(pc.fill_null(batch["text"], ""), SLICE_BYTES):
                out.append(_prefix_rows(batch["doc_id"].slice(at, len(piece)), piece, keys, counts, buckets, width,
                                        percent))
                at += len(piece)
        return pa.Table.from_batches(out, _SETS)

    return join


_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sum1", pa.int64()), ("sum2", pa.int64()),
                   ("tokens", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())), ("shingles", pa.binary())])


def _prefix_rows(doc_ids: pa.Array, texts: pa.Array, keys: np.ndarray, counts: np.ndarray, buckets: int, width: int,
                 percent: int) -> pa.RecordBatch:
    value, edges = shingle_sets(texts, width)
    n = np.diff(edges)
    doc = np.repeat(np.arange(len(n)), n)
    times = np.ones(len(value), np.int64)
    if len(keys) and len(value):
        key = (_bucket(value, buckets).astype(np.uint64) << _BITS) | (value & _LOW)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        times = np.where(keys[at] == key, counts[at].astype(np.int64), 1)
    # A text's shingles of its own come first and are not kept; only the others are put in order.
    alone = np.bincount(doc[times == 1], minlength=len(n))
    probe = n - -(-percent * n // 100) + 1
    some = np.flatnonzero((times > 1) & (alone < probe)[doc])
    some = some[np.lexsort((value[some], times[some], doc[some]))]
    begin = np.searchsorted(doc[some], np.arange(len(n)))
    rank = np.arange(len(some)) - begin[doc[some]] + alone[doc[some]]
    keep = rank < probe[doc[some]]
    kept, kept_rank, kept_doc = value[some][keep], rank[keep], doc[some][keep]
    lists = np.searchsorted(kept_doc, np.arange(len(n) + 1)).astype(np.int32)
    with np.errstate(over="ignore"):
        sums = [np.add.reduceat(np.append(mix(value ^ np.uint64(c)), np.uint64(0)), np.minimum(edges[:-1], len(value)))
                * (n > 0).astype(np.uint64) for c in (0x1234567, 0x7654321ABCDEF)]
    whole = [value[edges[i]:edges[i + 1]].astype("<u8").tobytes() if lists[i + 1] > lists[i] else None
             for i in range(len(n))]
    signed = lambda x: pa.array(x.astype(np.uint64).view(np.int64), pa.int64())
    return pa.RecordBatch.from_arrays([
        doc_ids, pa.array(n, pa.int64()), signed(sums[0]), signed(sums[1]),
        pa.ListArray.from_arrays(pa.array(lists), signed(kept)),
        pa.ListArray.from_arrays(pa.array(lists), pa.array(kept_rank, pa.int64())),
        pa.array(whole, pa.binary())], schema=_SETS)


def document_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                  percent: int = PERCENT) -> DataFrame:
    """SET_SCHEMA per row of ``docs``, stored: size, set sums, kept prefix shingles with their
    ranks and, where there are any, the whole set."""
    share_package(docs.sparkSession)
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, math.ceil(size / PART_BYTES))
    # Both uses of the parts read one exchange.
    placed = slim.withColumn("part", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))
    shared = (placed.groupBy("part").applyInArrow(_blobs(parts, width), BLOB_SCHEMA)
              .groupBy("bucket").applyInArrow(_count_bucket, SHARED_SCHEMA))
    sets = (placed.groupBy("part").cogroup(shared.groupBy("part"))
            .applyInArrow(_prefixes(parts, width, percent), SET_SCHEMA))
    return materialize(sets, "jaccard-sets")


def _least_overlap(n: str, m: str, percent: int) -> Column:
    """Smallest intersection at which sets of sizes ``n`` and ``m`` link."""
    return F.expr(f"({percent} * ({n} + {m}) + {99 + percent}) div {100 + percent}")


def _may_link(x: str, y: str, percent: int) -> Column:
    """Postings ``x`` and ``y`` of one shingle: can their groups link, and is this the shingle to
    find them by? The smaller (size, id) needs the shingle in its shorter, indexed prefix."""
    fits = lambda s, t: (
        (F.struct(f"{s}.n", f"{s}.gid") < F.struct(f"{t}.n", f"{t}.gid"))
        & (100 * F.col(f"{s}.n") >= percent * F.col(f"{t}.n"))
        & (F.col(f"{s}.rank") < F.expr(f"{s}.n - ({200 * percent} * {s}.n + {100 * (100 + percent) - 1}) "
                                       f"div {100 * (100 + percent)} + 1"))
        & (F.least(F.expr(f"{s}.n - {s}.rank"), F.expr(f"{t}.n - {t}.rank")) >= _least_overlap(f"{s}.n", f"{t}.n", percent)))
    return fits(x, y) | fits(y, x)


def _heads(postings: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Per ``keys``: range of sizes, most shingles from this one on, and whether any set has it
    in its indexed prefix."""
    early = F.col("rank") < F.expr(f"n - ({200 * percent} * n + {100 * (100 + percent) - 1}) div {100 * (100 + percent)} + 1")
    return postings.groupBy(*keys).agg(F.min("n").alias("lo"), F.max("n").alias("hi"),
                                       F.max(F.expr("n - rank")).alias("rest"), F.max(early).alias("early"))


def _heads_may_link(x: str, y: str, percent: int) -> Column:
    """Heads ``x`` and ``y`` of one shingle: can any two of their sets link by it?"""
    return ((100 * F.col(f"{x}.hi") >= percent * F.col(f"{y}.lo")) & (100 * F.col(f"{y}.hi") >= percent * F.col(f"{x}.lo"))
            & (F.least(f"{x}.rest", f"{y}.rest") >= _least_overlap(f"{x}.lo", f"{y}.lo", percent))
            & ((F.col(f"{x}.early") & (F.col(f"{x}.lo") <= F.col(f"{y}.hi")))
               | (F.col(f"{y}.early") & (F.col(f"{y}.lo") <= F.col(f"{x}.hi")))))


def _across(heads: DataFrame, percent: int) -> DataFrame:
    """``_t, _c, _d, h``: shingles at which sets of components ``_c`` < ``_d`` may link, with the head of ``_d``."""
    return (heads.alias("x").join(heads.alias("y"), (F.col("x.token") == F.col("y.token"))
                                  & (F.col("x.component") < F.col("y.component")) & _heads_may_link("x", "y", percent))
            .select(F.col("x.token").alias("_t"), F.col("x.component").alias("_c"), F.col("y.component").alias("_d"),
                    F.struct("y.lo", "y.hi", "y.rest", "y.early").alias("h")))


def _members_of(across: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs ``x, y`` of ``members`` that may link at an ``across`` row: members that fit the other
    component's head first, then pairs."""
    one = members.alias("x").join(across, (F.col("x.token") == F.col("_t")) & (F.col("x.component") == F.col("_c"))
                                  & _heads_may_link("x", "h", percent))
    return one.join(members.alias("y"), (F.col("y.token") == F.col("_t")) & (F.col("y.component") == F.col("_d"))
                    & _may_link("x", "y", percent))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``a, b`` pairs whose whole sets link."""

    @F.arrow_udf("boolean")
    def links(xs: pa.Array, ys: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(xs, ys, strict=True):
            x, y = (np.frombuffer(s.as_buffer(), "<u8") for s in (x, y))
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            both = int((y[at] == x).sum())
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pa.array(out, pa.bool_())

    one = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(one, "a").join(two, "b").filter(links("sa", "sb")).select("a", "b")


def _overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of sets, by dense products over some shingles at a time."""
    values, codes, counts = np.unique(np.concatenate(xs + ys), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(xs) + len(ys)), [len(s) for s in xs + ys])
    often = np.flatnonzero(counts[codes] > 1)
    often = often[np.argsort(codes[often], kind="stable")]
    codes, owner = codes[often], owner[often]
    out = np.zeros((len(xs), len(ys)), np.float32)
    step = 1024
    for low in range(0, len(values), step):
        a, b = np.searchsorted(codes, (low, low + step))
        if a == b:
            continue
        held = np.zeros((len(xs) + len(ys), step), np.float32)
        held[owner[a:b], codes[a:b] - low] = 1
        out += held[:len(xs)] @ held[len(xs):].T
    return out.astype(np.int64)


def _link_counts(nodes: DataFrame, percent: int) -> DataFrame:
    """``rep, links``: with how many other sets of its component each of ``nodes`` (``rep,
    component, blocks, shingles``) links."""

    def count(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        reps, block = table["rep"].to_numpy(), table["block"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), "<u8") for x in table["shingles"]]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(left) or not len(right):
            return pa.table({"rep": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        sizes = np.array([len(x) for x in sets])
        both = _overlaps([sets[k] for k in left], [sets[k] for k in right])
        link = 100 * both >= percent * (sizes[left][:, None] + sizes[right] - both)
        link &= reps[left][:, None] != reps[right]
        ids, links = reps[left], link.sum(1)
        if i != j:
            ids, links = np.concatenate((ids, reps[right])), np.concatenate((links, link.sum(0)))
        return pa.table({"rep": pa.array(ids, pa.int64()), "links": pa.array(links.astype(np.int64), pa.int64())})

    placed = nodes.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    met = placed.select("component", "rep", "block", "shingles",
                        F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("_o"))
    return (met.select("component", F.least("block", "_o").alias("i"), F.greatest("block", "_o").alias("j"), "rep", "block",
                       "shingles")
            .groupBy("component", "i", "j").applyInArrow(count, "rep bigint, links bigint")
            .groupBy("rep").agg(F.sum("links").alias("links")))


def _with_blocks(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """``nodes`` with their component's ``blocks`` of ``sizes`` (``_c, _n, blocks``). Large
    components are few, so their rows can stand under every salt."""
    large = (sizes.filter(F.col("_n") >= HOT_COMPONENT)
             .select("_c", F.col("blocks").alias("_large"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_s")))
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    met = nodes.withColumn("_salt", salt).join(
        large, (F.col("component") == F.col("_c")) & (F.col("_salt") == F.col("_s")), "left").drop("_c", "_s", "_salt")
    rest = (met.filter("_large is null").drop("_large")
            .join(sizes.filter(F.col("_n") < HOT_COMPONENT).select("_c", "blocks"), F.col("component") == F.col("_c")))
    return (met.filter("_large is not null").withColumnRenamed("_large", "blocks")
            .union(rest.select("node", "component", "links", "blocks")))


def _pairs(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH,
                      percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` per row of ``docs``.

    ``n_links`` counts the other classes that the document's class links with (copies of one
    set not counted): 0 for a document without near copies.
    """
    sets = document_sets(docs, doc_id, text, width, percent)
    # Classes of equal sets; their kept prefixes are equal, too.
    classes = materialize(
        sets.filter("n > 0").groupBy("sum1", "sum2", "n")
        .agg(F.min("doc_id").alias("rep"), F.first("tokens").alias("tokens"), F.first("ranks").alias("ranks"),
             F.first("shingles").alias("shingles")).filter("rep is not null"), "jaccard-classes")
    active = classes.filter(F.size("tokens") > 0)
    grouped = materialize(
        active.groupBy("n", "tokens", "ranks").agg(F.min("rep").alias("gid"))
        .select("gid", "n", F.explode(F.arrays_zip("tokens", "ranks")).alias("e"))
        .select("gid", "n", F.col("e.tokens").alias("token"), F.col("e.ranks").alias("rank")), "jaccard-postings")
    group_key = F.xxhash64("n", "tokens", "ranks")
    members = materialize(
        active.select("rep", group_key.alias("_k")).join(
            active.groupBy(group_key.alias("_k")).agg(F.min("rep").alias("gid")), "_k").select("rep", "gid"),
        "jaccard-members")
    hubs = materialize(
        grouped.groupBy("token").agg(F.min(F.struct("rank", "n", "gid")).alias("h"), F.count(F.lit(1)).alias("c"))
        .filter("c > 1").select("token", "h.rank", "h.n", "h.gid"), "jaccard-hubs")
    met = (grouped.alias("x").join(hubs.alias("y"), F.col("x.token") == F.col("y.token"))
           .filter(_may_link("x", "y", percent)).select(F.col("x.gid").alias("_g"), F.col("y.gid").alias("_hub")).distinct())
    expanded = members.join(met, F.col("gid") == F.col("_g")).select(*_pairs("rep", "_hub"))
    inside = members.filter("rep <> gid").select(*_pairs("rep", "gid"))
    whole = active.select("rep", "shingles")
    first = materialize(expanded.union(inside).distinct(), "jaccard-pairs")
    links = materialize(_verified(first, whole, percent), "jaccard-links")
    reached = components(links)

    # Second meeting: members of different components only.
    placed = (members.join(reached, members["rep"] == reached["node"], "left")
              .select("rep", "gid", F.coalesce("component", "rep").alias("component")))
    postings = materialize(
        grouped.join(placed.withColumnRenamed("gid", "_gid"), F.col("gid") == F.col("_gid"))
        .select("token", "rank", "n", F.col("rep").alias("gid"), "component"), "jaccard-members-postings")
    split = materialize(
        postings.groupBy("token").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi"))
        .filter("_lo <> _hi").select(F.col("token").alias("_t")), "jaccard-split")
    left = materialize(postings.join(split, F.col("token") == F.col("_t"), "left_semi"), "jaccard-left")
    ranged = materialize(_heads(left, ["token", "component", "gid", "n", "rank"], percent), "jaccard-ranged")
    across = _across(materialize(_heads(left, ["token", "component"], percent), "jaccard-heads"), percent)
    again = _members_of(across, ranged, percent).select(*_pairs("x.gid", "y.gid")).distinct()
    second = materialize(again.join(first, ["a", "b"], "left_anti"), "jaccard-pairs")
    all_links = materialize(links.union(_verified(second, whole, percent)), "jaccard-links")
    final = components(all_links)
    made = (all_links.select(F.explode(F.array("a", "b")).alias("_d")).groupBy("_d")
            .agg(F.count(F.lit(1)).alias("links")))
    nodes = materialize(
        final.join(made, F.col("node") == F.col("_d"))
        .join(active.select("rep", F.octet_length("shingles").alias("_b")), F.col("node") == F.col("rep"))
        .select("node", "component", "links", "_b"), "jaccard-nodes")
    # Where every pair of a component is a made link, nothing is left to count: no blocks.
    sizes = materialize(
        nodes.groupBy("component").agg(F.count(F.lit(1)).alias("_n"), F.sum("links").alias("_s"), F.sum("_b").alias("_b"))
        .select(F.col("component").alias("_c"), "_n", F.when(F.expr("_s < _n * (_n - 1)"), F.greatest(
            F.ceil(F.col("_n") / BLOCK_SETS), F.ceil(F.col("_b") / BLOCK_BYTES))).otherwise(0).alias("blocks")),
        "jaccard-sizes")
    split_nodes = materialize(_with_blocks(nodes.select("node", "component", "links"), sizes), "jaccard-blocks")
    counted = _link_counts(
        split_nodes.filter("blocks > 0").join(whole, F.col("node") == F.col("rep"))
        .select("rep", "component", "blocks", "shingles"), percent)
    whole_components = split_nodes.filter("blocks = 0")
    degree = materialize(whole_components.select(F.col("node").alias("_d"), "links")
                         .union(counted.select("rep", "links")), "jaccard-degree")
    known = materialize(
        classes.select("sum1", "sum2", "n", "rep")
        .join(final, F.col("rep") == F.col("node"), "left").join(degree, F.col("rep") == F.col("_d"), "left")
        .select("sum1", "sum2", "n", F.coalesce("component", "rep").alias("component_id"),
                F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links")), "jaccard-components")
    return (sets.select("doc_id", "n", "sum1", "sum2").join(known, ["sum1", "sum2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links")))


def keep_one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Pipeline form: of each component one row stays, its smallest doc_id's (all columns of
    ``docs``); of rows that repeat that doc_id one with the least text stays. Rows with a null doc_id all stay.

    The texts meet the ids to remove, which are few, not the ids to keep.
    """
    found = similar_documents(docs, doc_id, text, **options).filter("doc_id is not null")
    ids = materialize(found.groupBy("doc_id").agg(F.min("component_id").alias("component"), F.count(F.lit(1)).alias("n"))
                      .filter("n > 1 or doc_id <> component"), "jaccard-remove")
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    key = F.col(f"_row.{doc_id}") == F.col("_id")
    once = rows.join(ids.select(F.col("doc_id").alias("_id")), key, "left_anti")
    repeated = (rows.join(ids.filter("doc_id = component").select(F.col("doc_id").alias("_id")), key, "left_semi")
                .groupBy(F.col(f"_row.{doc_id}").alias("_id"))
                .agg(F.min_by("_row", f"_row.{text}").alias("_row")).select("_row"))
    return once.union(repeated).select("_row.*")
