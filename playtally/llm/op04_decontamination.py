"""Benchmark decontamination with training suffix arrays.

Every partition of the documents is cut into shards of about ``SHARD_WORDS``
words (whole documents). A shard's words become 64-bit ids, a suffix array over
them is built by prefix doubling (sorted on the first ``DEPTH`` words, which is
at least a window), and every suffix of every benchmark item is binary-searched
in it, all suffixes at once and word by word, each different window once. The
interval at window length holds all occurrences of the window; each occurrence is
extended word by word among the benchmark's own sorted suffixes to the longest
verbatim match. Neither repeats in a text nor items that share a window multiply.
Documents with an occurrence are contaminated.

The benchmark is the query set: it is read in blocks of at most
``BLOCK_BYTES`` of text, each broadcast on its own and searched against all
documents, so nothing unbounded is broadcast. With one block (the usual case)
the documents are read once and nothing is shuffled; with more, hits of the
blocks meet per document row.

Word ids are two independent polynomial hashes of a word's bytes folded into 64
bits; a false window needs ten collisions in a row.

Defined results: null and empty texts have no words and no hits; items without
words have no windows. An item_id that occurs in several rows counts once; a
null item_id's windows hit words but are not listed among the items. Repeated
document rows give repeated results. Extra columns are not read. An empty
benchmark contaminates nothing; empty documents give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import share_package
from playtally.llm.textscan import byte_class, scan_words, shards

WINDOW = 10
DEPTH = 16                  # words by which suffixes are sorted
SHARD_WORDS = 400_000
BLOCK_BYTES = 16 << 20      # benchmark text searched at once

# Word bytes after lower-casing: digits, a-z, and every byte of a non-ASCII character.
_WORD_BYTES = byte_class(range(ord("0"), ord("9") + 1), range(ord("a"), ord("z") + 1), range(128, 256))

MATCH_SCHEMA = ("struct<n_words: bigint, n_hit: bigint, spans: array<bigint>, items: array<string>, "
                "longest: bigint, longest_start: bigint, longest_item: string>")


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return scan_words(texts, _WORD_BYTES)


def suffix_array(ids: np.ndarray, edges: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of the shard, sorted on ``depth`` words; suffixes end with their document.

    Returns the array and, per position, the end of its document. Prefix doubling on dense
    ranks; stops as soon as all suffixes differ.
    """
    n = len(ids)
    ends = np.repeat(edges[1:], np.diff(edges))
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1
    step, at = 1, np.arange(n)
    while step < depth:
        after = np.zeros(n, np.int64)  # 0: past the document, before any word
        inside = at + step < ends
        after[inside] = rank[at[inside] + step]
        found, rank = np.unique(rank * (n + 2) + after, return_inverse=True)
        rank = rank.astype(np.int64) + 1
        step *= 2
        if len(found) == n:
            break
    return np.argsort(rank, kind="stable"), ends


class Benchmark:
    """A block of benchmark items: their words, and the suffixes that hold a window, in sorted order.

    Equal windows stand together, so a shard is searched once for each different window, and what
    is found are intervals of the shard's suffix array, whatever number of items share the window.
    """

    def __init__(self, item_ids: list[str | None], texts: list[str | None], window: int = WINDOW):
        self.names = item_ids
        self.ids, edges = word_ids(pc.fill_null(pa.array(texts, pa.string()), ""))
        sizes = np.diff(edges)
        self.item = np.repeat(np.arange(len(sizes)), sizes)
        order, self.ends = (suffix_array(self.ids, edges, int(sizes.max())) if len(self.ids)
                            else (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        length = np.minimum(window, np.repeat(sizes, sizes))
        order = order[order + length[order] <= self.ends[order]]     # suffixes that hold a window
        # By window length, then as sorted; where different windows begin.
        by = np.argsort(length[order], kind="stable")
        self.starts, self.window = order[by], length[order][by]
        self.full = window
        new = np.ones(len(by), bool)
        new[1:] = self.window[1:] != self.window[:-1]
        for d in range(window):
            inside = np.flatnonzero(d < self.window[1:]) + 1
            inside = inside[~new[inside]]
            new[inside] = self.ids[self.starts[inside] + d] != self.ids[self.starts[inside - 1] + d]
        self.first = np.flatnonzero(new)
        self.stop = np.append(self.first[1:], len(by))[:len(self.first)]

    def search(self, ids: np.ndarray, order: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Different windows (numbers) that occur, and their intervals of ``order``."""
        active, size = np.arange(len(self.first)), self.window[self.first]
        lo, hi = np.zeros(len(active), np.int64), np.full(len(active), len(order), np.int64)
        none = np.zeros(0, np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [(none, none, none)]
        for d in range(self.full):
            want = self.ids[self.starts[self.first[active]] + d]
            lo, hi = (_bisect(ids, order, ends, d, want, lo, hi, right) for right in (False, True))
            full = (size[active] == d + 1) & (hi > lo)
            found.append((active[full], lo[full], hi[full]))
            on = (size[active] > d + 1) & (hi > lo)
            active, lo, hi = active[on], lo[on], hi[on]
            if not len(active):
                break
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def extend(self, ids: np.ndarray, ends: np.ndarray, p: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, ...]:
        """Words of the longest verbatim match that starts at each occurrence, with any suffix that
        holds its window, and the interval of ``starts`` that match so far. An item that is itself a
        window has no more words."""
        lo, hi, length = self.first[number].copy(), self.stop[number].copy(), self.window[self.first[number]].copy()
        on = np.flatnonzero(length == self.full)
        while len(on):
            on = on[p[on] + length[on] < ends[p[on]]]
            want, d = ids[p[on] + length[on]], int(length[on[0]]) if len(on) else 0
            a, b = (_bisect(self.ids, self.starts, self.ends, d, want, lo[on], hi[on], right) for right in (False, True))
            more = b > a
            on = on[more]
            lo[on], hi[on] = a[more], b[more]
            length[on] += 1
        return length, lo, hi

    RESULT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(pa.int64())),
                        ("items", pa.list_(pa.string())), ("longest", pa.int64()), ("longest_start", pa.int64()),
                        ("longest_item", pa.string())])

    def matches(self, texts: pa.Array, earlier: list[dict | None]) -> pa.StructArray:
        """One shard's results: hit words in all and as spans (begin, end, begin, end, ...),
        items with an occurrence, longest match. ``earlier``: results of other blocks."""
        ids, edges = word_ids(texts)
        n, size = len(ids), np.diff(edges)
        rows = [{"n_words": int(w), "n_hit": 0, "spans": [], "items": [], "longest": 0, "longest_start": None,
                 "longest_item": None} for w in size]
        for row, old in zip(rows, earlier, strict=True):
            row.update(old or {})
        if n and len(self.starts):
            order, ends = suffix_array(ids, edges)
            number, lo, hi = self.search(ids, order, ends)
            if len(number):
                n = hi - lo
                at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                self._add(rows, ids, edges, ends, np.repeat(number, n), order[at])
        return pa.array(rows, self.RESULT)

    def _add(self, rows: list[dict], ids: np.ndarray, edges: np.ndarray, ends: np.ndarray,
             number: np.ndarray, p: np.ndarray) -> None:
        """Occurrences: at most one a shard position and window length."""
        doc = np.searchsorted(edges, p, side="right") - 1
        touched = np.unique(doc)
        cover = np.zeros(len(ids) + 1, np.int64)
        np.add.at(cover, p, 1)
        np.add.at(cover, p + self.window[self.first[number]], -1)
        for d in touched:
            old = np.array(rows[d]["spans"], np.int64) + edges[d]
            np.add.at(cover, old[0::2], 1)
            np.add.at(cover, old[1::2], -1)
        hit = np.cumsum(cover[:-1]) > 0
        for d in touched:
            own = np.concatenate(([False], hit[edges[d]:edges[d + 1]], [False]))
            rows[d]["spans"] = np.flatnonzero(own[1:] != own[:-1]).tolist()
            rows[d]["n_hit"] = int(own.sum())
        held = np.unique(doc * len(self.first) + number)
        items = {int(d): set(rows[d]["items"]) for d in touched}
        for pair in held.tolist():
            d, k = divmod(pair, len(self.first))
            items[d].update(self.names[i] for i in np.unique(self.item[self.starts[self.first[k]:self.stop[k]]]).tolist())
        for d, names in items.items():
            rows[d]["items"] = sorted(names - {None})
        length, lo, hi = self.extend(ids, ends, p, number)
        by = np.lexsort((p, -length, doc))
        heads = np.flatnonzero(np.concatenate(([True], np.diff(doc[by]) > 0)))
        for d, i, at in zip(doc[by[heads]].tolist(), by[heads].tolist(), heads.tolist(), strict=True):
            if length[i] > rows[d]["longest"]:
                # Of equally long matches at one place (an item of its own window's words, too) the first.
                same = by[at:at + self.full]   # one a window length, next to each other
                same = same[(doc[same] == d) & (p[same] == p[i]) & (length[same] == length[i])]
                first = min(int(self.starts[lo[j]:hi[j]].min()) for j in same)
                rows[d].update(longest=int(length[i]), longest_start=int(p[i] - edges[d]),
                               longest_item=self.names[int(self.item[first])])


def _bisect(ids: np.ndarray, order: np.ndarray, ends: np.ndarray, d: int, want: np.ndarray,
            lo: np.ndarray, hi: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of all wanted words at once among the words ``d`` of the suffixes in
    ``order[lo:hi]``; a suffix that ends before word ``d`` sorts first."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        at = order[np.where(open_, mid, 0)] + d
        inside = at < ends[np.where(open_, at - d, 0)]
        word = ids[np.where(inside, at, 0)]
        less = ~inside | (word < want) | (right & (word == want))
        lo = np.where(open_ & less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)
    return lo


def _benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, window: int,
                      block_bytes: int) -> Iterator[Benchmark]:
    """The items in blocks of bounded size, read one partition at a time."""
    names, texts, held = [], [], 0
    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"))
    for row in rows.toLocalIterator():
        names.append(row.i)
        texts.append(row.t)
        held += 4 * len(row.t or "")
        if held >= block_bytes:
            yield Benchmark(names, texts, window)
            names, texts, held = [], [], 0
    yield Benchmark(names, texts, window)


def _matcher(block: Broadcast) -> Callable:
    """Arrow UDF ``(text, earlier result) -> result`` for one block of items."""

    @F.arrow_udf(MATCH_SCHEMA)
    def match(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        items: Benchmark = block.value
        for texts, earlier in batches:
            texts, at, parts = pc.fill_null(texts, ""), 0, []
            for shard in shards(texts, 6 * SHARD_WORDS):  # six bytes a word, about
                parts.append(items.matches(shard, earlier.slice(at, len(shard)).to_pylist()))
                at += len(shard)
            yield pa.concat_arrays(parts) if parts else pa.array([], items.RESULT)

    return match


def match_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc`` (the input row as a struct) and ``match`` (MATCH_SCHEMA) for every row of ``docs``.

    Blocks of the benchmark are searched one after the other in the same tasks; a later block
    adds to the spans, items and longest match of the earlier ones.
    """
    spark = docs.sparkSession
    share_package(spark)
    found = docs.select(F.struct(*docs.columns).alias("doc"), F.lit(None).cast(MATCH_SCHEMA).alias("match"))
    for block in _benchmark_blocks(benchmark, item_id, item_text, window, block_bytes):
        matcher = _matcher(spark.sparkContext.broadcast(block))
        found = found.withColumn("match", matcher(F.col(f"doc.{text}"), F.col("match")))
    return found


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, longest, longest_start,
    longest_item`` per row of ``docs``."""
    found = match_documents(docs, benchmark, **options)
    return found.select(
        F.col(f"doc.{doc_id}").alias("doc_id"), "match.n_words", "match.n_hit",
        F.size("match.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("match.items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("match.n_hit") > 0).alias("contaminated"), "match.longest", "match.longest_start", "match.longest_item")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Pipeline form: the rows of ``docs`` without any benchmark window."""
    return match_documents(docs, benchmark, **options).filter("match.n_hit = 0").select("doc.*")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS bid, item_id::VARCHAR AS item_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n,
              array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT n FROM bw)
       WHERE i + n - 1 <= len(w)),
h AS (SELECT DISTINCT rid, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
c AS (SELECT rid, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
x AS (SELECT rid, list_sort(list(DISTINCT item_id)) AS items FROM h WHERE item_id IS NOT NULL GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN x USING (rid)
"""
