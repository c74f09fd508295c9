"""Removal of repeated byte strings by suffix arrays over content shards.

A byte goes if a ``width``-byte string that covers it also starts in a document with a
smaller doc_id. Texts are UTF-8 bytes, strings never cross documents, and all are judged
on the input.

1. *Documents are dealt* into parts by hash. Of rows with one text (equal SHA-256) only
   that with the smallest id goes on; the others lose every byte, if there are ``width``.
2. *Anchors.* Each window of ``width`` bytes has an anchor, the least hash of its
   ``GRAM``-byte strings, so equal windows have equal anchors. A part sends its distinct
   anchors (four bytes and a document count each), a bucket adds the counts and answers
   which occur in several documents: only windows with such an anchor can repeat.
3. *Pieces.* Neighbouring windows with one anchor form a piece of text. A part sends each
   different piece once, with its smallest doc_id, to the shard of the anchor: all equal
   windows meet in one shard. Around an anchor of ``HOT`` documents or more the pieces are
   single windows, dealt by their own content, so a passage that a third of all documents
   hold costs one window a part, and the differing windows at its edges spread.
4. *Shards.* Different pieces are put end to end and sorted by induced sorting (see
   :mod:`playtally.llm.suffixes`); permuted common prefixes of ``width`` bytes or more join
   equal windows, whose smallest doc_id answers the pieces, as one bit a window.
5. Parts turn the answers into removed spans.

Parts, buckets and shards grow in number with the text, not in size; what travels is
packed, one row for each pair of them. Documents are shuffled once and that shuffle is
used by the three steps that need texts.

Defined results: null texts are empty. A null doc_id is larger than all others. Rows
with equal doc_id never remove from each other (repeated rows keep their bytes). Texts
shorter than ``width`` keep everything. Extra columns are not read. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import share_package, shuffle_width
from playtally.llm.suffixes import permuted_lcp, suffix_array, words_at
from playtally.llm.textscan import mix
from playtally.session import materialize

WIDTH = 50
GRAM = 24
HOT = 200                 # documents with an anchor from which on windows are dealt one by one
HASHED = 1 << 15          # windows hashed together
RUN = 64                  # windows of a piece, at most: one bit each in an answer
PART_BYTES = 6 << 20      # text of a part, about: a task holds some thirty times as much
BUCKET_BYTES = 96 << 20   # text for each anchor bucket
SHARD_BYTES = 6 << 20     # text for each shard
SORT_BYTES = 1 << 20      # pieces sorted together, about

_NULL_ID = 2**63 - 1
_BITS = np.uint64(32)
_LOW = np.uint64((1 << 32) - 1)
_COPY, _SHARED, _ANSWER = 0, 1, 2

MESSAGE_SCHEMA = "part int, kind int, slot int, n bigint, a binary, b binary"
ANCHOR_SCHEMA = "bucket int, part int, low binary, docs binary"
PIECE_SCHEMA = "shard int, part int, bytes binary, sizes binary, ids binary"
SPAN_SCHEMA = "doc_id bigint, n_bytes bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary"


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes that start at each position."""
    word = words_at(raw)
    x = word * np.uint64(0x9E3779B97F4A7C15)
    for at in range(8, GRAM, 8):
        x[:-at] += word[at:]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def least_ahead(x: np.ndarray, span: int) -> np.ndarray:
    """The least of the ``span`` values from each position on (fewer at the end)."""
    least, held = x.copy(), 1
    while held < span:
        step = min(held, span - held)
        least[:-step] = np.minimum(least[:-step], least[step:])
        held += step
    return least


class Windows:
    """The windows of some texts, as pieces with one anchor."""

    def __init__(self, raw: np.ndarray, edges: np.ndarray, width: int, chunk: int = 1 << 18):
        anchors, starts = [], []
        for at in range(0, len(raw), chunk):      # a chunk's hashes stay in the processor's cache
            some = raw[at:at + chunk + width]
            least = least_ahead(gram_hashes(some), width - GRAM + 1)[:chunk]
            new = np.concatenate(([True], least[1:] != least[:-1]))
            # Documents begin pieces, and their last ``width - 1`` positions begin none.
            first = np.searchsorted(edges, at)
            inside = edges[first:np.searchsorted(edges, at + len(least))] - at
            new[inside] = True
            where = np.flatnonzero(new)
            starts.append(where + at)
            anchors.append(least[where])
        start = np.concatenate([np.zeros(0, np.int64), *starts])
        anchor = np.concatenate([np.zeros(0, np.uint64), *anchors])
        doc = np.searchsorted(edges, start, side="right") - 1
        last = edges[doc + 1] - width + 1 if len(start) else start      # windows begin before this
        stop = np.minimum(np.append(start[1:], len(raw)), last)
        kept = stop > start
        start, stop, anchor, doc = start[kept], stop[kept], mix(anchor[kept]), doc[kept]
        times = -(-(stop - start) // RUN)
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        self.start = np.repeat(start, times) + step * RUN
        self.count = np.minimum(np.repeat(stop, times) - self.start, RUN)
        self.anchor, self.doc = np.repeat(anchor, times), np.repeat(doc, times)


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> _BITS) % np.uint64(buckets)).astype(np.int64)


class Part:
    """A part's documents: ids (null as the largest), joined bytes, and the rows that copy a smaller one."""

    def __init__(self, docs: pa.Table, messages: pa.Table, width: int):
        # A shuffle delivers rows in any order, and answers name pieces by their place: a fixed order.
        docs = docs.take(pc.sort_indices(docs, sort_keys=[("digest", "ascending"), ("doc_id", "ascending")]))
        self.given = docs["doc_id"].combine_chunks()
        self.ids = pc.fill_null(self.given, _NULL_ID).to_numpy(zero_copy_only=False)
        texts = docs["text"].combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        self.edges = offsets - offsets[0]
        self.raw = (np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8))
        kinds = messages["kind"].to_numpy()
        self.messages = {kind: messages.take(pa.array(np.flatnonzero(kinds == kind))) for kind in (_COPY, _SHARED, _ANSWER)}
        first = dict(zip(self.messages[_COPY]["a"].to_pylist(), self.messages[_COPY]["n"].to_pylist(), strict=True))
        copies = pc.is_in(docs["digest"].combine_chunks(), value_set=pa.array(list(first), pa.binary()))
        self.copy = copies.to_numpy(zero_copy_only=False).astype(bool)
        for i in np.flatnonzero(self.copy):
            self.copy[i] = first[docs["digest"][int(i)].as_py()] < self.ids[i]
        self.width = width

    def windows(self) -> Windows:
        found = Windows(self.raw, self.edges, self.width)
        keep = ~self.copy[found.doc]
        for name in ("start", "count", "anchor", "doc"):
            setattr(found, name, getattr(found, name)[keep])
        return found

    def pieces(self, buckets: int) -> Windows:
        """Pieces whose anchor several documents share; around hot anchors, single windows."""
        w = self.windows()
        known, hot = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
        for slot, a, b in zip(*(self.messages[_SHARED][c].to_pylist() for c in ("slot", "a", "b")), strict=True):
            known.append((np.uint64(slot) << _BITS) | np.frombuffer(a, "<u4").astype(np.uint64))
            hot.append(np.frombuffer(b, bool))
        known, hot = np.concatenate(known), np.concatenate(hot)
        by = np.argsort(known)
        known, hot = known[by], hot[by]
        key = (_bucket(w.anchor, buckets).astype(np.uint64) << _BITS) | (w.anchor & _LOW)
        at = np.searchsorted(known, key)
        shared = np.zeros(len(key), bool)
        inside = at < len(known)
        shared[inside] = known[at[inside]] == key[inside]
        single = np.zeros(len(key), bool)
        single[shared] = hot[at[shared]]
        times = np.where(single, w.count, 1)[shared]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        w.start = np.repeat(w.start[shared], times) + step
        w.count = np.repeat(np.where(single, 1, w.count)[shared], times)
        w.anchor, w.doc = np.repeat(w.anchor[shared], times), np.repeat(w.doc[shared], times)
        w.single = np.repeat(single[shared], times)
        return w


def _gather(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte ranges (of ``GRAM`` bytes at least, in less than 2 GB) end to end, and their offsets."""
    if not len(start):
        return raw[:0], np.zeros(1, np.int64)
    # As views into the bytes (size, first four bytes, buffer, offset), which Arrow then copies.
    views = np.zeros((len(start), 4), np.int32)
    views[:, 0], views[:, 3] = size, start
    views[:, 1] = np.lib.stride_tricks.sliding_window_view(raw, 4)[start].view(np.int32)[:, 0]
    found = pa.Array.from_buffers(pa.binary_view(), len(start), [None, pa.py_buffer(views), pa.py_buffer(raw)]).cast(pa.large_binary())
    offsets = np.frombuffer(found.buffers()[1], np.int64)[found.offset:found.offset + len(found) + 1]
    return np.frombuffer(found.buffers()[2], np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def distinct_ranges(raw: np.ndarray, start: np.ndarray, size: np.ndarray, chunk: int = 8 << 20) -> tuple[np.ndarray, np.ndarray]:
    """A number for each byte range, equal ones the same, and for each number one range that has
    it. Exact; works on ``chunk`` bytes at a time, then on what they differ in."""
    code, reps, at = np.zeros(len(start), np.int64), [], 0
    ends = np.cumsum(size)
    known = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + chunk, side="right")))
        some = _binary(*_gather(raw, start[at:stop], size[at:stop])).dictionary_encode()
        index = some.indices.to_numpy()
        first = np.full(len(some.dictionary), len(index), np.int64)
        np.minimum.at(first, index, np.arange(len(index)))
        code[at:stop] = index + known
        reps.append(first + at)
        known += len(first)
        at = stop
    rep = np.concatenate([np.zeros(0, np.int64), *reps])
    if len(reps) < 2:
        return code, rep
    if len(rep) == len(start):        # nothing fell together inside the chunks
        whole = _binary(*_gather(raw, start, size)).dictionary_encode().indices.to_numpy().astype(np.int64)
    else:
        whole, rep2 = distinct_ranges(raw, start[rep], size[rep], chunk)
        return whole[code], rep[rep2]
    first = np.full(whole.max() + 1, len(whole), np.int64)
    np.minimum.at(first, whole, np.arange(len(whole)))
    return whole[code], rep[first]


def _least(code: np.ndarray, ids: np.ndarray, size: int) -> np.ndarray:
    least = np.full(size, _NULL_ID, np.int64)
    np.minimum.at(least, code, ids)
    return least


def _send_anchors(buckets: int, width: int) -> Callable:
    def send(docs: pa.Table, messages: pa.Table) -> pa.Table:
        rows: dict[str, list] = {"bucket": [], "part": [], "low": [], "docs": []}
        if len(docs):
            w = Part(docs, messages, width).windows()
            key = (_bucket(w.anchor, buckets).astype(np.uint64) << _BITS) | (w.anchor & _LOW)
            by = np.argsort(key, kind="stable")
            key, doc = key[by], w.doc[by]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            each = new.copy()                                     # an anchor counts once a document
            each[1:] |= doc[1:] != doc[:-1]
            first = np.flatnonzero(new)
            count = np.minimum(np.add.reduceat(each.astype(np.int64), first), 255) if len(first) else first
            key = key[first]
            bucket = (key >> _BITS).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(key) else first
            part = docs["part"][0].as_py()
            for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)], strict=False):
                rows["bucket"].append(int(bucket[lo]))
                rows["part"].append(part)
                rows["low"].append((key[lo:hi] & _LOW).astype("<u4").tobytes())
                rows["docs"].append(count[lo:hi].astype(np.uint8).tobytes())
        return pa.table({"bucket": pa.array(rows["bucket"], pa.int32()), "part": pa.array(rows["part"], pa.int32()),
                         "low": pa.array(rows["low"], pa.binary()), "docs": pa.array(rows["docs"], pa.binary())})

    return send


def _message_table(part: list, kind: int, slot: int, a: list, b: list) -> pa.Table:
    n = len(part)
    return pa.table({"part": pa.array(part, pa.int32()), "kind": pa.array([kind] * n, pa.int32()),
                     "slot": pa.array([slot] * n, pa.int32()), "n": pa.nulls(n, pa.int64()),
                     "a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def _answer_anchors(hot: int) -> Callable:
    """A bucket's counts; each part learns which of its anchors several documents hold, and which
    are hot. Two anchors with the same low bits count together, which can only send more pieces."""

    def answer(table: pa.Table) -> pa.Table:
        lows = [np.frombuffer(v, "<u4") for v in table["low"].to_pylist()]
        low = np.concatenate(lows)
        by = np.argsort(low, kind="stable")
        value = low[by]
        first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        docs = np.concatenate([np.frombuffer(v, np.uint8) for v in table["docs"].to_pylist()]).astype(np.int64)
        total = np.empty(len(low), np.int64)
        total[by] = np.repeat(np.add.reduceat(docs[by], first), np.diff(first, append=len(low)))
        out: tuple[list, list, list] = ([], [], [])
        at = 0
        for part, some in zip(table["part"].to_pylist(), lows, strict=True):
            sums = total[at:at + len(some)]
            at += len(some)
            keep = sums > 1
            if keep.any():
                for column, v in zip(out, (part, some[keep].tobytes(), (sums[keep] >= hot).tobytes()), strict=True):
                    column.append(v)
        return _message_table(out[0], _SHARED, table["bucket"][0].as_py(), out[1], out[2])

    return answer


class _Pieces:
    """A part's pieces, each different one once, in the order in which shards get them."""

    def __init__(self, part: Part, buckets: int, shards: int):
        w = part.pieces(buckets)
        self.windows, width = w, part.width
        self.code, rep = distinct_ranges(part.raw, w.start, w.count + width - 1)
        self.least = _least(self.code, part.ids[w.doc], len(rep))
        self.start, self.count = w.start[rep], w.count[rep]
        by_anchor = w.anchor[rep]
        single = np.flatnonzero(w.single[rep])
        if len(single):                         # single windows are dealt by their own content
            for at in range(0, len(single), HASHED):
                some = single[at:at + HASHED]
                data, _ = _gather(part.raw, self.start[some], np.full(len(some), width))
                by_anchor[some] = content_hash(data.reshape(len(some), width))
        self.shard = (mix(by_anchor) % np.uint64(shards)).astype(np.int64)
        self.order = np.argsort(self.shard, kind="stable")
        held = self.shard[self.order]
        self.cuts = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1]))) if len(held) else self.order[:0]
        self.slots = held[self.cuts]
        self.stops = np.append(self.cuts[1:], len(held))[:len(self.cuts)]


def content_hash(rows: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, :rows.shape[1]] = rows
    words = padded.view("<u8")
    x = np.zeros(len(rows), np.uint64)
    for k in range(words.shape[1]):
        x = mix(x + words[:, k] + np.uint64(k + 1))
    return x


def _send_pieces(buckets: int, shards: int, width: int) -> Callable:
    def send(docs: pa.Table, messages: pa.Table) -> pa.Table:
        rows: dict[str, list] = {"shard": [], "part": [], "bytes": [], "sizes": [], "ids": []}
        if len(docs):
            part = Part(docs, messages, width)
            p = _Pieces(part, buckets, shards)
            name = docs["part"][0].as_py()
            for slot, lo, hi in zip(p.slots.tolist(), p.cuts.tolist(), p.stops.tolist(), strict=True):
                at = p.order[lo:hi]
                rows["shard"].append(slot)
                rows["part"].append(name)
                rows["bytes"].append(_gather(part.raw, p.start[at], p.count[at] + width - 1)[0].tobytes())
                rows["sizes"].append(p.count[at].astype(np.uint8).tobytes())
                rows["ids"].append(p.least[at].astype("<i8").tobytes())
        return pa.table({"shard": pa.array(rows["shard"], pa.int32()), "part": pa.array(rows["part"], pa.int32()),
                         **{c: pa.array(rows[c], pa.binary()) for c in ("bytes", "sizes", "ids")}})

    return send


def repeated_windows(raw: np.ndarray, start: np.ndarray, count: np.ndarray, ids: np.ndarray, width: int) -> np.ndarray:
    """For each piece (its ``count`` windows begin at ``start``) the windows that a smaller id's
    piece holds, one bit each. Pieces differ; ``ids`` are their smallest."""
    size = count + width - 1
    data, offsets = _gather(raw, start, size)
    # Codes: 0 ends the text, 1 a piece; UTF-8 has no byte above 0xF4, so bytes + 2 stay bytes.
    text = np.ones(len(data) + len(start) + 1, np.uint8)
    text[-1] = 0
    begin = offsets[:-1] + np.arange(len(start))
    text[np.arange(len(data)) + np.repeat(np.arange(len(start)), size)] = data + 2
    room = np.repeat(begin + size, size + 1)
    room = np.append(room, len(text) - 1) - np.arange(len(text))
    order = suffix_array(text)
    same = permuted_lcp(text, order, room)[order] >= width
    first = np.flatnonzero(~same)
    piece = np.append(np.repeat(np.arange(len(start)), size + 1), 0)
    is_window = room >= width
    holder = np.where(is_window, ids[piece], _NULL_ID)
    least = np.empty(len(text), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(holder[order], first), np.diff(first, append=len(text)))
    at = np.flatnonzero(is_window & (least < holder))
    bits = np.zeros(len(start), np.uint64)
    np.bitwise_or.at(bits, piece[at], np.uint64(1) << (at - begin[piece[at]]).astype(np.uint64))
    return bits


def _all_bits(count: np.ndarray) -> np.ndarray:
    return ~np.uint64(0) >> (np.uint64(64) - count.astype(np.uint64))


def _answer_pieces(width: int, sort_bytes: int) -> Callable:
    def answer(table: pa.Table) -> pa.Table:
        raw = np.frombuffer(b"".join(table["bytes"].to_pylist()), np.uint8)
        counts = [np.frombuffer(v, np.uint8) for v in table["sizes"].to_pylist()]
        count = np.concatenate(counts).astype(np.int64)
        ids = np.concatenate([np.frombuffer(v, "<i8") for v in table["ids"].to_pylist()])
        size = count + width - 1
        start = np.cumsum(size) - size
        code, rep = distinct_ranges(raw, start, size)
        least = _least(code, ids, len(rep))
        # Equal windows have equal anchors. A piece that has its anchor alone repeats in no other
        # (its copies are counted by ``least``), nor do single windows that differ; the others are
        # sorted, groups of anchors apart.
        anchor = head_anchors(_gather(raw, start[rep], np.full(len(rep), width))[0], width)
        _, number, times = np.unique(anchor, return_inverse=True, return_counts=True)
        wide = np.zeros(len(times), bool)
        wide[number[count[rep] > 1]] = True
        open_ = np.flatnonzero((times[number] > 1) & wide[number])
        bits = np.zeros(len(rep), np.uint64)
        group = mix(anchor[open_]) % np.uint64(max(1, int(size[rep[open_]].sum()) // sort_bytes))
        by = np.argsort(group, kind="stable")
        for some in np.split(open_[by], np.flatnonzero(np.diff(group[by])) + 1):
            if len(some):
                bits[some] = repeated_windows(raw, start[rep[some]], count[rep[some]], least[some], width)
        found = np.where(ids > least[code], _all_bits(count), bits[code])
        out: tuple[list, list, list] = ([], [], [])
        at = 0
        for part, some in zip(table["part"].to_pylist(), counts, strict=True):
            mine = found[at:at + len(some)]
            at += len(some)
            hit = np.flatnonzero(mine)
            if len(hit):
                for column, v in zip(out, (part, hit.astype("<u4").tobytes(), mine[hit].astype("<u8").tobytes()), strict=True):
                    column.append(v)
        return _message_table(out[0], _ANSWER, table["shard"][0].as_py(), out[1], out[2])

    return answer


def head_anchors(heads: np.ndarray, width: int) -> np.ndarray:
    """The anchor of each window of ``heads`` (end to end)."""
    out = [np.zeros(0, np.uint64)]
    for at in range(0, len(heads), width << 12):
        out.append(least_ahead(gram_hashes(heads[at:at + (width << 12)]), width - GRAM + 1)[::width])
    return mix(np.concatenate(out))


def _spans(buckets: int, shards: int, width: int) -> Callable:
    def spans(docs: pa.Table, messages: pa.Table) -> pa.Table:
        out: dict[str, list] = {"n_bytes": [], "spans": [], "kept": []}
        part = Part(docs, messages, width)
        if len(docs):
            p = _Pieces(part, buckets, shards)
            bits = np.zeros(len(p.start), np.uint64)
            lo_of = dict(zip(p.slots.tolist(), p.cuts.tolist(), strict=True))
            answers = part.messages[_ANSWER]
            for slot, a, b in zip(*(answers[c].to_pylist() for c in ("slot", "a", "b")), strict=True):
                bits[p.order[lo_of[slot] + np.frombuffer(a, "<u4").astype(np.int64)]] = np.frombuffer(b, "<u8")
            w = p.windows
            later = part.ids[w.doc] > p.least[p.code]
            found = np.where(later, _all_bits(w.count), bits[p.code])
            hit = np.flatnonzero(found)
            found, start, count = found[hit], w.start[hit], w.count[hit]
            # +1 where a removed window begins, -1 behind its end; whole pieces as one range.
            full = found == _all_bits(count)
            begin, end = [start[full]], [start[full] + count[full] + width - 1]
            rest = np.flatnonzero(~full)
            for k in range(RUN):
                at = start[rest[(found[rest] >> np.uint64(k)) & np.uint64(1) == 1]] + k
                begin.append(at)
                end.append(at + width)
            long_copies = np.flatnonzero(part.copy & (np.diff(part.edges) >= width))
            begin.append(part.edges[long_copies])
            end.append(part.edges[long_copies + 1])
            change = np.zeros(len(part.raw) + 1, np.int32)
            np.add.at(change, np.concatenate(begin), 1)
            np.subtract.at(change, np.concatenate(end), 1)
            gone = np.cumsum(change[:-1]) > 0
            for i, (lo, hi) in enumerate(zip(part.edges[:-1].tolist(), part.edges[1:].tolist(), strict=True)):
                mine = gone[lo:hi]
                out["n_bytes"].append(hi - lo)
                if hi == lo or not mine.any():
                    out["spans"].append([])
                    out["kept"].append(part.raw[lo:hi].tobytes())
                    continue
                edge = np.flatnonzero(np.diff(np.concatenate(([False], mine, [False]))))
                out["spans"].append([{"start": s, "stop": e} for s, e in edge.reshape(-1, 2).tolist()])
                out["kept"].append(part.raw[lo:hi][~mine].tobytes())
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table({"doc_id": part.given, "n_bytes": pa.array(out["n_bytes"], pa.int64()),
                         "spans": pa.array(out["spans"], kind), "kept": pa.array(out["kept"], pa.large_binary()).cast(pa.binary())})

    return spans


def _copy_messages(docs: DataFrame) -> DataFrame:
    """Which texts of a part have copies, and the smallest doc_id that holds them: grouped by text
    and part first, so a text that a third of all rows hold costs one row a part."""
    own = materialize(docs.groupBy("digest", "part").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("rows")), "digests")
    total = own.groupBy("digest").agg(F.min("least").alias("n"), F.sum("rows").alias("_rows")).filter("_rows > 1")
    return materialize(own.join(total, "digest").select(
        "part", F.lit(_COPY).alias("kind"), F.lit(0).alias("slot"), "n", F.col("digest").alias("a"),
        F.lit(None).cast("binary").alias("b")), "copies")


def remove_repeats(docs: DataFrame, width: int = WIDTH, hot: int = HOT, part_bytes: int = PART_BYTES,
                   sort_bytes: int = SORT_BYTES) -> DataFrame:
    """SPAN_SCHEMA, one row per document: removed byte spans and the bytes that stay."""
    if width < GRAM:
        raise ValueError(f"width must be {GRAM} at least")
    spark = docs.sparkSession
    share_package(spark)
    least = shuffle_width(spark)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(least, -(-total // part_bytes))
    buckets = max(least, -(-total // BUCKET_BYTES))
    shards = max(least, -(-total // SHARD_BYTES))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "digest"), F.lit(parts)).cast("int"))
    copies = _copy_messages(rows.select("digest", "part", F.coalesce("doc_id", F.lit(_NULL_ID)).alias("id")))
    dealt = rows.select("part", "doc_id", "digest", F.col("text").cast("binary").alias("text")).repartition(parts, "part")

    def meet(messages: DataFrame, act: Callable, schema: str) -> DataFrame:
        return dealt.groupBy("part").cogroup(messages.repartition(parts, "part").groupBy("part")).applyInArrow(act, schema)

    anchors = meet(copies, _send_anchors(buckets, width), ANCHOR_SCHEMA).repartition(buckets, "bucket")
    shared = copies.union(anchors.groupBy("bucket").applyInArrow(_answer_anchors(hot), MESSAGE_SCHEMA))
    pieces = meet(shared, _send_pieces(buckets, shards, width), PIECE_SCHEMA).repartition(shards, "shard")
    answers = pieces.groupBy("shard").applyInArrow(_answer_pieces(width, sort_bytes), MESSAGE_SCHEMA)
    return meet(shared.union(answers), _spans(buckets, shards, width), SPAN_SCHEMA)


def digests(found: DataFrame) -> DataFrame:
    """The operator's rows as counts and a digest of what stays."""
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
