"""Repeated byte strings: against a dictionary of all windows, odd rows, hot passages, long runs."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fixtures import no_documents, odd_documents
from playtally.llm import op11_suffix_dedup as op
from playtally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
SCHEMA = "doc_id long, text string, part string, digest int"


def brute(rows, width=50):
    """Rows of COLUMNS from ``(doc_id, text)``, by the smallest holder of every window."""
    order = [(float("inf") if i is None else i, i, (t or "").encode()) for i, t in rows]
    least = {}
    for rank, _, raw in order:
        for p in range(len(raw) - width + 1):
            w = raw[p:p + width]
            least[w] = min(least.get(w, rank), rank)
    out = []
    for rank, i, raw in order:
        gone = bytearray(len(raw))
        for p in range(len(raw) - width + 1):
            if least[raw[p:p + width]] < rank:
                gone[p:p + width] = b"\1" * width
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_suffix_dedup"](spark, SF)
    assert got.columns == COLUMNS
    assert rows_of(got) == brute([(r.doc_id, r.text) for r in docs])


def test_odd_rows(spark):
    docs = odd_documents(spark)
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    for kw in ({}, {"hot": 2}, {"part_bytes": 64, "sort_bytes": 200}):
        assert rows_of(op.digests(op.remove_repeats(docs, **kw))) == want


def test_empty_table(spark):
    assert op.remove_repeats(no_documents(spark)).collect() == []


def near_copies(n=120, seed=4):
    """A passage in many documents, a family of near copies, exact copies, and unlike texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh é") for _ in range(rng.randint(2, 9)))
    passage, base = " ".join(word() for _ in range(25)), [word() for _ in range(80)]
    rows = []
    for i in range(n):
        kind = i % 4
        if kind == 0:
            text = " ".join([word() for _ in range(20)] + [passage] + [word() for _ in range(20)])
        elif kind == 1:
            text = " ".join(w if rng.random() > 0.02 else word() for w in base)
        elif kind == 2:
            text = "the very same text in all of them, long enough to be a window or two of fifty bytes"
        else:
            text = " ".join(word() for _ in range(40))
        rows.append((rng.randint(0, 10_000), text, "p", 1))
    return rows


@pytest.mark.parametrize("hot", [3, 10, 10_000])
def test_passages_families_and_copies(spark, hot):
    rows = near_copies()
    got = op.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(3), hot=hot, part_bytes=3000, sort_bytes=4000)
    assert rows_of(op.digests(got)) == brute([(r[0], r[1]) for r in rows])


def test_long_runs_and_periods(spark):
    rows = [(1, "a" * 20_000, "p", 1), (2, "b" + "a" * 30_000 + "c", "p", 1), (3, "xy" * 4000, "p", 1),
            (4, "yx" * 300 + "q" * 49, "p", 1), (5, "q" * 49, "p", 1), (6, "q" * 50, "p", 1)]
    got = rows_of(op.digests(op.remove_repeats(spark.createDataFrame(rows, SCHEMA))))
    assert got == brute([(r[0], r[1]) for r in rows])


def test_kept_bytes_and_spans(spark):
    shared = "this passage of more than fifty bytes stands in both of the documents"
    rows = [(1, f"one {shared} end", "p", 1), (2, f"another beginning {shared}, other end", "p", 1)]
    got = {r.doc_id: r for r in op.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert bytes(got[1].kept).decode() == rows[0][1] and got[1].spans == []
    assert bytes(got[2].kept).decode() == "another beginning, other end"
    assert [(s.start, s.stop) for s in got[2].spans] == [(17, 17 + len(shared) + 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=90), min_size=1, max_size=5), st.integers(24, 40))
def test_equal_windows_have_equal_anchors(texts, width):
    raw = "".join(texts).encode()
    edges = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    w = op.Windows(np.frombuffer(raw, np.uint8), edges, width, chunk=16)
    seen, anchor_of = [], {}
    for s, n, a, d in zip(w.start.tolist(), w.count.tolist(), w.anchor.tolist(), w.doc.tolist(), strict=True):
        for p in range(s, s + n):
            assert edges[d] <= p and p + width <= edges[d + 1]
            assert anchor_of.setdefault(raw[p:p + width], a) == a
            seen.append(p)
    assert sorted(seen) == [p for lo, hi in zip(edges[:-1], edges[1:], strict=True) for p in range(lo, hi - width + 1)]


def test_a_parts_rows_may_come_in_any_order():
    """A shuffle gives each step the part's rows in an order of its own."""
    import pyarrow as pa

    rows = [(i, t.encode()) for i, t in [(r[0], r[1]) for r in near_copies(40)]]
    none = op._message_table([], 0, 0, [], [])

    def table(order):
        part = [rows[k] for k in order]
        return pa.table({"part": pa.array([0] * len(part), pa.int32()), "doc_id": pa.array([i for i, _ in part], pa.int64()),
                         "digest": pa.array([hashlib.sha256(t).digest() for _, t in part], pa.binary()),
                         "text": pa.array([t for _, t in part], pa.binary())})

    def groups(rows_, column):
        values = rows_[column].to_numpy()
        return [rows_.take(pa.array(np.flatnonzero(values == v))) for v in np.unique(values)]

    one, other = table(range(40)), table(reversed(range(40)))
    anchors = op._send_anchors(3, 50)(one, none)
    shared = pa.concat_tables([op._answer_anchors(5)(g) for g in groups(anchors, "bucket")])
    pieces = op._send_pieces(3, 4, 50)(one, shared)
    answers = pa.concat_tables([shared, *(op._answer_pieces(50, 3000)(g) for g in groups(pieces, "shard"))])
    both = [sorted(map(repr, op._spans(3, 4, 50)(t, answers).to_pylist())) for t in (one, other)]
    assert both[0] == both[1]


def test_memory_of_a_part(spark):
    """A part of the usual size whose windows are all shared, one anchor in twenty of them hot."""
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(1)
    texts = [rng.integers(97, 123, 3000, dtype=np.uint8).tobytes() for _ in range(op.PART_BYTES // 3000)]
    docs = pa.table({"part": pa.array([0] * len(texts), pa.int32()), "doc_id": pa.array(range(len(texts)), pa.int64()),
                     "digest": [hashlib.sha256(t).digest() for t in texts], "text": pa.array(texts, pa.binary())})
    sent = op._send_anchors(4, 50)(docs, op._message_table([], op._SHARED, 0, [], []))
    low = sent["low"].to_pylist()
    hot = [(np.arange(len(v) // 4) % 20 == 0).tobytes() for v in low]
    messages = op._message_table([0] * len(low), op._SHARED, 0, low, hot).set_column(2, "slot", sent["bucket"].combine_chunks())
    tracemalloc.start()
    try:
        out = op._send_pieces(4, 8, 50)(docs, messages)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(v) for v in out["sizes"].to_pylist()) > len(texts) * 100
    assert peak < 150 << 20
