"""Whitening: exact sums and projections against numpy, weights, odd rows, hot vectors."""

import math

import numpy as np
import pytest

from playtally.llm import op13_embedding_whitening as op
from playtally.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, n string, key string"


def brute(rows):
    """``{(vec_id, component): (n, deviation, |whitened|, explained)}`` by plain numpy over the distinct x vectors."""
    kept = [(i, tuple(math.floor(64 * float(c)) + 1000000 for c in v)) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({x for _, x in kept}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    y = np.array((fit * n - sums) / n, dtype=float)
    values, axes = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:16]
    out = {}
    for i, x in kept:
        off = [n * a - s for a, s in zip(x, sums, strict=True)]
        z = (np.array(off, dtype=float) / n) @ axes[:, order] / np.sqrt(values[order])
        for c in range(len(order)):
            out[i, c + 1] = (n, sum(o * o for o in off), abs(z[c]), values[order[c]] / values.sum())
    return out


def check(got, want):
    assert len(got) == len(want)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for r in got:
        n, deviation, z, share = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(r.whitened) == pytest.approx(z, abs=1e-7) and r.explained == pytest.approx(share, rel=1e-9)


def test_query_matches_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op13_embedding_whitening"](spark, SF).collect()
    check(got, brute(rows))
    # One sign per component for all rows: projections keep their inner products.
    z = {}
    for r in got:
        z.setdefault(r.vec_id, {})[r.component] = r.whitened
    cov = np.cov(np.array([[v[c] for c in sorted(v)] for v in z.values()]).T, bias=True)
    assert np.abs(cov - np.eye(len(cov))).max() < 0.1   # repeats apart, the whole table is white


def sample(seed=3, n=60, dim=5):
    rng = np.random.default_rng(seed)
    return [[float(np.float32(v)) for v in row] for row in rng.normal(size=(n, dim)) @ rng.normal(size=(dim, dim))]


def test_odd_rows(spark):
    vectors = sample()
    rows = [(i, v, 1, "n", "k") for i, v in enumerate(vectors)]
    rows += [(100 + i, vectors[0], 1, "n", "k") for i in range(400)]           # a hot vector, once in the fit list
    near = [v + 2.0**-20 if v > 0 else v for v in vectors[1]]
    rows += [(600, near, 1, None, None), (601, None, 1, "n", "k"), (602, [None] * 5, 1, "n", "k"),
             (603, [float("nan")] * 5, 1, "n", "k"), (604, [float("inf"), 0.0, 0.0, 0.0, 0.0], 1, "n", "k"),
             (605, [1.0, 2.0], 1, "n", "k"), (606, [], 1, "n", "k")]
    got = op.component_rows(op.whiten(spark.createDataFrame(rows, SCHEMA).repartition(4))).collect()
    check(got, brute([(r[0], r[1]) for r in rows[:-2]]))
    assert {r.vec_id for r in got} == set(range(60)) | set(range(100, 500)) | {600}
    assert max(r.component for r in got) == 5


def test_repeated_and_null_ids_keep_their_rows(spark):
    rows = [(i % 3 if i % 4 else None, v, 1, "n", "k") for i, v in enumerate(sample(n=20))]
    got = op.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)


def test_counts_as_weights(spark):
    vectors = sample(n=12)
    rows = [(i, vectors[i % 12 if i < 30 else 0], 1, "n", "k") for i in range(50)]
    got = op.whiten(spark.createDataFrame(rows, SCHEMA), weights="count").collect()
    x = np.array([[math.floor(64 * c) for c in r[1]] for r in rows], float)
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    z = np.abs((x - x.mean(axis=0)) @ axes[:, ::-1] / np.sqrt(values[::-1]))
    assert got[0].n == 50 and got[0].identity_error < 1e-9
    for r in got:
        assert np.abs(r.whitened) == pytest.approx(z[r.vec_id], abs=1e-7)


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 1.0], 1, "n", "k")] * 3, [(1, None, 1, "n", "k")], [(1, [], 1, "n", "k")]])
def test_no_spread_gives_no_rows(spark, rows):
    whitened = op.whiten(spark.createDataFrame(rows, SCHEMA))
    assert op.component_rows(whitened).collect() == []
    assert [f.name for f in op.component_rows(whitened).schema] == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_flat_dimensions_are_left_out_and_wide_entries_are_exact(spark):
    rows = [(i, [float(i), 2.0, float(1 << 40) * (i % 3)], 1, "n", "k") for i in range(9)]
    got = op.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {len(r.whitened) for r in got} <= {1, 2}
    exact = {r.vec_id: r.deviation for r in got}
    assert exact[0] is None and exact[2] is None              # beyond a long
    assert exact[4] == 0 and exact[1] == (9 * 64 - 36 * 64) ** 2
    keys = op.pack(np.array([[1, -1], [300, 0], [1 << 20, 5], [1 << 50, 5]]))
    assert [len(k) for k in keys] == [3, 5, 9, 17]
    assert op.unpack(keys, 2).tolist() == [[1000001, 999999], [1000300, 1000000], [(1 << 20) + 1000000, 1000005],
                                          [(1 << 50) + 1000000, 1000005]]
