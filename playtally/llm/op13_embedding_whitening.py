"""Embedding whitening by a covariance weighted with multiplicities.

1. *Groups.* An entry ``c`` becomes the integer ``x = floor(64 c) + 1000000``. Each task
   writes its vectors as compact keys (``x - 1000000`` in the fewest bytes that hold it),
   equal ones of a slice once with the list of their ids, so a vector that a third of all
   rows hold costs one row a slice. A group-by of the keys gives the distinct vectors and
   how often each occurs.
2. *Fit.* The fit list is the distinct vectors, each with weight one, or its count
   (``weights="count"``). Per-dimension sums are exact integers. A second pass centres the
   vectors and adds up ``w (x - m)(x - m)'`` by one matrix product a slice; what leaves a
   task is a matrix of dimension squared, summed row by row on Spark.
3. *Whitening.* The eigenvectors of that matrix (dimension squared numbers, the only thing
   that reaches the driver) whiten each distinct vector once. A third pass takes the
   covariance of the whitened vectors themselves, for the identity error.
4. The ids are joined back to their key's whitened vector.

Defined results. Rows whose vector is null or holds null, NaN or infinite entries are
left out. The dimension is the commonest length among the other rows (ties: the smaller);
vectors of another length, or of none, have no coordinates in that space and are left out.
Components whose eigenvalue is zero to double precision (at most ``dim * 2^-52`` of the
largest) cannot be scaled to one and are not returned, so a table with a single distinct
vector, or none, gives no rows. Entries beyond +-2^56 are held at +-2^62 as x. Null and
repeated ids are kept as they are. ``deviation`` is exact, null where it exceeds a long.
Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.llm.common import share_package
from playtally.session import materialize

# Fixed values of the contract.
STEP = 64
SHIFT = 1_000_000
COMPONENTS = 16

SLICE_ROWS = 20_000
_WIDTHS = ("<i1", "<i2", "<i4", "<i8")
GROUP_SCHEMA = "key binary, dim int, ids array<bigint>, n bigint"


def quantize(values: np.ndarray) -> np.ndarray:
    """``floor(64 c)`` of finite doubles, as integers held inside +-2^62."""
    return np.clip(np.floor(values * STEP), -2.0**62, 2.0**62).astype(np.int64)


def pack(rows: np.ndarray) -> list[bytes]:
    """One key a row: its width code, then its entries in the fewest bytes that hold them all."""
    low, high = rows.min(axis=1), rows.max(axis=1)
    code = np.zeros(len(rows), np.int64)
    for k, name in enumerate(_WIDTHS[:-1]):
        limits = np.iinfo(name)
        code[(low < limits.min) | (high > limits.max)] = k + 1
    keys: list[bytes] = [b""] * len(rows)
    for k, name in enumerate(_WIDTHS):
        at = np.flatnonzero(code == k)
        raw, size = rows[at].astype(name).tobytes(), rows.shape[1] * (1 << k)
        for j, i in enumerate(at.tolist()):
            keys[i] = bytes([k]) + raw[j * size:(j + 1) * size]
    return keys


def unpack(keys: list[bytes], dim: int) -> np.ndarray:
    """The integers ``x`` of some keys, one row each."""
    out = np.empty((len(keys), dim), np.int64)
    codes = np.array([key[0] for key in keys], np.int64)
    for k, name in enumerate(_WIDTHS):
        at = np.flatnonzero(codes == k)
        if len(at):
            out[at] = np.frombuffer(b"".join(keys[i][1:] for i in at.tolist()), name).reshape(len(at), dim)
    return out + SHIFT


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``id, vector`` to GROUP_SCHEMA: a slice's equal vectors in one row."""
    for batch in batches:
        for start in range(0, len(batch), SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            ids, vectors = part["id"], part["vector"]
            sizes = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
            flat = pc.cast(pc.list_flatten(vectors), pa.float64())
            good = np.isfinite(pc.fill_null(flat, np.nan).to_numpy(zero_copy_only=False))
            edges = np.concatenate(([0], np.cumsum(sizes)))
            whole = (np.concatenate(([0], np.cumsum(good)))[edges[1:]]
                     - np.concatenate(([0], np.cumsum(good)))[edges[:-1]]) == sizes
            numbers = flat.to_numpy(zero_copy_only=False)
            found: dict[bytes, list[int | None]] = {}
            dims: dict[bytes, int] = {}
            id_list = ids.to_pylist()
            for dim in np.unique(sizes[whole & (sizes > 0)]).tolist():
                at = np.flatnonzero(whole & (sizes == dim))
                rows = quantize(numbers[edges[at][:, None] + np.arange(dim)])
                for i, key in zip(at.tolist(), pack(rows), strict=True):
                    found.setdefault(key, []).append(id_list[i])
                    dims[key] = dim
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(list(found), pa.binary()),
                "dim": pa.array([dims[key] for key in found], pa.int32()),
                "ids": pa.array(list(found.values()), pa.list_(pa.int64())),
                "n": pa.array([len(held) for held in found.values()], pa.int64())})


def _slices(batches: Iterator[pa.RecordBatch], dim: int, weighted: bool):
    """Vectors and weights of a task, some thousand rows at a time."""
    for batch in batches:
        for start in range(0, len(batch), SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            n = part["n"].to_numpy().astype(np.int64)
            yield part, unpack(part["key"].to_pylist(), dim), n if weighted else np.ones(len(part), np.int64)


def _sums(dim: int, weighted: bool) -> Callable:
    """To ``at, high, low``: a task's weighted sum of each dimension, and of the weights at -1. The
    upper and lower 32 bits add up apart, so entries near 2^62 do not overflow."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(dim + 1, np.int64), np.zeros(dim + 1, np.int64)
        for _, x, w in _slices(batches, dim, weighted):
            high[:dim] += w @ (x >> 32)
            low[:dim] += w @ (x & 0xFFFFFFFF)
            low[dim] += w.sum()
        yield pa.RecordBatch.from_pydict({
            "at": pa.array([*range(dim), -1], pa.int32()), "high": pa.array(high), "low": pa.array(low)})

    return add


def _products(center: np.ndarray, sums_of: Callable, dim: int) -> Callable:
    """To ``at, row``: rows of a task's sum of ``w y y'``, and at -1 the sum of ``w y``."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = np.zeros((dim, dim)), np.zeros(dim)
        for y, w in sums_of(batches):
            y = y - center
            total += (y * w[:, None]).T @ y
            first += w @ y
        yield pa.RecordBatch.from_pydict({
            "at": pa.array([*range(dim), -1], pa.int32()),
            "row": pa.array([*total, first], pa.list_(pa.float64()))})

    return multiply


def _covariance(table: DataFrame, sums_of: Callable, center: np.ndarray, n: int) -> np.ndarray:
    """Covariance (divisor n) of a table's vectors; ``center`` is near their mean, and the rest of
    the mean is taken off exactly."""
    dim = len(center)
    parts = table.mapInArrow(_products(center, sums_of, dim), "at int, row array<double>")
    rows = (parts.select("at", F.posexplode("row").alias("col", "v")).groupBy("at", "col")
            .agg(F.sum("v").alias("v")).collect())  # dimension squared numbers
    total, first = np.zeros((dim, dim)), np.zeros(dim)
    for r in rows:
        if r["at"] < 0:
            first[r["col"]] = r["v"]
        else:
            total[r["at"], r["col"]] = r["v"]
    return total / n - np.outer(first, first) / n / n


def exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum((n x - S)^2)`` of each row; in 64-bit integers where they hold it, else in Python's."""
    far = max(n * int(x.max()) - min(sums), max(sums) - n * int(x.min())) if len(x) else 0
    if far * far * x.shape[1] < 2**63 and n * int(np.abs(x).max(initial=0)) < 2**63:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in exact]


def _whiten(center: np.ndarray, project: np.ndarray, n: int, sums: list[int], dim: int) -> Callable:
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x, _ in _slices(batches, dim, False):
            z = (x - center) @ project
            yield pa.RecordBatch.from_pydict({
                "key": part["key"], "n": part["n"], "deviation": pa.array(exact_deviation(x, n, sums), pa.int64()),
                "z": pa.array(list(z), pa.list_(pa.float64()))})

    return apply


def _read_z(k: int, weighted: bool) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            n = batch["n"].to_numpy().astype(np.float64)
            yield (pc.list_flatten(batch["z"]).to_numpy(zero_copy_only=False).reshape(len(batch), k),
                   n if weighted else np.ones(len(batch)))

    return read


def _read_x(dim: int, weighted: bool) -> Callable:
    def read(batches: Iterator[pa.RecordBatch]):
        for _, x, w in _slices(batches, dim, weighted):
            yield x.astype(np.float64), w.astype(np.float64)

    return read


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", weights: str = "one",
           components: int = COMPONENTS) -> DataFrame:
    """``vec_id, n, deviation, whitened array<double>, explained array<double>, identity_error``,
    one row per kept row of ``vectors``. ``weights``: ``one`` or ``count``."""
    if weights not in ("one", "count"):
        raise ValueError("weights must be 'one' or 'count'")
    spark = vectors.sparkSession
    share_package(spark)
    weighted = weights == "count"
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    groups = materialize(rows.mapInArrow(_groups, GROUP_SCHEMA), "vector-groups")
    none = spark.createDataFrame([], "vec_id bigint, n bigint, deviation bigint, whitened array<double>, "
                                     "explained array<double>, identity_error double")
    lengths = groups.groupBy("dim").agg(F.sum("n").alias("rows")).orderBy(F.desc("rows"), "dim").first()
    if lengths is None:
        return none
    dim = lengths["dim"]
    groups = groups.filter(F.col("dim") == dim)
    distinct = materialize(groups.groupBy("key").agg(F.sum("n").alias("n")), "distinct-vectors")
    totals = {r["at"]: (int(r["high"]) << 32) + int(r["low"]) for r in
              distinct.mapInArrow(_sums(dim, weighted), "at int, high bigint, low bigint").groupBy("at")
              .agg(*(F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low"))).collect()}  # dim + 1 rows
    n, sums = totals[-1], [totals[d] for d in range(dim)]
    whole = np.array([s // n for s in sums], np.float64)
    center = whole + np.array([s % n for s in sums], np.float64) / n
    covariance = _covariance(distinct, _read_x(dim, weighted), center, n)
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(components, int((values > max(values[0], 0.0) * dim * 2.0**-52).sum()))
    if kept == 0:
        return none
    project = axes[:, :kept] / np.sqrt(values[:kept])
    white = materialize(distinct.mapInArrow(_whiten(center, project, n, sums, dim),
                                            "key binary, n bigint, deviation bigint, z array<double>"), "whitened")
    spread = _covariance(white, _read_z(kept, weighted), np.zeros(kept), n)
    error = float(np.abs(spread - np.eye(kept)).max())
    explained = [float(v) for v in values[:kept] / np.trace(covariance)]
    held = groups.select("key", "ids").join(white.select("key", "deviation", "z"), "key")
    return held.select(F.explode("ids").alias("vec_id"), F.lit(n).cast("bigint").alias("n"), "deviation",
                       F.col("z").alias("whitened"), F.array(*map(F.lit, explained)).alias("explained"),
                       F.lit(error).alias("identity_error"))


def component_rows(whitened: DataFrame) -> DataFrame:
    """One row per vector and component (numbered from 1)."""
    return whitened.select(
        "vec_id", F.posexplode("whitened").alias("_at", "whitened"), "n", "deviation", "explained", "identity_error"
    ).select("vec_id", (F.col("_at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
             F.element_at("explained", F.col("_at") + 1).alias("explained"), "identity_error")
