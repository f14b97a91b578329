"""Embedding whitening with components from the exact characteristic polynomial.

An entry ``c`` of a vector becomes the integer ``x = floor(256 c)``.  The fit list holds every
distinct integer vector once; its sums and products are added up as whole numbers by one
distributed aggregation, which gives the scatter ``n * sum(x x') - S S' = n^2 V`` exactly.  The
residues of its characteristic polynomial are computed by tasks that each take some primes, then
put together by Chinese remainders; roots and null spaces follow in :mod:`charpoly`.  Only
numbers whose count depends on the dimension alone come to the driver.

Defined results: rows whose vector is null or holds a null or a non-finite entry are dropped.
Entries beyond a 64-bit integer become its largest or smallest value.  Vectors of different
lengths are spaces of their own, each with its own fit list; empty ones have no component.
Components are those with an eigenvalue above 0, at most ``components``: a space with a single
distinct vector has none, and its rows give no output.  Equal eigenvalues get some orthonormal
basis of their space.  Repeated rows each give their output, null ids are kept, an empty table
gives an empty result, and input columns of any name are kept in the struct ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.llm import charpoly
from demandflow.llm.common import Scratch

_LIMB_BITS, _LIMBS = 40, 5
_SUMS = T.StructType([T.StructField("dim", T.LongType()), T.StructField("i", T.LongType()), T.StructField("j", T.LongType()),
                      *[T.StructField(f"l{k}", T.LongType()) for k in range(_LIMBS)]])


def _exact(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c * 256).cast("long"))


def integer_vectors(df: DataFrame, vector: str) -> DataFrame:
    """``row`` (a struct of the input columns) and ``x``, the integer vector, of usable rows."""
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    rows = rows.select("row", F.col("row").getField(vector).cast("array<double>").alias("v"))
    usable = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return rows.where(F.col("v").isNotNull() & usable).select("row", _exact(F.col("v")).alias("x"))


def _by_dimension(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, places in the batch, vectors) for each dimension above 0 in the batch."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat, size = column.values.to_numpy(zero_copy_only=False), np.diff(offsets)
    for dim in np.unique(size[size > 0]).tolist():
        at = np.flatnonzero(size == dim)
        yield dim, at, flat[offsets[at][:, None] + np.arange(dim)]


def _products(x: np.ndarray) -> np.ndarray:
    """``x' x`` exactly, as Python integers."""
    top = max(abs(int(x.max())), abs(int(x.min())), 1)
    rows = 2**53 // (top * top)
    if not rows:
        big = x.astype(object)
        return big.T.dot(big)
    out = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for i in range(0, len(x), rows):
        part = x[i:i + rows].astype(np.float64)
        out = out + (part.T @ part).astype(np.int64).astype(object)
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and dimension: count (at -1, -1), sums (at -1, j) and products (at i <= j), in limbs."""
    total: dict[int, list] = {}
    for batch in batches:
        for dim, _, x in _by_dimension(batch.column("x")):
            t = total.setdefault(dim, [0, 0, 0])
            t[0] += len(x)
            t[1] = t[1] + x.astype(object).sum(0)
            t[2] = t[2] + _products(x)
    for dim, (n, sums, products) in total.items():
        cells = [(-1, -1, n), *[(-1, j, int(v)) for j, v in enumerate(sums)],
                 *[(i, j, int(products[i, j])) for i in range(dim) for j in range(i, dim)]]
        mask = (1 << _LIMB_BITS) - 1
        limbs = [[(v >> (_LIMB_BITS * k)) & mask for _, _, v in cells] for k in range(_LIMBS - 1)]
        limbs.append([v >> (_LIMB_BITS * (_LIMBS - 1)) for _, _, v in cells])
        columns = [[dim] * len(cells), [c[0] for c in cells], [c[1] for c in cells], *limbs]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[f.name for f in _SUMS])


@dataclass
class Space:
    """The fit of one dimension: ``n`` vectors with per-dimension sums ``s``, the largest absolute
    entry, and the components as (eigenvector, eigenvalue of V, share of the trace)."""
    n: int
    s: list[int]
    parts: list[tuple[list[float], float, float]]
    identity_error: float = 0.0


def scatters(fit: DataFrame) -> dict[int, tuple[int, list[int], np.ndarray]]:
    """dimension -> (n, S, n^2 V) of the distinct vectors ``x``, exact."""
    sums = fit.mapInArrow(_sums, _SUMS).groupBy("dim", "i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS)])
    cells: dict[int, dict] = {}
    for r in sums.toLocalIterator():
        cells.setdefault(r["dim"], {})[r["i"], r["j"]] = sum(r[f"l{k}"] << (_LIMB_BITS * k) for k in range(_LIMBS))
    out = {}
    for dim, c in sorted(cells.items()):
        n, s = c[-1, -1], [c[-1, j] for j in range(dim)]
        m = np.empty((dim, dim), dtype=object)
        for i in range(dim):
            for j in range(i, dim):
                m[i, j] = m[j, i] = n * c[i, j] - s[i] * s[j]
        out[dim] = (n, s, m)
    return out


def characteristic(spark: SparkSession, m: np.ndarray, primes: list[int]) -> list[int]:
    """Coefficients of the characteristic polynomial, highest power first.  Each task works on
    some of the primes, few enough at a time for its memory."""
    dim = len(m)
    at_once = max(1, 4_000_000 // (dim * dim))

    def residues(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            own = frame["p"].tolist()
            for i in range(0, len(own), at_once):
                some = own[i:i + at_once]
                yield pd.DataFrame({"p": some, "c": charpoly.charpoly_mod(m, some).tolist()})

    tasks = min(len(primes), max(1, spark.sparkContext.defaultParallelism))
    dealt = spark.range(0, len(primes), 1, tasks).select(F.element_at(F.lit(primes), (F.col("id") + 1).cast("int")).alias("p"))
    found = {r["p"]: r["c"] for r in dealt.mapInPandas(residues, "p long, c array<long>").collect()}
    return charpoly.chinese(np.array([found[p] for p in primes]), primes, dim)


def components_of(spark: SparkSession, n: int, m: np.ndarray, count: int) -> list[tuple[list[float], float, float]]:
    """The ``count`` leading (eigenvector, eigenvalue of V, share of the trace) of ``m = n^2 V``."""
    trace = sum(int(m[i, i]) for i in range(len(m)))
    if trace == 0:
        return []
    primes = charpoly.primes_for(len(m), trace)
    p = characteristic(spark, m, primes)
    while p[-1] == 0:
        p = p[:-1]
    once = charpoly.square_free(p, primes)
    roots = charpoly.largest_roots(once, trace, count + 1)
    gaps = charpoly.refine(once, roots)
    wanted, left = [], count
    for root, gap in zip(roots, gaps, strict=True):
        if left <= 0:
            break
        times = 1
        if len(once) != len(p):
            times = charpoly.roots_above(p, root.lo, root.s) - charpoly.roots_above(p, root.hi, root.s)
        wanted.append((len(wanted), (root.low() + root.high()) / 2, gap, min(times, left)))
        left -= times

    def vectors(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in frame["id"].tolist():
                _, mu, gap, times = wanted[k]
                found = charpoly.null_space(m, mu, gap, times)
                yield pd.DataFrame({"id": [k] * times, "nth": range(times), "v": found})

    found = spark.range(0, len(wanted), 1, len(wanted)).mapInPandas(vectors, "id long, nth long, v array<double>").collect()
    out = []
    for r in sorted(found, key=lambda r: (r["id"], r["nth"])):
        mu = wanted[r["id"]][1]
        out.append((r["v"], float(mu / Fraction(n) ** 2), float(mu / trace)))
    return out


def _projected(space: Space, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Whitened coordinates (rows x components), and the exact squared deviation of each row from
    the mean times n: ``sum (n x - S)^2``."""
    top = max(abs(int(x.max())), abs(int(x.min())))
    reach = space.n * top + max(map(abs, space.s))
    if reach < 2**62:
        y = x * np.int64(space.n) - np.array(space.s, np.int64)
        centred = y / space.n
        exact = y if reach * reach * x.shape[1] < 2**63 else y.astype(object)
    else:
        exact = x.astype(object) * space.n - np.array(space.s, dtype=object)
        centred = (exact / space.n).astype(np.float64)
    basis = np.array([v for v, _, _ in space.parts]).T / np.sqrt([e for _, e, _ in space.parts])
    return centred @ basis, (exact * exact).sum(1).tolist()


def _identity_errors(fit: DataFrame, spaces: dict[int, Space], count: int) -> dict[int, float]:
    """Largest absolute entry of (covariance of the whitened fit list - identity), measured on it."""
    names = [f"w{k}" for k in range(count)]

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, _, x in _by_dimension(batch.column("x")):
                if spaces[dim].parts:
                    w, _ = _projected(spaces[dim], x)
                    columns = [pa.array(w[:, k]) if k < w.shape[1] else pa.nulls(len(w), pa.float64()) for k in range(count)]
                    yield pa.RecordBatch.from_arrays([pa.array([dim] * len(w), pa.int64()), *columns], names=["dim", *names])

    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    # covar_pop updates with differences from the running means
    cov = fit.mapInArrow(whitened, "dim long, " + ", ".join(f"{c} double" for c in names)).groupBy("dim").agg(
        *[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs])
    return {r["dim"]: max(abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None) for r in cov.collect()}


def fit_spaces(fit: DataFrame, components: int) -> dict[int, Space]:
    spark = fit.sparkSession
    spaces = {dim: Space(n, s, components_of(spark, n, m, components)) for dim, (n, s, m) in scatters(fit).items()}
    for dim, error in _identity_errors(fit, spaces, components).items():
        spaces[dim].identity_error = error
    return spaces


def whiten(df: DataFrame, scratch: Scratch, vector: str = "embedding", components: int = 4) -> DataFrame:
    """One row per usable input row and component (numbered from 1 by falling eigenvalue): ``row,
    component, n, deviation, deviation_digits, whitened, explained, identity_error``.
    ``deviation`` is null where it exceeds 64 bits; ``deviation_digits`` is always exact."""
    rows = integer_vectors(df, vector)
    # one row per distinct vector; equal ones collapse before the shuffle
    fit = scratch.write(rows.select("x").distinct(), "fit")
    spaces = fit_spaces(fit, components)
    out = T.StructType([
        T.StructField("row", rows.schema["row"].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("deviation_digits", T.StringType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _by_dimension(batch.column("x")):
                space = spaces[dim]
                k = len(space.parts)
                if not k:
                    continue
                w, deviation = _projected(space, x)
                fits = [v if v < 2**63 else None for v in deviation]
                every = np.repeat(np.arange(len(at)), k)
                yield pa.RecordBatch.from_arrays([
                    batch.column("row").take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(every), space.n, np.int64)),
                    pa.array(fits, pa.int64()).take(pa.array(every)),
                    pa.array([str(v) for v in deviation]).take(pa.array(every)),
                    pa.array(w.ravel()),
                    pa.array(np.tile([e for _, _, e in space.parts], len(at))),
                    pa.array(np.full(len(every), space.identity_error))], names=out.names)

    return rows.mapInArrow(apply, out)
