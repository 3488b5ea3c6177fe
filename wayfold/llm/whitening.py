"""Whitening of vectors from an exact scatter matrix in residue numbers.

Entries become whole numbers. Each partition multiplies its rows, reduced modulo
several primes, with themselves: entries of centred residues below 2^19 and BLOCK rows
keep every sum below 2^53, so a product of doubles is exact. Sums of partitions are
added cell by cell in Spark, and Chinese remaindering gives the scatter matrix itself,
of any size: there are as many primes as its bound needs. A column of ones goes along,
so that the number of rows and the sums of each dimension come out of the same product.
n times the scatter less the products of sums is n^2 times the covariance, exactly; only
then it is rounded to doubles, once, for the eigenvectors.

What reaches the driver is one matrix for each length of vector, whatever the rows.

Edge cases: null vectors, vectors with null or non-finite entries, and those with an
entry too large for a long are left out; empty ones have no components; vectors of each
length are a list of their own, with its own n, sums and components; repeated rows and
null ids take part row by row; a component without variance (less than rounding leaves
of the largest) is told with null for whitened, and doesn't enter identity_error; a
deviation beyond a long is null; empty tables give empty results.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import mapped, materialize

#: Primes lie below this; rows of a block that are multiplied at once.
PRIME_BELOW, BLOCK = 1 << 20, 1 << 13
#: Entries of this size or more fit no long.
LARGEST = 2.0**62
COMPONENTS, SCALE, SHIFT = 8, 1024, 100_000


def primes(product: int) -> list[int]:
    """Primes below PRIME_BELOW, from the largest down, whose product is larger than this."""
    out, p, reached = [], PRIME_BELOW - 1, 1
    while reached <= product:
        if all(p % q for q in range(3, int(p**0.5) + 1, 2)):
            out.append(p)
            reached *= p
        p -= 2
    return out


def remaindered(residues: dict[int, int]) -> int:
    """The number nearest to 0 with these residues by prime."""
    whole, x = 1, 0
    for p, r in residues.items():
        x += whole * ((r - x) * pow(whole, -1, p) % p)
        whole *= p
    return x if 2 * x < whole else x - whole


def _fit(vectors: DataFrame, vector_col: str, scale: int, shift: int) -> tuple[DataFrame, Column]:
    """vectors that take part, and the size of their largest entry as a Column."""
    v = F.transform(vector_col, lambda c: c.cast("double"))
    bad = lambda c: F.coalesce(F.isnan(c) | (F.abs(c) * scale + abs(shift) >= LARGEST), F.lit(True))
    largest = F.array_max(F.transform(v, lambda c: F.abs(c) * scale)) + abs(shift) + 1
    return vectors.where(F.coalesce(F.size(vector_col) > 0, F.lit(False)) & ~F.exists(v, bad)), largest


def _by_length(column):
    """(positions, matrix of doubles) of the vectors of each length in an Arrow list column without nulls."""
    import numpy as np

    offsets = np.asarray(column.offsets)
    values, sizes = np.asarray(column.values, float), np.diff(offsets)
    for d in np.unique(sizes):
        at = np.flatnonzero(sizes == d)
        yield int(d), at, values[offsets[at][:, None] + np.arange(d)]


def _whole(c, scale: int, shift: int):
    import numpy as np

    return np.floor(c * scale).astype(np.int64) + shift


def scatter(vectors: DataFrame, vector_col: str, moduli: dict[int, list[int]], scale: int, shift: int) -> DataFrame:
    """(length, prime, cell, residue): sums of products of [1, x] with itself by cell of the upper triangle."""

    def work(batches):
        import numpy as np

        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, _, c in _by_length(batch.column(0)):
                for first in range(0, len(c), BLOCK):
                    x = _whole(c[first : first + BLOCK], scale, shift)
                    for p in moduli[d]:
                        r = np.ones((len(x), d + 1))
                        r[:, 1:] = (x + p // 2) % p - p // 2
                        sums[d, p] = (sums.get((d, p), 0) + (r.T @ r).astype(np.int64)) % p
        if sums:
            cells = [s[np.triu_indices(len(s))] for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in sums], pa.int32()), pa.array([k[1] for k in sums], pa.int64()), pa.array(cells, pa.list_(pa.int64()))], names=["length", "prime", "cells"])

    parts = mapped(vectors.select(vector_col), work, "length int, prime long, cells array<long>")
    each = parts.select("length", "prime", F.posexplode("cells").alias("cell", "r"))
    return each.groupBy("length", "prime", "cell").agg((F.sum("r") % F.col("prime")).alias("residue"))


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> dict[int, dict]:
    """By length of vector: n, sums, axes (columns), variances and their shares of all variance."""
    import numpy as np

    known, largest = _fit(vectors, vector_col, scale, shift)
    bounds = known.groupBy(F.size(vector_col).alias("d")).agg(F.count("*").alias("n"), F.max(largest).alias("most")).collect()
    moduli = {b.d: primes(2 * b.n * int(b.most) ** 2) for b in bounds}
    residues: dict[int, dict[int, dict[int, int]]] = {}
    if bounds:
        for row in scatter(known, vector_col, moduli, scale, shift).collect():
            residues.setdefault(row.length, {}).setdefault(row.cell, {})[row.prime] = row.residue
    models = {}
    for d, cells in residues.items():
        m = np.zeros((d + 1, d + 1), object)
        for cell, (i, j) in enumerate(zip(*np.triu_indices(d + 1))):
            m[i, j] = m[j, i] = remaindered(cells[cell])
        n, sums = m[0, 0], m[0, 1:].tolist()
        v = np.array([[(n * m[i + 1, j + 1] - sums[i] * sums[j]) / (n * n) for j in range(d)] for i in range(d)], float)
        e, axes = np.linalg.eigh(v)
        e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
        axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(0)[None], 0) < 0, -1.0, 1.0)
        trace = sum(n * m[i, i] - sums[i - 1] ** 2 for i in range(1, d + 1)) / (n * n)
        models[d] = {"n": n, "sums": sums, "axes": axes, "variances": np.where(e > 16 * d * np.finfo(float).eps * e[0], e, 0.0), "shares": e / trace if trace else [None] * len(e)}
    return models


def transform(vectors: DataFrame, models: dict[int, dict], id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, length, n, deviation, whitened array<double>) of the vectors that take part; components without variance are null."""
    known, _ = _fit(vectors, vector_col, scale, shift)
    inner = known.select(F.col(id_col).alias("_wf_id"), F.col(vector_col).alias("_wf_v"))

    def work(batches):
        import numpy as np

        for batch in batches:
            size = batch.num_rows
            length, n, deviation, white = np.zeros(size, np.int32), np.zeros(size, np.int64), [None] * size, [None] * size
            for d, at, c in _by_length(batch.column(1)):
                model, x = models[d], _whole(c, scale, shift)
                most = max(model["n"] * int(np.abs(x).max()), max(map(abs, model["sums"])))
                kind = np.int64 if most < 2**61 else object
                off = x.astype(kind) * model["n"] - np.array(model["sums"], kind)
                exact = off if int(np.abs(off).max()) ** 2 * d < 2**63 else off.astype(object)
                centred, scales = (off / model["n"]).astype(float), np.sqrt(model["variances"])
                w = centred @ model["axes"] / np.where(scales > 0, scales, 1.0)
                length[at], n[at] = d, model["n"]
                for i, far, row in zip(at.tolist(), (exact * exact).sum(1).tolist(), w.tolist()):
                    deviation[i] = far if far < 2**63 else None
                    white[i] = [y if s > 0 else None for y, s in zip(row, scales)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(length), pa.array(n), pa.array(deviation, pa.int64()), pa.array(white, pa.list_(pa.float64()))], names=["_wf_id", "length", "n", "deviation", "whitened"])

    kind = inner.schema["_wf_id"].dataType.simpleString()
    return mapped(inner, work, f"_wf_id {kind}, length int, n long, deviation long, whitened array<double>").withColumnRenamed("_wf_id", id_col)


def identity_errors(white: DataFrame, models: dict[int, dict]) -> dict[int, float | None]:
    """By length: the largest entry by size of the covariance of whitened components less the identity."""
    most = max((len(m["variances"]) for m in models.values()), default=0)
    pairs = [(i, j) for i in range(most) for j in range(i + 1)]
    item = lambda i: F.get("whitened", F.lit(i))
    off = [F.abs(F.covar_pop(item(i), item(j)) - (1.0 if i == j else 0.0)) for i, j in pairs]
    if not pairs:
        return {}
    worst = F.array_max(F.array(*off))
    return {r[0]: r[1] for r in white.groupBy("length").agg(worst.alias("e")).collect()}


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """A row for each vector that takes part and each of its components: component (from 1), n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    models = fit(vectors, vector_col, components, scale, shift)
    white = materialize(transform(vectors, models, id_col, vector_col, scale, shift), "whitened")
    errors = identity_errors(white, models)
    told = [(d, k + 1, None if s is None else float(s), errors.get(d)) for d, m in models.items() for k, s in enumerate(m["shares"])]
    shares = spark.createDataFrame(told, "length int, component int, explained double, identity_error double")
    each = white.select(id_col, "length", "n", "deviation", F.posexplode("whitened").alias("_wf_at", "whitened")).withColumn("component", F.col("_wf_at") + 1)
    joined = each.join(F.broadcast(shares), ["length", "component"])  # a few rows for each length
    return joined.select(id_col, "component", "n", "deviation", "whitened", "explained", "identity_error")
