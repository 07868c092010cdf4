"""Whitening of embeddings onto their leading principal components.

Entries become whole codes, so sums are exact. The fit list is the table of distinct code vectors. Two
passes over it, each reduced in the tasks, give the mean and the covariance, centred before anything is
multiplied; its leading eigenpairs come from spectrum slicing (``spectrum``). A third pass measures the
covariance of what whitening makes of the fit list. Only sums and dimension x dimension matrices reach
the driver; the rows are whitened in one pass without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazardflow.llm import spectrum
from hazardflow.llm.store import map_arrow, stored

#: Codes beyond this do not fit a long once an offset is added.
LARGEST = float(1 << 62)


def coded(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: float = 64, offset: int = 1_000_000) -> DataFrame:
    """(vec_id, x) of the rows with a whole vector, x = floor(scale * entry) + offset.

    Left out are null and empty vectors, those with a null or non-finite entry or one whose code does not
    fit a long, and those that have not the table's usual length (the most frequent, of equal ones the greatest).
    """
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    whole = rows.filter(F.expr("size(x) > 0")).filter(F.forall("x", lambda c: F.coalesce(F.abs(c) < LARGEST / scale, F.lit(False))))
    lengths = whole.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    length = lengths["length"] if lengths else 0
    code = F.transform("x", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(offset))
    return whole.filter(F.size("x") == length).select("vec_id", code.alias("x"))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    found = batch.column(column)
    return found.flatten().to_numpy(zero_copy_only=False).reshape(len(found), -1)


@dataclass
class Model:
    """What whitening needs: ``n`` fitted vectors, their sums, and the leading eigenpairs.

    ``rank`` components have an eigenvalue above zero (to double precision); the others cannot be
    scaled to variance one. ``identity_error`` is the largest absolute entry of the covariance of
    the whitened fit list minus the identity, over the components of the rank; None without any.
    """

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    rank: int
    identity_error: float | None = None

    def __post_init__(self):
        self.centre = np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        self.rest = [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]
        self.shift = np.array([r / self.n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n; the whole part is taken off before the rounding to doubles."""
        return (x - self.centre).astype(float) - self.shift

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors[:, : self.rank] / np.sqrt(self.values[: self.rank])

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sum over the entries of (n * x - sum)^2, exact; null beyond 38 digits."""
        kind, off = pa.decimal128(38, 0), x - self.centre
        reach = self.n * int(np.abs(off).max(initial=0)) + max(map(abs, self.rest))
        if reach * reach * len(self.rest) < 1 << 63:
            return pa.array(((self.n * off - np.array(self.rest)) ** 2).sum(axis=1)).cast(kind)
        exact = [sum((self.n * int(c) - r) ** 2 for c, r in zip(row, self.rest)) for row in off]
        return pa.array([Decimal(e) if e < 10**38 else None for e in exact], kind)


def _cells(rows: DataFrame, of, size: int) -> np.ndarray:
    """Sum over all rows of the outer products of ``of(x)``, whose length is ``size``: one matrix for each task."""
    schema = pa.schema([("cell", pa.int64()), ("value", pa.float64())])
    upper = np.flatnonzero(np.triu(np.ones((size, size), bool)))

    def run(batches):
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                z = of(_matrix(batch))
                total += z.T @ z
        yield [upper, total.ravel()[upper]]

    found = map_arrow(rows, run, schema).groupBy("cell").agg(F.sum("value").alias("value")).collect()
    matrix = np.zeros(size * size)
    for row in found:
        matrix[row["cell"]] = row["value"]
    matrix = matrix.reshape(size, size)
    return np.triu(matrix) + np.triu(matrix, 1).T


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and exact sums of each entry. Halves of 32 bits cannot overflow in a task."""
    schema = pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("high", pa.int64()), ("low", pa.int64())])

    def run(batches):
        n, high, low = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch)
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            yield [np.arange(len(high)), np.full(len(high), n), high, low]

    whole = "decimal(38,0)"
    total = map_arrow(rows, run, schema).groupBy("dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("high").cast(whole)).alias("high"), F.sum(F.col("low").cast(whole)).alias("low"))
    found = sorted(total.collect())
    return (found[0]["n"] if found else 0), [int(r["high"]) * (1 << 32) + int(r["low"]) for r in found]


def fit(codes: DataFrame, components: int = 16) -> Model | None:
    """Model of the distinct vectors of ``codes`` (as ``coded`` gives them); None where there is none."""
    distinct = stored(codes.select("x").distinct(), "vectors")
    n, sums = _sums(distinct)
    if not n:
        return None
    size = len(sums)
    empty = Model(n, sums, 0.0, np.zeros(0), np.zeros((size, 0)), 0)
    covariance = _cells(distinct, empty.centred, size) / n
    values, vectors = spectrum.leading(covariance, components)
    trace = float(np.trace(covariance))
    rank = int((values > 64 * size * spectrum.EPS * max(trace, 0.0)).sum())
    model = Model(n, sums, trace, values, vectors, rank)
    if rank:
        # a leading one gives the means of the whitened entries along with their products
        ones = lambda x: np.column_stack([np.ones(len(x)), model.whitened(x)])
        moments = _cells(distinct, ones, rank + 1) / n
        spread = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
        model.identity_error = float(np.abs(spread - np.eye(rank)).max())
    return model


def whiten(codes: DataFrame, model: Model | None) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row and component.

    ``deviation`` is a decimal, the row's squared distance to the mean times n^2. Components run from 1
    to the number fitted or the dimension; beyond the model's rank ``whitened`` is null, and where all
    vectors are equal ``explained`` is null too. Repeated rows and ids give rows of their own. No rows
    without a model.
    """
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0)),
                        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])
    given = codes.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = given.value
        for batch in batches if model is not None else ():
            if not batch.num_rows:
                continue
            x, many = _matrix(batch), len(model.values)
            every = np.repeat(np.arange(len(x)), many)
            whitened = np.full((len(x), many), np.nan)
            whitened[:, : model.rank] = model.whitened(x)
            explained = np.tile(np.maximum(model.values, 0) / model.trace if model.trace > 0 else np.full(many, np.nan), len(x))
            yield [
                batch.column("vec_id").take(pa.array(every)), np.tile(np.arange(1, many + 1), len(x)), np.full(len(every), model.n),
                model.deviation(x).take(pa.array(every)), pa.array(whitened.ravel(), from_pandas=True),
                pa.array(explained, from_pandas=True), pa.array([model.identity_error] * len(every), pa.float64()),
            ]

    return map_arrow(codes, run, schema)
