"""Least squares from sums of products.

A linear fit needs only X'X, X'y and y'y. Each task reduces its rows to one such matrix
per series, the matrices are added by an ordinary aggregation, and the solve works on
one small array per series. The rows never leave the executors that read them, and a
series that holds most of the rows is spread over many tasks.

The matrix of ``z = [1, features..., label]`` is kept as its upper triangle, row by row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import arrays


def row_vector(features: Sequence[Column], label: Column) -> Column:
    """``[1, features..., label]``, or null when anything in it is null."""
    parts = [c.cast("double") for c in (*features, label)]
    anything_null = F.lit(False)
    for c in parts:
        anything_null = anything_null | c.isNull()
    return F.when(~anything_null, F.array(F.lit(1.0), *parts))


def _arrow_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType(
        [df.schema[k] for k in keys] + [T.StructField("gram", T.ArrayType(T.DoubleType()), False)]
    )


def triangle(matrix: np.ndarray) -> np.ndarray:
    return matrix[np.triu_indices(matrix.shape[0])]


def square(packed) -> np.ndarray:
    """The symmetric matrix of an upper triangle."""
    packed = np.asarray(packed, dtype=float)
    size = int((np.sqrt(8 * len(packed) + 1) - 1) / 2)
    full = np.zeros((size, size))
    full[np.triu_indices(size)] = packed
    return full + np.triu(full, 1).T


HELD_BYTES = 64 << 20  # of running matrices in a task, before they are handed on


def _partials(keys: Sequence[str], width: int):
    """Running matrices by key, in whatever order rows come; handed on when they are many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        schema = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            schema = batch.schema
            rows = batch.column("z").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            codes = np.zeros(batch.num_rows, np.int64)
            for k in keys:
                own, values = pd.factorize(batch.column(k).to_pandas(), use_na_sentinel=False)
                codes = pd.factorize(codes * len(values) + own)[0]
            order = np.argsort(codes, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(codes[order]) != 0))
            for a, b in zip(first, [*first[1:], batch.num_rows], strict=True):
                part = rows[order[a:b]]
                key = tuple(batch.column(k)[int(order[a])].as_py() for k in keys)
                held[key] = held.get(key, 0.0) + part.T @ part
            if len(held) * width * width * 8 > HELD_BYTES:
                yield out(held, schema)
                held = {}
        if held:
            yield out(held, schema)

    def out(held: dict[tuple, np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
        columns = [pa.array([key[i] for key in held], schema.field(k).type) for i, k in enumerate(keys)]
        columns.append(pa.array([triangle(m).tolist() for m in held.values()], pa.list_(pa.float64())))
        return pa.RecordBatch.from_arrays(columns, names=[*keys, "gram"])

    return run


def gram(df: DataFrame, keys: Sequence[str], z: Column, width: int) -> DataFrame:
    """One ``(keys, gram)`` row per key over the rows whose vector is not null.

    Rows stay in the tasks that read them; only matrices are shuffled.
    """
    vectors = df.select(*keys, z.alias("z")).filter(F.col("z").isNotNull())
    partials = vectors.mapInArrow(_partials(list(keys), width), _arrow_schema(df, keys))
    return arrays.add_up(partials, keys, "gram")


def prefix_grams(grams: DataFrame, series_cols: Sequence[str], block_col: str) -> DataFrame:
    """From one matrix per block: the sum over all earlier blocks of the series.

    Each cell is summed on its own, so the window is spread over series times cells.
    """
    keys = [*series_cols, block_col]
    cells = arrays.cells_of(grams, keys, "gram")
    earlier = (
        Window.partitionBy(*series_cols, "cell").orderBy(block_col).rowsBetween(Window.unboundedPreceding, -1)
    )
    before = cells.withColumn("value", F.coalesce(F.sum("value").over(earlier), F.lit(0.0)))
    return arrays.from_cells(before, keys, "gram")


def solve(xx: np.ndarray, xy: np.ndarray, penalty: np.ndarray | float = 0.0) -> np.ndarray:
    """Coefficients of penalised least squares; the shortest solution if not unique."""
    system = xx + np.diag(np.broadcast_to(penalty, len(xy)))
    try:
        return np.linalg.solve(system, xy)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(system, xy, rcond=None)[0]


class Growing:
    """Penalised least squares over a growing set of rows: each row learned, and each set of
    coefficients, costs O(p^2).

    The inverse of the penalised matrix follows each row by a rank-one update and is built anew
    every ``REFRESH`` rows. Coefficients are refined against the exact matrix until their
    residual is as small as a full solve leaves it; if that fails, the inverse is built anew, and
    a system without an inverse is solved in full.
    """

    REFRESH = 512
    CLOSE = 1e-12

    def __init__(self, total: np.ndarray, penalty: np.ndarray, columns: Sequence[int]):
        self.total, self.penalty = np.array(total, dtype=float), penalty
        self.choose(columns)

    def choose(self, columns: Sequence[int]) -> None:
        """Fit these columns only; the coefficients of the others are zero."""
        self.columns = np.asarray(columns)
        self.system = self.total[np.ix_(self.columns, self.columns)] + np.diag(self.penalty[self.columns])
        self.label = self.total[self.columns, -1]
        self._invert()

    def _invert(self) -> None:
        self.age = 0
        try:
            self.inverse = np.linalg.inv(self.system)
        except np.linalg.LinAlgError:
            self.inverse = None

    def learn(self, row: np.ndarray) -> None:
        """Add ``[1, features..., label]``."""
        self.total += np.outer(row, row)
        x = row[self.columns]
        self.system += np.outer(x, x)
        self.label = self.label + x * row[-1]
        self.age += 1
        if self.inverse is None or self.age >= self.REFRESH:
            self._invert()
        else:
            gain = self.inverse @ x
            self.inverse -= np.outer(gain, gain / (1.0 + x @ gain))

    def beta(self) -> np.ndarray:
        found = np.zeros(len(self.total) - 1)
        found[self.columns] = self._coefficients()
        return found

    def _coefficients(self) -> np.ndarray:
        aim = self.CLOSE * max(np.abs(self.label).max(), np.finfo(float).tiny)
        for _ in range(2):
            if self.inverse is None:
                break
            b = self.inverse @ self.label
            for _ in range(4):
                short = self.label - self.system @ b
                if np.abs(short).max() <= aim:
                    return b
                b = b + self.inverse @ short
            if np.abs(self.label - self.system @ b).max() <= aim:
                return b
            self._invert()
        return solve(self.system, self.label)


def loss_sum(full: np.ndarray, beta: np.ndarray) -> float:
    """Sum of squared residuals of ``beta`` on the rows behind the matrix."""
    xx, xy, yy = full[:-1, :-1], full[:-1, -1], full[-1, -1]
    return float(max(yy - 2 * beta @ xy + beta @ xx @ beta, 0.0))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def ridge(grams: pd.Series, penalties: pd.Series) -> pd.Series:
    """Coefficients (intercept first) per matrix and array of penalties."""

    def one(packed, penalty):
        full = square(packed)
        return solve(full[:-1, :-1], full[:-1, -1], np.asarray(penalty, dtype=float))

    return pd.Series([one(g, p) for g, p in zip(grams, penalties, strict=True)])


@F.pandas_udf(T.DoubleType())
def mean_loss(grams: pd.Series, betas: pd.Series) -> pd.Series:
    """Mean squared residual of each coefficient array on its matrix (count in cell 0)."""

    def one(packed, beta) -> float | None:
        if packed is None or packed[0] == 0 or beta is None:
            return None
        return loss_sum(square(packed), np.asarray(beta, dtype=float)) / packed[0]

    return pd.Series([one(g, b) for g, b in zip(grams, betas, strict=True)], dtype="float64")


def elastic_net(l1: float, l2: float, sweeps: int = 100_000, tolerance: float = 1e-12):
    """Coordinate descent on the matrix: minimises mean loss / 2 + l1 |b| + l2 |b|^2 / 2.

    The intercept is not penalised. Runs until no coefficient moves by more than ``tolerance``
    of the largest; a series that does not get there in ``sweeps`` sweeps has no coefficients
    (null), and the others are not affected.
    """

    def one(packed) -> np.ndarray | None:
        full = square(packed)
        n = full[0, 0]
        xx, xy = full[:-1, :-1] / n, full[:-1, -1] / n
        beta = np.zeros(len(xy))
        for _ in range(sweeps):
            before = beta.copy()
            for j in range(len(beta)):
                if xx[j, j] == 0:
                    continue
                pull = xy[j] - xx[j] @ beta + xx[j, j] * beta[j]
                if j == 0:
                    beta[j] = pull / xx[j, j]
                else:
                    beta[j] = np.sign(pull) * max(abs(pull) - l1, 0.0) / (xx[j, j] + l2)
            if np.max(np.abs(beta - before)) <= tolerance * max(1.0, np.max(np.abs(beta))):
                return beta
        return None

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(grams: pd.Series) -> pd.Series:
        return pd.Series([one(g) for g in grams])

    return run


def sparse_solve(
    xx: np.ndarray, xy: np.ndarray, l2: np.ndarray, l1: np.ndarray, sweeps: int = 20_000, close: float = 1e-9
) -> np.ndarray | None:
    """Minimises b'(xx)b / 2 - b'xy + sum(l2 b^2) / 2 + sum(l1 |b|); None if it does not settle.

    Coefficients without a penalty on their absolute value are eliminated, coordinate descent
    runs over the others. After each sweep the coefficients that are not zero are solved for
    exactly, their signs given; if those signs come out, and no zero wants to leave, that is the
    minimum, so the result has no error of an iteration.
    """
    system = xx + np.diag(l2)
    if not (np.isfinite(system).all() and np.isfinite(xy).all()):
        return None
    sparse, free = np.flatnonzero(l1 > 0), np.flatnonzero(l1 == 0)
    across = solve(system[np.ix_(free, free)], np.column_stack((system[np.ix_(free, sparse)], xy[free])))
    inner = system[np.ix_(sparse, sparse)] - system[np.ix_(sparse, free)] @ across[:, :-1]
    pull, held = xy[sparse] - system[np.ix_(sparse, free)] @ across[:, -1], l1[sparse]
    # A column that the others explain, or that is zero, has nothing left of its own.
    own = np.diag(inner) > 1e-12 * np.diag(system)[sparse]
    found, rest = np.zeros(len(sparse)), pull.copy()
    for _ in range(sweeps):
        for j in np.flatnonzero(own):
            aim = rest[j] + inner[j, j] * found[j]
            to = np.sign(aim) * max(abs(aim) - held[j], 0.0) / inner[j, j]
            if to != found[j]:
                rest -= inner[:, j] * (to - found[j])
                found[j] = to
        some = np.flatnonzero(found)
        exact = np.zeros(len(sparse))
        exact[some] = solve(inner[np.ix_(some, some)], pull[some] - held[some] * np.sign(found[some]))
        left = np.abs(pull - inner @ exact)
        if (np.sign(exact) == np.sign(found)).all() and (left <= held * (1 + close) + close * np.abs(pull).max(initial=0.0))[own].all():
            beta = np.zeros(len(xy))
            beta[sparse], beta[free] = exact, across[:, -1] - across[:, :-1] @ exact
            return beta
    return None


@F.pandas_udf(T.StructType([T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("settled", T.BooleanType())]))
def sparse(grams: pd.Series, l2: pd.Series, l1: pd.Series) -> pd.DataFrame:
    """Coefficients under both penalties, null where they did not settle, and whether they did."""
    out = []
    for packed, square_penalty, absolute in zip(grams, l2, l1, strict=True):
        full = square(packed)
        beta = sparse_solve(full[:-1, :-1], full[:-1, -1], np.asarray(square_penalty, float), np.asarray(absolute, float))
        out.append((beta, beta is not None))
    return pd.DataFrame(out, columns=["beta", "settled"])


def descent(epochs: int, rate: float):
    """Coefficients after each full-batch gradient step from zero.

    The step is ``rate`` over the trace of the mean matrix, which bounds its largest
    eigenvalue, so any rate up to 1 converges.
    """

    def one(packed) -> list[list[float]]:
        full = square(packed)
        n = full[0, 0]
        xx, xy = full[:-1, :-1] / n, full[:-1, -1] / n
        step = rate / np.trace(xx)
        beta, path = np.zeros(len(xy)), []
        for _ in range(epochs):
            beta = beta - step * (xx @ beta - xy)
            path.append(beta.tolist())
        return path

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def run(grams: pd.Series) -> pd.Series:
        return pd.Series([one(g) for g in grams])

    return run


def round_order(seed: int, epoch: int, batches: Sequence[int]) -> list[int]:
    """Batches in the order an epoch takes them: by a hash, so that every run and engine agrees."""
    return sorted(batches, key=lambda b: hashlib.md5(f"{seed}|{epoch}|{b}".encode()).hexdigest())


def rounds(epochs: int, rate: float, seed: int):
    """Coefficients after each epoch of gradient steps on batches, from zero, by their matrices.

    The gradient of a batch is a function of its matrix, so steps need no rows. The step
    is ``rate`` over the largest trace of a batch's mean matrix, so a rate up to 1 is stable on each.
    """

    def one(batches, grams) -> list[list[float]]:
        means = {}
        for b, packed in zip(batches, grams, strict=True):
            full = square(packed)
            means[int(b)] = full / full[0, 0]
        step = rate / max(np.trace(m[:-1, :-1]) for m in means.values())
        beta, path = np.zeros(len(next(iter(means.values()))) - 1), []
        for epoch in range(epochs):
            for b in round_order(seed, epoch, sorted(means)):
                beta = beta - step * (means[b][:-1, :-1] @ beta - means[b][:-1, -1])
            path.append(beta.tolist())
        return path

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def run(batches: pd.Series, grams: pd.Series) -> pd.Series:
        return pd.Series([one(b, g) for b, g in zip(batches, grams, strict=True)])

    return run


def dot(beta: Column, features: Sequence[Column]) -> Column:
    """``beta[0] + beta[1] * features[0] + ...`` as one JVM expression."""
    total = beta[0]
    for i, feature in enumerate(features, 1):
        total = total + beta[i] * feature
    return total
