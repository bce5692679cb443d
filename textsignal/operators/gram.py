"""Linear models and their searches from sufficient statistics: one scan, whatever the grid.

A scan adds up the products of all pairs of features and label, for each fold of the rows. What
remains is of the size of the features squared: training sums are the total less a fold, every
setting is solved on them by coordinate descent, and held-out errors follow from the fold's sums.

The objective is that of Spark's linear regression: half the mean squared error plus
`regParam` x (`elasticNetParam` x |b| + (1 - `elasticNetParam`) / 2 x b^2), with features and label
divided by their standard deviations in the training rows, and the intercept free. Fits are exact
up to `TOLERANCE`; Spark's own stop after `maxIter` steps.

Rows without features or label are left out. A feature that doesn't vary has the coefficient 0; so
have all if the label doesn't vary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textsignal import fixed_values as fixed
from textsignal.functions.vectors import as_array
from textsignal.operators.split import split_number

TOLERANCE = 1e-13
MOST_SWEEPS = 100_000
#: Decimals in which errors are compared.
SAME_ERROR = 9
#: Rows whose mean is taken off before products are added up, so that few digits are lost.
PIVOT_ROWS = 1_000


@dataclass
class Moments:
    """Sums of z z' over rows, for z = (1, features, label) less a pivot that is 0 at the 1."""

    pivot: np.ndarray
    sums: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.pivot, self.sums + other.sums)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.pivot, self.sums - other.sums)

    @property
    def n(self) -> int:
        return round(self.sums[0, 0])

    def means(self) -> np.ndarray:
        """Of features and label."""
        return self.pivot[1:] + self.sums[0, 1:] / max(1, self.n)

    def products(self, around: np.ndarray) -> np.ndarray:
        """Mean products of features and label less `around`."""
        shift = around - self.pivot[1:]
        first = self.sums[0, 1:] / max(1, self.n)
        inner = self.sums[1:, 1:] / max(1, self.n)
        return inner - np.outer(first, shift) - np.outer(shift, first) + np.outer(shift, shift)


@dataclass
class Linear:
    """A fitted linear model."""

    coefficients: np.ndarray
    intercept: float
    params: Mapping

    def squared_error(self, rows: Moments) -> float:
        """Mean squared error over rows of which only the moments are known."""
        weights = np.append(-self.coefficients, 1.0)
        around = rows.means()
        off = float(weights @ around) - self.intercept
        return max(0.0, float(weights @ rows.products(around) @ weights)) + off * off

    def predicted(self, features: Column) -> Column:
        weights = F.array(*(F.lit(float(c)) for c in self.coefficients))
        each = F.zip_with(as_array(features, "float64"), weights, lambda x, w: x * w)
        return F.aggregate(each, F.lit(self.intercept), lambda a, b: a + b)


def moments(
    df: DataFrame, features: str = "features", label: str = "label", by: Column | None = None
) -> dict[int, Moments]:
    """Moments of the rows of each value of `by` (a number; without it all rows have 0).

    A task sends one row of sums for each value, and Spark adds them up; the driver gets one row a
    value.
    """
    rows = df.where(F.col(features).isNotNull() & F.col(label).isNotNull()).select(
        (F.lit(0) if by is None else by).cast("int").alias("part"),
        as_array(F.col(features), "float64").alias("x"),
        F.col(label).cast("double").alias("y"),
    )
    if rows.isEmpty():
        return {}
    some = rows.limit(PIVOT_ROWS).agg(
        Summarizer.mean(array_to_vector(F.concat("x", F.array("y")))).alias("mean")
    )
    pivot = np.concatenate([[0.0], some.first()["mean"].toArray()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            part = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy().reshape(len(part), -1)
            z = np.column_stack([np.ones(len(part)), x, batch.column(2).to_numpy()]) - pivot
            for value in np.unique(part).tolist():
                own = z[part == value]
                sums[value] = sums.get(value, 0.0) + own.T @ own
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([s.ravel() for s in sums.values()], pa.list_(pa.float64())),
            ],
            names=["part", "sums"],
        )

    added = rows.mapInArrow(add, "part int, sums array<double>")
    total = added.groupBy("part").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    size = len(pivot)
    return {
        r["part"]: Moments(pivot, r["sums"].toArray().reshape(size, size)) for r in total.collect()
    }


def _descended(gram: np.ndarray, target: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Minimises b'Gb/2 - t'b + l1 |b| + l2/2 b^2, a coordinate at a time."""
    b = np.zeros(len(target))
    if not l1:
        return np.linalg.lstsq(gram + l2 * np.eye(len(b)), target, rcond=None)[0]
    varying = [j for j in range(len(b)) if gram[j, j] > 0]
    for _ in range(MOST_SWEEPS):
        moved = 0.0
        for j in varying:
            pull = target[j] - gram[j] @ b + gram[j, j] * b[j]
            new = math.copysign(max(0.0, abs(pull) - l1), pull) / (gram[j, j] + l2)
            moved = max(moved, abs(new - b[j]))
            b[j] = new
        if moved < TOLERANCE:
            break
    return b


def fit(
    rows: Moments,
    regParam: float = 0.0,  # noqa: N803  names of Spark's parameters
    elasticNetParam: float = 0.0,  # noqa: N803
    fitIntercept: bool = True,  # noqa: N803
) -> Linear:
    """The linear model that minimises the objective over the rows."""
    params = {"regParam": regParam, "elasticNetParam": elasticNetParam, "fitIntercept": fitIntercept}
    means = rows.means()
    spread = np.sqrt(np.maximum(np.diag(rows.products(means)), 0.0))
    # What rounding leaves of a column that doesn't vary is no spread.
    far = np.sqrt(np.diag(rows.sums)[1:] / max(1, rows.n))
    spread[spread <= 1e-7 * far + 1e-14 * np.abs(means)] = 0.0
    x, y = spread[:-1], spread[-1]
    if not rows.n or not y:
        zeros = np.zeros(len(x))
        return Linear(zeros, float(means[-1]) if fitIntercept and rows.n else 0.0, params)
    inner = rows.products(means if fitIntercept else np.zeros(len(means)))
    scale = np.divide(1.0, x, out=np.zeros_like(x), where=x > 0)
    gram = inner[:-1, :-1] * np.outer(scale, scale)
    target = inner[:-1, -1] * scale / y
    strength = regParam / y
    b = _descended(gram, target, strength * elasticNetParam, strength * (1 - elasticNetParam))
    b = b * scale * y
    return Linear(b, float(means[-1] - b @ means[:-1]) if fitIntercept else 0.0, params)


def coefficients(spark: SparkSession, model: Linear) -> DataFrame:
    """Coefficients by dimension; the intercept has dimension -1."""
    rows = [(-1, model.intercept), *enumerate(model.coefficients.tolist())]
    return spark.createDataFrame(rows, "dim int, coefficient double")


@dataclass
class Search:
    """All settings with the errors that they leave on each fold, and the best of them, refitted."""

    settings: list[dict]
    errors: np.ndarray  # settings x folds
    best: Linear

    def results(self, spark: SparkSession) -> DataFrame:
        """One row per setting: `[setting, metric, metric_stddev, best]`; metric is the mean RMSE."""
        rows = [
            (
                ", ".join(f"{name}={value}" for name, value in sorted(setting.items())),
                float(errors.mean()),
                float(errors.std()),
                setting == self.best.params,
            )
            for setting, errors in zip(self.settings, self.errors, strict=True)
        ]
        return spark.createDataFrame(
            rows, "setting string, metric double, metric_stddev double, best boolean"
        )

    def parameters(self, spark: SparkSession) -> DataFrame:
        """The parameters of the best model: `[param, value]`."""
        rows = [(name, str(value)) for name, value in sorted(self.best.params.items())]
        return spark.createDataFrame(rows, "param string, value string")


def search(
    train: DataFrame,
    key: Sequence[str],
    features: str = "features",
    label: str = "label",
    grid: Mapping[str, Sequence] = fixed.LINEAR_GRID,
    folds: int = fixed.FOLDS,
    seed: int = 42,
) -> Search:
    """Cross-validates every setting by its root mean squared error, and refits the best.

    Folds are those of `models.grid_search`: parts of the key. A fold without rows is left out. Of
    settings whose errors are equal but for rounding the first is the best. One scan of the rows, for any grid.
    """
    number = split_number(list(key), [1.0] * folds, f"fold {seed}")
    found = moments(train, features, label, number)
    if not found:
        raise ValueError("no rows to fit")
    total = sum(list(found.values())[1:], next(iter(found.values())))
    settings = [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]
    errors = np.array(
        [
            [
                math.sqrt(fit(total - held, **setting).squared_error(held))
                for _, held in sorted(found.items())
            ]
            for setting in settings
        ]
    )
    best = settings[int(errors.mean(axis=1).round(SAME_ERROR).argmin())]
    return Search(settings, errors, fit(total, **best))
