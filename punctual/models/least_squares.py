"""Linear models from one aggregate of cross products, cross-validated without another scan.

With categories as one column for each value, and numbers beside them, all that least squares needs are counts and
sums of products. They are grouped by the categories (and by fold): one hash aggregate, whose result has as many rows
as there are combinations of categories, however many events there are. Leaving a fold out is a subtraction.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class LinearModel:
    """Intercept, an offset for each value of each category (0 for values not seen), and a slope for each number."""

    intercept: float
    offsets: dict[str, dict[object, float]]
    slopes: dict[str, float]

    def prediction(self) -> Column:
        """The model as an expression; a null number or category counts as 0."""
        out = F.lit(self.intercept)
        for name, values in self.offsets.items():
            if values:
                table = F.create_map(*(F.lit(x) for pair in values.items() for x in pair))
                out = out + F.coalesce(F.try_element_at(table, F.col(name)), F.lit(0.0))
        for name, slope in self.slopes.items():
            out = out + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(slope)
        return out


def cross_products(rows: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """n, sums, and sums of products of numbers and label for each combination of categories.

    Rows without a label are left out; a null number counts as 0.
    """
    names = [*numeric, label]
    value = {name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in names}
    sums = [F.sum(value[a]).alias(f"s_{i}") for i, a in enumerate(names)]
    products = [F.sum(value[names[i]] * value[names[j]]).alias(f"p_{i}_{j}") for i, j in combinations_with_replacement(range(len(names)), 2)]
    return rows.where(F.col(label).isNotNull()).groupBy(*by, *categorical).agg(F.count("*").alias("n"), *sums, *products)


class Products:
    """The cross products of a table, and what follows from them."""

    def __init__(self, collected: list, categorical: Sequence[str], numeric: Sequence[str], fold: str | None = None):
        self.categorical, self.numeric = list(categorical), list(numeric)
        self.values = {c: sorted({r[c] for r in collected if r[c] is not None}) for c in categorical}
        self.columns = [(c, v) for c in categorical for v in self.values[c]]
        place = {key: 1 + i for i, key in enumerate(self.columns)}
        first, m = 1 + len(self.columns), len(numeric) + 1
        self.size = first + m - 1
        # one matrix of products of (1, categories, numbers, label) for each fold
        self.folds: dict[object, np.ndarray] = {}
        for r in collected:
            total = self.folds.setdefault(r[fold] if fold else None, np.zeros((first + m, first + m)))
            flags = np.zeros(first)
            flags[[0, *(place[(c, r[c])] for c in categorical if r[c] is not None)]] = 1
            sums = np.array([r[f"s_{i}"] for i in range(m)])
            inner = np.array([[r[f"p_{min(i, j)}_{max(i, j)}"] for j in range(m)] for i in range(m)])
            total[:first, :first] += r["n"] * np.outer(flags, flags)
            total[:first, first:] += np.outer(flags, sums)
            total[first:, :first] += np.outer(sums, flags)
            total[first:, first:] += inner

    def without(self, fold: object) -> np.ndarray:
        return sum(v for k, v in self.folds.items() if k != fold)

    def whole(self) -> np.ndarray:
        return sum(self.folds.values())

    def solve(self, total: np.ndarray, ridge: float = 0.0) -> np.ndarray:
        """Coefficients; `ridge` is added per row to the squares of all but the intercept. The smallest solution where several fit."""
        a, b = total[:-1, :-1].copy(), total[:-1, -1]
        a[np.arange(1, len(a)), np.arange(1, len(a))] += ridge * total[0, 0]
        scale = 1 / np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1))
        return scale * (np.linalg.pinv(a * scale[:, None] * scale, rcond=1e-12, hermitian=True) @ (b * scale))

    def squared_error(self, total: np.ndarray, coefficients: np.ndarray) -> float:
        both = np.concatenate([coefficients, [-1.0]])
        return max(float(both @ total @ both), 0.0)

    def model(self, coefficients: np.ndarray) -> LinearModel:
        offsets: dict[str, dict[object, float]] = {c: {} for c in self.categorical}
        for (name, value), x in zip(self.columns, coefficients[1:], strict=False):
            offsets[name][value] = float(x)
        slopes = dict(zip(self.numeric, map(float, coefficients[1 + len(self.columns) :]), strict=True))
        return LinearModel(float(coefficients[0]), offsets, slopes)


def least_squares(
    train: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], ridges: Sequence[float] = (0.0,), fold: str | None = None
) -> tuple[LinearModel, dict[float, float]]:
    """The best model over `ridges` and the cross-validated RMSE of each; one job, whatever the number of folds and ridges.

    Without a fold column the first ridge is taken. An empty table gives a model that predicts 0.
    """
    rows = cross_products(train, label, categorical, numeric, [fold] if fold else []).collect()
    if not rows:
        return LinearModel(0.0, {c: {} for c in categorical}, dict.fromkeys(numeric, 0.0)), {}
    products = Products(rows, categorical, numeric, fold)
    errors = {}
    if fold and len(products.folds) > 1:
        for ridge in ridges:
            each = [(m[0, 0], products.squared_error(m, products.solve(products.without(k), ridge))) for k, m in products.folds.items()]
            errors[ridge] = float(np.mean([np.sqrt(e / n) for n, e in each]))
    best = min(errors, key=errors.__getitem__) if errors else ridges[0]
    return products.model(products.solve(products.whole(), best)), errors
