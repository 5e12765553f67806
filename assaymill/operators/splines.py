"""Natural cubic splines fitted per key from sums over the rows.

A natural spline with knots at quantiles is linear beyond its outermost knots. Its basis
is a handful of column expressions, so a fit is aggregates only: one gathers the products
of the basis, from which a basis with nearly orthonormal columns is made per key, a second
one gathers the products of that with the response. Rows never meet in one task, and the
second basis keeps the accuracy that the squares of the first would lose.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from assaymill.operators.ordering import quantiles

#: Largest dimension of a spline; with fewer rows than given here it loses one for each.
MOST, ROWS_FOR = 4, (3, 6, 30)
_NUMBERS = T.ArrayType(T.DoubleType())


def natural_knots(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Per key ``n``, the ends ``lo`` and ``hi`` of ``x``, the dimension ``width`` and the inner knots ``k1``, ``k2`` as shares of the range.

    A key with one distinct value has width 1: a constant.
    """
    ends = quantiles(df, keys, x, {"lo": 0.0, "q1": 1 / 3, "q2": 1 / 2, "q3": 2 / 3, "hi": 1.0})
    rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    distinct = df.select(*keys, x).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("_distinct"))
    wanted = F.lit(1)
    for least in ROWS_FOR:
        wanted = wanted + (F.col("n") >= least).cast("int")
    inner = lambda q: F.when(F.col("hi") > F.col("lo"), (F.col(q) - F.col("lo")) / (F.col("hi") - F.col("lo")))
    width = F.least(wanted, F.col("_distinct").cast("int"))
    return ends.join(rows, keys).join(distinct, keys).select(
        *keys, "n", "lo", "hi", width.alias("width"), F.when(width == 3, inner("q2")).otherwise(inner("q1")).alias("k1"), inner("q3").alias("k2")
    )


def basis(x: str) -> list[Column]:
    """``MOST`` functions of ``x`` that span the splines of the knots beside it; those beyond ``width`` are zero."""
    u = (F.col(x) - F.col("lo")) / (F.col("hi") - F.col("lo"))
    width = F.col("width")

    def above(knot: Column) -> Column:
        rest = F.greatest(u - knot, F.lit(0.0))
        return rest * rest * rest

    def bend(knot: Column) -> Column:
        return F.when(knot < 1, (above(knot) - above(F.lit(1.0))) / (1 - knot)).otherwise(F.lit(0.0))

    last = F.when(width == 3, F.col("k1")).otherwise(F.col("k2"))
    none = F.lit(0.0)
    return [
        F.lit(1.0),
        F.when(width >= 2, u - 0.5).otherwise(none),
        F.when(width >= 3, bend(F.lit(0.0)) - bend(last)).otherwise(none),
        F.when(width >= 4, bend(F.col("k1")) - bend(last)).otherwise(none),
    ]


def _square(flat) -> np.ndarray:
    out = np.zeros((MOST, MOST))
    out[np.triu_indices(MOST)] = flat
    return out + np.triu(out, 1).T


@F.pandas_udf(_NUMBERS)
def _orthonormal(products: pd.Series) -> pd.Series:
    """Matrix, row by row, that turns the basis with these products into one with orthonormal columns; dependent ones become zero."""
    out = []
    for flat in products:
        gram = _square(flat)
        unit = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
        values, vectors = np.linalg.eigh(gram / np.outer(unit, unit))
        keep = values > 1e-10 * values.max()
        turned = np.where(keep, vectors / np.sqrt(np.where(keep, values, 1.0)), 0.0)
        out.append((turned / unit[:, None]).ravel())
    return pd.Series(out)


@F.pandas_udf(_NUMBERS)
def _solve(turn: pd.Series, products: pd.Series, response: pd.Series) -> pd.Series:
    """Coefficients in the first basis, sum of squared residuals and rank."""
    out = []
    for t, flat, r in zip(turn, products, response):
        gram, right = _square(flat), np.array(r[:MOST])
        c, _, rank, _ = np.linalg.lstsq(gram, right, rcond=1e-8)
        rest = r[MOST] - 2 * float(c @ right) + float(c @ gram @ c)
        out.append([*(np.array(t).reshape(MOST, MOST) @ c), max(rest, 0.0), float(rank)])
    return pd.Series(out)


def _products(columns: list[Column]) -> Column:
    return F.array(*[F.sum(columns[i] * columns[j]) for i in range(MOST) for j in range(i, MOST)])


def fit_spline(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Per key the knots, ``coef`` in ``basis``, and ``noise``, the residual sum of squares over what rank leaves of n.

    ``df`` is read several times: pass a written one. Rows must have both values.
    """
    placed = df.select(*keys, x, y).join(natural_knots(df, keys, x), keys)
    first = basis(x)
    turn = placed.groupBy(*keys).agg(_products(first).alias("_g")).select(*keys, _orthonormal("_g").alias("_turn"))
    names = [f"_b{i}" for i in range(MOST)]
    plain = placed.join(turn, keys).select(*keys, y, "_turn", "n", "lo", "hi", "width", "k1", "k2", *[b.alias(c) for b, c in zip(first, names)])
    turned = [sum((F.col(names[i]) * F.get("_turn", i * MOST + j) for i in range(1, MOST)), F.col(names[0]) * F.get("_turn", j)) for j in range(MOST)]
    sums = plain.groupBy(*keys, "_turn", "n", "lo", "hi", "width", "k1", "k2").agg(
        _products(turned).alias("_g"), F.array(*[F.sum(z * F.col(y)) for z in turned], F.sum(F.col(y) * F.col(y))).alias("_r")
    )
    solved = sums.withColumn("_s", _solve("_turn", "_g", "_r"))
    noise = F.get("_s", MOST) / F.greatest(F.col("n") - F.get("_s", MOST + 1), F.lit(1.0))
    return solved.select(*keys, "n", "lo", "hi", "width", "k1", "k2", F.slice("_s", 1, MOST).alias("coef"), noise.alias("noise"))


def spline_at(x: str) -> Column:
    """The fitted value at ``x`` in a frame joined with ``fit_spline``."""
    terms = [F.get("coef", i) * b for i, b in enumerate(basis(x))]
    return sum(terms[1:], terms[0])
