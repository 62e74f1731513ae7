"""Ordinary least squares per group from one aggregate of sums of products."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayline.operators.joins import attach_lookup


def sums_of_products(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str],
                     intercept: bool = True) -> DataFrame:
    """``(keys, n, gram, moment, yy, means)``: all a regression needs, in one pass.

    With an intercept these are sums around the group's means (covariances merge stably on the
    map side, whatever the level of the data). Rows with a NULL anywhere do not count.
    """
    cols = [y, *xs]
    rows = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols]).dropna(subset=cols)
    n = F.count(F.lit(1))

    def product(a: str, b: str) -> Column:
        return F.covar_pop(a, b) * n if intercept else F.sum(F.col(a) * F.col(b))

    return rows.groupBy(*keys).agg(
        n.alias("n"),
        F.array(*[product(a, b) for i, a in enumerate(xs) for b in xs[:i + 1]]).alias("gram"),
        F.array(*[product(x, y) for x in xs]).alias("moment"),
        product(y, y).alias("yy"),
        F.array(*[F.avg(c) for c in cols]).alias("means"))


def _solved(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str],
            intercept: bool) -> DataFrame:
    """``(keys, coef, se, n, rss)`` with one array entry per term, the intercept first."""
    keys, k = list(keys), len(xs)
    lower = np.tril_indices(k)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            coefs, errors, rests = [], [], []
            for n, packed, moment, yy, means in zip(batch["n"], batch["gram"], batch["moment"],
                                                    batch["yy"], batch["means"]):
                gram = np.zeros((k, k))
                gram[lower] = packed
                gram = gram + np.tril(gram, -1).T
                scale = np.sqrt(np.diag(gram))
                scale[scale == 0] = 1.0
                inverse = np.linalg.pinv(gram / np.outer(scale, scale)) / np.outer(scale, scale)
                coef = inverse @ moment
                rss = max(float(yy - coef @ moment), 0.0)
                dof = n - k - int(intercept)
                sigma2 = rss / dof if dof > 0 else np.nan
                spread = sigma2 * np.diag(inverse)
                if intercept:
                    centre = means[1:]
                    spread = np.append(sigma2 * (1 / n + centre @ inverse @ centre), spread)
                    coef = np.append(means[0] - coef @ centre, coef)
                coefs.append(coef)
                errors.append(np.sqrt(spread))
                rests.append(rss)
            yield batch[[*keys, "n"]].assign(coef=coefs, se=errors, rss=rests)

    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in keys)
    return sums_of_products(df, keys, y, xs, intercept).mapInPandas(
        solve, fields + "n long, coef array<double>, se array<double>, rss double")


def ols(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str],
        intercept: bool = True) -> DataFrame:
    """``(keys, term, coef, se, t, n, rss)``: one row per regressor, the intercept first."""
    names = F.array(*[F.lit(t) for t in (["intercept"] if intercept else []) + list(xs)])
    rows = _solved(df, keys, y, xs, intercept).select(
        *keys, F.inline(F.arrays_zip(names.alias("term"), "coef", "se")), "n", "rss")
    error = F.when(~F.isnan("se") & (F.col("se") > 0), F.col("se"))
    return rows.select(*keys, "term", "coef", error.alias("se"),
                       (F.col("coef") / error).alias("t"), "n", "rss")


def ols_residuals(df: DataFrame, keys: Sequence[str], y: str, xs: Sequence[str],
                  name: str = "resid") -> DataFrame:
    """``df`` with the residual of the group's regression."""
    solved = _solved(df, keys, y, xs, True).withColumnRenamed("coef", "_coef")
    out = attach_lookup(df, solved, list(keys), ["_coef"], measured=True)
    fitted = F.col("_coef")[0]
    for i, x in enumerate(xs):
        fitted = fitted + F.col("_coef")[i + 1] * F.col(x)
    return out.withColumn(name, F.col(y) - fitted).drop("_coef")
