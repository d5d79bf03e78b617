"""Principal components of standardised features."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.operators.least_squares import solve_rows


def pca(df: DataFrame, b: Binding, components: int = 3, key: Sequence[str] | None = None) -> DataFrame:
    """One row per key and component: variance, shares, loadings; keys with too few rows give status only.

    Standardising and rotating needs no more than the correlation matrix, which
    one aggregate yields for every key.
    """
    key = list(b.key if key is None else key)
    p = len(b.values)
    if not 1 <= components <= p:
        raise ValueError("components must lie between 1 and the number of features")
    rows = df.dropna(subset=list(b.values))
    cells = [F.covar_pop(x, y) for x in b.values for y in b.values]
    moments = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.array(*cells).alias("cov"))
    names = list(b.values)

    def rotate(r: dict):
        if r["n"] < components or r["n"] < 2:
            yield {"status": "insufficient", "component": None}
            return
        cov = np.asarray(r["cov"], dtype=float).reshape(p, p)
        sd = np.sqrt(np.diag(cov))
        sd = np.where(sd > 0, sd, 1.0)
        values, vectors = np.linalg.eigh(cov / np.outer(sd, sd))
        order = np.argsort(values)[::-1]
        values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
        total = values.sum() or 1.0
        for i in range(components):
            axis = vectors[:, i]
            # the sign of an axis is free: its largest loading is made positive
            axis = axis if axis[np.argmax(np.abs(axis))] > 0 else -axis
            yield {
                "status": "ok",
                "component": i + 1,
                "variance": float(values[i]),
                "explained_ratio": float(values[i] / total),
                "cumulative_ratio": float(values[: i + 1].sum() / total),
                "loadings": dict(zip(names, axis.tolist())),
            }

    schema = (
        "status string, component int, variance double, explained_ratio double, cumulative_ratio double, "
        "loadings map<string,double>"
    )
    return solve_rows(moments, [*key, "n"], rotate, schema)


def importance(components: DataFrame, key: Sequence[str]) -> DataFrame:
    """Features by the size of their loading on the first component."""
    first = components.where(F.col("component") == 1)
    out = first.select(*key, F.explode("loadings").alias("feature", "loading"))
    return out.withColumn("importance", F.abs("loading")).orderBy(*key, F.col("importance").desc())
