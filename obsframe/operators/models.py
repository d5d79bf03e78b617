"""Forecast models that fit all keys of a regular series at once."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsframe.binding import Binding
from obsframe.functions import scalar as S
from obsframe.operators import evaluate as E
from obsframe.operators import filters
from obsframe.operators import windows as X
from obsframe.operators.leafwise import LeafwiseBooster, LeafwiseModel
from obsframe.operators.least_squares import dot, fields, gram, ols, solve_rows, square
from obsframe.operators.ordering import largest_group, numbered, over_order, same_rows
from obsframe.operators.resample import future_grid, spacing, validate_series
from obsframe.operators.stationarity import adf
from obsframe.session import attach, cut, link


class ForecastModel(Protocol):
    """What an ensemble needs of a member: a fit and a frame of future values."""

    name: str

    def fit(self, series: DataFrame, b: Binding) -> ForecastModel: ...

    def predict(self, steps: int = 24, level: float = 0.95) -> DataFrame:
        """(key, model, step, ts, forecast, lower, upper)"""
        ...

    def status(self) -> DataFrame:
        """(key, model, n, missing_pct, status): every key it was given, also those it cannot serve."""
        ...


def served(series: DataFrame, b: Binding, fitted: DataFrame, name: str) -> DataFrame:
    """A row per key of ``series``: n, missing_pct, whether the model serves it, and why not.

    ``insufficient`` keys have too few values for the model, ``warning`` ones miss many.
    """
    checked = validate_series(series, b).withColumnRenamed("status", "__status")
    out = link(checked, fitted.select(*b.key).distinct().withColumn("__fitted", F.lit(True)), b.key)
    status = F.when(F.col("__fitted"), F.when(F.col("__status") == "warning", "warning").otherwise("ok"))
    return out.select(
        *b.key, F.lit(name).alias("model"), "n", "missing_pct", F.coalesce(status, F.lit("insufficient")).alias("status")
    )


def shaped(df: DataFrame, b: Binding, name: str) -> DataFrame:
    return df.select(
        *b.key, F.lit(name).alias("model"), F.col("step").cast("int").alias("step"), "ts", "forecast", "lower", "upper"
    )


# ---------------------------------------------------------------- seasonal-additive


class SeasonalModel:
    """Piecewise linear trend plus Fourier seasons, fitted by penalised least squares.

    The multiplicative form is trend x (1 + seasons): the trend of the additive fit, then the seasons as shares
    of it, both by least squares on all rows, whatever their sign.
    """

    # seconds per period and Fourier order
    DAILY, WEEKLY, YEARLY = (86_400, 4), (604_800, 3), (31_557_600, 10)

    def __init__(
        self,
        mode: str = "additive",
        yearly: bool = False,
        weekly: bool = True,
        daily: bool = True,
        changepoints: int = 25,
        changepoint_range: float = 0.8,
        changepoint_penalty: float = 10.0,
    ):
        if mode not in ("additive", "multiplicative"):
            raise ValueError(f"unknown mode {mode!r}")
        self.name = "seasonal" if mode == "additive" else "seasonal_multiplicative"
        self.mode = mode
        self.seasons = [s for s, on in ((self.DAILY, daily), (self.WEEKLY, weekly), (self.YEARLY, yearly)) if on]
        self.knots = [changepoint_range * (i + 1) / changepoints for i in range(changepoints)]
        self.penalty = changepoint_penalty

    def line(self, ts: str) -> list[Column]:
        t = S.epoch_seconds(ts)
        s = F.coalesce(F.try_divide(t - F.col("t0"), F.col("t1") - F.col("t0")), F.lit(0.0))
        return [F.lit(1.0), s, *[F.greatest(s - F.lit(k), F.lit(0.0)) for k in self.knots]]

    def waves(self, ts: str) -> list[Column]:
        out = []
        for period, order in self.seasons:
            # the angle is taken of the remainder: the epoch itself would cost digits
            turn = F.pmod(S.epoch_seconds(ts), F.lit(period)) / period * (2 * math.pi)
            for k in range(1, order + 1):
                out += [F.sin(turn * k), F.cos(turn * k)]
        return out

    def fit(self, series: DataFrame, b: Binding) -> SeasonalModel:
        self.b, self.train = b, series
        ts, v = b.ts, b.value
        known = series.where(F.col(v).isNotNull()).select(*b.key, ts, F.col(v).cast("double").alias(v))
        span = known.groupBy(*b.key).agg(
            F.min(S.epoch_seconds(ts)).alias("t0"), F.max(S.epoch_seconds(ts)).alias("t1")
        )
        rows = attach(known, span, b.key)
        hinges = [1e-6, 1e-6, *[self.penalty] * len(self.knots)]
        waves = [1e-6] * (2 * sum(order for _, order in self.seasons))
        added = self.solved(rows, [*self.line(ts), *self.waves(ts)], hinges + waves, F.col(v))
        if self.mode == "additive":
            self.coefficients = added
            return self
        # the waves kept the trend from following the seasons; what they found is fitted again as shares
        trend = cut(added.select(*b.key, F.slice("beta", 1, len(hinges)).alias("trend")))
        rows = attach(rows, trend, b.key)
        rows = rows.withColumn("__g", dot("trend", F.array(*self.line(ts))))
        shares = [F.col("__g") * w for w in self.waves(ts)]
        season = self.solved(rows, shares, waves, F.col(v) - F.col("__g"))
        self.coefficients = cut(link(season, trend, b.key, "inner"))
        return self

    def solved(self, rows: DataFrame, design: list[Column], ridge: list[float], y: Column) -> DataFrame:
        """Coefficients and residual spread of y on the design, per key."""
        sums = gram(rows, self.b.key, F.array(*design, y), carry=("t0", "t1"))

        def solve(r: dict):
            g = square(r["g"])
            p = len(g) - 1
            beta, ssr = ols(g, range(p), p, np.array(ridge))
            yield {"beta": beta, "sigma": math.sqrt(ssr / r["n"])}

        keep = [*self.b.key, "t0", "t1"]
        return cut(solve_rows(sums, keep, solve, "beta array<double>, sigma double"))

    def predict(self, steps: int = 24, level: float = 0.95) -> DataFrame:
        b = self.b
        rows = link(future_grid(self.train, b, steps), self.coefficients, b.key, "inner")
        if self.mode == "additive":
            value = dot("beta", F.array(*self.line("ts"), *self.waves("ts")))
        else:
            value = dot("trend", F.array(*self.line("ts"))) * (1 + dot("beta", F.array(*self.waves("ts"))))
        half = E.z_value(level) * F.col("sigma")
        out = rows.withColumn("forecast", value)
        out = out.withColumn("lower", F.col("forecast") - half).withColumn("upper", F.col("forecast") + half)
        return shaped(out, b, self.name)

    def status(self) -> DataFrame:
        return served(self.train, self.b, self.coefficients, self.name)


# ---------------------------------------------------------------- ARIMA


class ArimaModel:
    """ARIMA by two-stage regression; difference order from the unit-root test, p and q by AIC."""

    GRID = tuple((p, q) for p in range(3) for q in range(3))

    def __init__(self, order: tuple[int, int, int] | None = None, auto: bool = True, long_order: int = 10):
        self.name = "arima"
        self.order, self.auto, self.long_order = order, auto, long_order

    def fit(self, series: DataFrame, b: Binding) -> ArimaModel:
        self.b, self.train = b, series
        v, m = b.value, self.long_order
        known = series.where(F.col(v).isNotNull()).select(*b.key, *b.order, F.col(v).cast("double").alias("y"))
        g = Binding(key=b.key, ts=b.ts, values=("y",), id=b.id)
        rows = numbered(known, b.key, b.order, "t")
        if self.order:
            rows = rows.withColumn("d", F.lit(self.order[1]))
        else:
            test = adf(known, g).select(*b.key, F.when(F.col("is_stationary"), 0).otherwise(1).alias("d"))
            rows = attach(rows, test, b.key)
        rows = over_order(rows, b.key, ("t",), lambda w: [F.lag("y").over(w).alias("__y1")], before=1)
        sized = rows
        change = F.when(F.col("d") == 0, F.col("y")).otherwise(F.col("y") - F.col("__y1"))
        rows = same_rows(sized, cut(rows.withColumn("z", change).where(F.col("z").isNotNull()).drop("__y1")))

        def long_lags(w):
            past = [F.lag("z", i).over(w) for i in range(1, m + 1)]
            return [F.array(F.lit(1.0), *past).alias("__x")]

        # stage one: a long autoregression whose residuals stand in for the shocks
        lagged = over_order(rows, b.key, ("t",), long_lags, before=m)
        lagged = same_rows(sized, cut(lagged.where(F.col("t") >= m + F.col("d"))))
        sums = gram(lagged, b.key, F.concat("__x", F.array("z")))

        def autoregress(r: dict):
            s = square(r["g"])
            p = len(s) - 1
            yield {"a": ols(s, range(p), p, 1e-9)[0]}

        ar = solve_rows(sums, b.key, autoregress, "a array<double>")
        shocks = attach(lagged, ar, b.key)
        shocks = same_rows(sized, shocks.withColumn("e", F.col("z") - dot("a", F.col("__x"))).drop("a", "__x"))

        # stage two: every (p, q) is a subset of the same five regressors
        def short_lags(w):
            z, e = F.lag("z", 1).over(w), F.lag("e", 1).over(w)
            z2, e2 = F.lag("z", 2).over(w), F.lag("e", 2).over(w)
            return [F.array(F.lit(1.0), z, z2, e, e2, F.col("z")).alias("__x")]

        paired = cut(over_order(shocks, b.key, ("t",), short_lags, before=2))
        full = same_rows(sized, paired.where(F.forall("__x", lambda x: x.isNotNull())))
        sums = gram(full, b.key, F.col("__x"))
        state = F.struct("z", F.element_at("__x", 2).alias("z1"), "e", F.element_at("__x", 4).alias("e1"), "y")
        last = full.groupBy(*b.key).agg(
            F.count(F.lit(1)).alias("n"), F.max("d").alias("d"), F.max_by(state, "t").alias("s")
        )
        last = last.select(*b.key, "n", "d", "s.*")
        fixed, auto, grid = self.order, self.auto, self.GRID

        def choose(r: dict):
            s, n, d = square(r["g"]), r["n"], int(r["d"])
            if fixed:
                wanted = [(fixed[0], fixed[2])]
            elif auto:
                wanted = [o for o in grid if o != (0, 0) or d]
            else:
                wanted = [(1, 1)]
            best = None
            for p, q in wanted:
                const = [0] if d == 0 else []
                cols = [*const, *range(1, 1 + p), *range(3, 3 + q)]
                beta, ssr = ols(s, cols, 5, 1e-9) if cols else (np.zeros(0), float(s[5, 5]))
                sigma2 = max(ssr / n, 1e-300)
                score = n * math.log(sigma2) + 2 * (len(cols) + 1)
                if best is None or score < best[0]:
                    best = (score, p, q, dict(zip(cols, beta)), sigma2)
            score, p, q, beta, sigma2 = best
            coefs = [float(beta.get(c, 0.0)) for c in range(5)]
            yield {"p": p, "d": d, "q": q, "beta": coefs, "sigma2": sigma2, "aic": score}

        fitted = solve_rows(
            link(last.withColumnRenamed("d", "__d"), sums, b.key, "inner").withColumnRenamed("__d", "d_in"),
            [*b.key, "n", "z", "z1", "e", "e1", "y"],
            lambda r: choose(r | {"d": r["d_in"]}),
            "p int, d int, q int, beta array<double>, sigma2 double, aic double",
        )
        self.coefficients = cut(fitted)
        return self

    def status(self) -> DataFrame:
        return served(self.train, self.b, self.coefficients, self.name)

    def orders(self) -> DataFrame:
        return self.coefficients.select(*self.b.key, "n", "p", "d", "q", "beta", "sigma2", "aic")

    def predict(self, steps: int = 24, level: float = 0.95) -> DataFrame:
        z = E.z_value(level)

        def path(r: dict):
            c, phi1, phi2, th1, th2 = r["beta"]
            zs, es, level_now = [r["z1"], r["z"]], [r["e1"], r["e"]], r["y"]
            psi, total, var = [], 0.0, 0.0
            for h in range(steps):
                nxt = c + phi1 * zs[-1] + phi2 * zs[-2] + th1 * es[-1] + th2 * es[-2]
                zs.append(nxt)
                es.append(0.0)
                # response of the differenced series to a shock h steps earlier
                w = 1.0 if h == 0 else phi1 * psi[h - 1] + (phi2 * psi[h - 2] if h > 1 else 0.0) + (th1 if h == 1 else 0.0) + (th2 if h == 2 else 0.0)
                psi.append(w)
                total = total + w if r["d"] else w
                var += total * total
                level_now = level_now + nxt if r["d"] else nxt
                half = z * math.sqrt(r["sigma2"] * var)
                yield {"step": h + 1, "forecast": level_now, "lower": level_now - half, "upper": level_now + half}

        out = solve_rows(
            self.coefficients, self.b.key, path, "step int, forecast double, lower double, upper double"
        )
        grid = future_grid(self.train, self.b, steps)
        return shaped(link(out, grid, (*self.b.key, "step"), "inner"), self.b, self.name)


# ---------------------------------------------------------------- trees


TASK_ROWS = 20_000  # rows that one task goes over in training


class TreeModel:
    """Tree ensemble on lagged features, one model over all keys, rolled forward step by step."""

    MEMORY = max(X.FORECAST_LAGS)

    def __init__(self, name: str, estimator: Callable, holdout: float = 0.8):
        self.name, self.estimator, self.holdout = name, estimator, holdout

    def inputs(self) -> list[str]:
        return [*X.feature_names(self.b.value), "key_level"]

    def assemble(self, df: DataFrame) -> DataFrame:
        stage = VectorAssembler(inputCols=self.inputs(), outputCol="features", handleInvalid="skip")
        return stage.transform(df)

    def fit(self, series: DataFrame, b: Binding, band: bool = True) -> TreeModel:
        """``band`` fits a second time on the first part of each key, for the spread of the residuals; without
        it the bounds are null."""
        self.b = b
        v = b.value
        self.train = series = series.select(*b.key, *b.order, v)
        # the level tells the keys apart however many there are
        self.levels = cut(series.groupBy(*b.key).agg(F.avg(v).alias("key_level")))
        frame = attach(X.forecast_features(series, b), self.levels, b.key)
        frame = cut(X.holdout_split(frame, b, self.holdout))
        ready = self.assemble(frame).select(*b.key, "split", F.col(v).alias("label"), "features")
        ready = cut(ready)
        # training goes over the rows many times: no more tasks than they fill
        ready = ready.coalesce(max(1, -(-ready.count() // TASK_ROWS)))
        resid = F.lit(None).cast("double")
        held = ready.where("split = 'test'")
        if band:
            first = self.estimator().fit(ready.where("split = 'train'"))
            held, resid = first.transform(held), F.stddev_pop(F.col("label") - F.col("prediction"))
        self.spread = cut(held.groupBy(*b.key).agg(resid.alias("resid_std") if band else F.first(resid).alias("resid_std")))
        self.model = self.estimator().fit(ready)
        newest = filters.recent_per_key(series.where(F.col(v).isNotNull()), b, self.MEMORY)
        memory = newest.groupBy(*b.key).agg(
            F.transform(
                F.array_sort(F.collect_list(F.struct((-F.col("recency")).alias("r"), F.col(v).cast("double").alias("v")))),
                lambda s: s.v,
            ).alias("memory")
        )
        state = link(memory, spacing(series, b), b.key, "inner")
        state = link(link(state, self.levels, b.key, "inner"), self.spread, b.key)
        self.state = cut(state.where(F.size("memory") == self.MEMORY))
        return self

    def predict(self, steps: int = 24, level: float = 0.95) -> DataFrame:
        """All steps in one pass: the fitted trees travel as arrays, and every batch of keys rolls them forward."""
        b = self.b
        grown = Trees.of(self.model)  # bounded by the model's size, not by the data
        z, memory, last = E.z_value(level), self.MEMORY, "__last"
        rows = self.state.withColumn(last, S.epoch_seconds("last_ts"))
        rows = rows.select(*b.key, "memory", last, "spacing", "key_level", "resid_std")

        def roll(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                past = np.stack(pdf["memory"].to_numpy()) if len(pdf) else np.zeros((0, memory))
                at, width = pdf[last].to_numpy(), pdf["spacing"].to_numpy()
                half = z * pdf["resid_std"].to_numpy(dtype=float)
                for step in range(1, steps + 1):
                    x = np.column_stack([tree_inputs(past, at + step * width), pdf["key_level"].to_numpy(dtype=float)])
                    value = grown.predict(x)
                    past = np.column_stack([past[:, 1:], value])
                    out = pdf[[*b.key, last, "spacing"]].assign(step=step, forecast=value)
                    yield out.assign(lower=value - half, upper=value + half)

        shape = "step int, forecast double, lower double, upper double"
        out = rows.mapInPandas(roll, ", ".join([*fields(rows, [*b.key, last, "spacing"]), shape]))
        ts = F.timestamp_seconds(F.col(last) + F.col("step") * F.col("spacing")).cast("timestamp_ntz")
        return shaped(out.withColumn("ts", ts), b, self.name)

    def status(self) -> DataFrame:
        return served(self.train, self.b, self.state, self.name)

    def feature_importance(self) -> DataFrame:
        """Share of each input in the fitted model, largest first."""
        scores = zip(self.inputs(), [float(x) for x in self.model.featureImportances.toArray()])
        df = self.state.sparkSession.createDataFrame(list(scores), "feature string, importance double")
        return df.orderBy(F.col("importance").desc(), "feature")


def tree_inputs(past: np.ndarray, seconds: np.ndarray) -> np.ndarray:
    """The inputs that :func:`windows.feature_names` lists, from past values (newest last) and the time."""
    columns = [past[:, -n] for n in X.FORECAST_LAGS]
    for n in X.ROLLING:
        columns += [past[:, -n:].mean(axis=1), past[:, -n:].std(axis=1, ddof=1)]
    at = pd.to_datetime(seconds, unit="s")
    parts = {"hour": at.hour, "day_of_week": at.dayofweek, "month": at.month, "day_of_year": at.dayofyear}
    columns += [np.asarray(v) for v in parts.values()]
    for part in ("hour", "month"):
        angle = 2 * math.pi * np.asarray(parts[part]) / S.CYCLES[part]
        columns += [np.sin(angle), np.cos(angle)]
    columns.append(np.isin(parts["day_of_week"], S.WEEKEND))
    columns.append((parts["hour"] >= S.DAYTIME[0]) & (parts["hour"] <= S.DAYTIME[1]))
    return np.column_stack(columns).astype(float)


class Trees:
    """A fitted tree ensemble as node arrays (tree by node), read off its printed form."""

    def __init__(self, trees: list[list[tuple]], weights: Sequence[float]):
        self.weights, nodes = np.asarray(weights), max(map(len, trees))
        self.feature, self.left, self.right = (np.zeros((len(trees), nodes), int) for _ in range(3))
        self.cut, self.value = (np.zeros((len(trees), nodes)) for _ in range(2))
        for t, grown in enumerate(trees):
            for i, (feature, cut_at, left, right, value) in enumerate(grown):
                self.feature[t, i], self.cut[t, i], self.left[t, i] = feature, cut_at, left
                self.right[t, i], self.value[t, i] = right, value
        self.depth = max(map(depth_of, trees))

    @classmethod
    def of(cls, model) -> Trees:
        if isinstance(model, LeafwiseModel):
            nodes = model.nodes()
            return cls(nodes, [1.0] * len(nodes))
        trees: list[list[tuple]] = []
        for line in model.toDebugString.splitlines()[1:]:
            words = line.split()
            if words[0] == "Tree":
                trees.append([])
                open_nodes: list[int] = []  # splits whose right branch is still to come
                continue
            nodes = trees[-1]
            if words[0] == "Else":
                parent = open_nodes.pop()
                nodes[parent] = (*nodes[parent][:3], len(nodes), 0.0)
            elif words[0] == "If":  # If (feature 3 <= 0.5): the left branch comes next
                open_nodes.append(len(nodes))
                nodes.append((int(words[2]), float(words[4].rstrip(")")), len(nodes) + 1, 0, 0.0))
            else:  # a leaf leads to itself
                nodes.append((0, math.inf, len(nodes), len(nodes), float(words[1])))
        boosted_sum = isinstance(model, GBTRegressionModel)
        return cls(trees, model.treeWeights if boosted_sum else [1.0 / len(trees)] * len(trees))

    def predict(self, x: np.ndarray) -> np.ndarray:
        t, out = np.arange(len(self.left))[None, :], np.empty(len(x))
        for start in range(0, len(x), 1024):
            part = x[start : start + 1024]
            at, row = np.zeros((len(part), t.shape[1]), int), np.arange(len(part))[:, None]
            for _ in range(self.depth):
                below = part[row, self.feature[t, at]] <= self.cut[t, at]
                at = np.where(below, self.left[t, at], self.right[t, at])
            out[start : start + 1024] = self.value[t, at] @ self.weights
        return out


def depth_of(nodes: list[tuple]) -> int:
    """Longest way from the first node to a leaf; children come after their parent."""
    below = [0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        left, right = nodes[i][2:4]
        below[i] = 0 if left == i else 1 + max(below[left], below[right])
    return below[0]


def boosted(rounds: int = 100, depth: int = 6, rate: float = 0.1) -> TreeModel:
    return TreeModel("boosted", lambda: GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=42))


def boosted_wide(rounds: int = 100, leaves: int = 31, rate: float = 0.1) -> TreeModel:
    """The preset of unlimited depth: trees grown leaf by leaf up to a number of leaves."""
    return TreeModel("boosted_wide", lambda: LeafwiseBooster(rounds, leaves, rate))


def forest(trees: int = 100, depth: int = 10) -> TreeModel:
    return TreeModel("forest", lambda: RandomForestRegressor(numTrees=trees, maxDepth=min(depth, 30), seed=42))


# ---------------------------------------------------------------- ensembles


def holdout(series: DataFrame, b: Binding, fraction: float) -> tuple[DataFrame, DataFrame, int]:
    """Training rows, held-out rows numbered by step from 1, and the longest such run."""
    split = cut(X.holdout_split(series, b, fraction))
    first = F.floor(F.lit(fraction) * F.col("n_rows"))
    return numbered_steps(split, b, first)


def last_rows(series: DataFrame, b: Binding, n: int) -> tuple[DataFrame, DataFrame, int]:
    placed = cut(numbered(series, b.key, b.order, "position", "n_rows"))
    first = F.col("n_rows") - n
    return numbered_steps(placed, b, first)


def numbered_steps(placed: DataFrame, b: Binding, first: Column) -> tuple[DataFrame, DataFrame, int]:
    test = placed.where(F.col("position") >= first)
    test = test.select(*b.key, (F.col("position") - first + 1).cast("int").alias("step"), F.col(b.value).alias("actual"))
    train = placed.where(F.col("position") < first).select(*b.key, *b.order, b.value)
    return train, test, test.agg(F.max("step")).first()[0] or 0


def fitted(models: Sequence[ForecastModel], series: DataFrame, b: Binding) -> None:
    """Fit the members where only their forecasts are wanted, not their bands."""
    for m in models:
        m.fit(series, b, band=False) if isinstance(m, TreeModel) else m.fit(series, b)


def all_predictions(models: Sequence[ForecastModel], steps: int, level: float = 0.95) -> DataFrame:
    return reduce(DataFrame.unionByName, [m.predict(steps, level) for m in models])


def evaluate(models: Sequence[ForecastModel], series: DataFrame, b: Binding, fraction: float = 0.8) -> DataFrame:
    """Fit on the first part, forecast the rest, and return the accuracy of every key and model."""
    train, test, steps = holdout(series, b, fraction)
    fitted(models, train, b)
    pairs = E.match_actuals(all_predictions(models, steps), test, b)
    return E.metrics(pairs, (*b.key, "model"))


def side_by_side(predictions: DataFrame, names: Sequence[str], key: Sequence[str]) -> DataFrame:
    """A column of forecasts per model."""
    picks = [F.max(F.when(F.col("model") == n, F.col("forecast"))).alias(n) for n in names]
    return predictions.groupBy(*key, "step", "ts").agg(*picks)


def together(members: DataFrame, key: Sequence[str], name: str, every: bool) -> DataFrame:
    """A row per key from the rows of the members: how the whole serves it and who does not.

    ``ok`` or ``warning`` where all members serve the key. Where some do not: ``insufficient`` if
    ``every`` member is needed, else ``partial`` (the others carry the weight), unless none is left.
    """
    lacking = F.col("status") == "insufficient"
    rows = members.groupBy(*key).agg(
        F.max("n").alias("n"),
        F.max("missing_pct").alias("missing_pct"),
        F.bool_or(~lacking).alias("some"),
        F.bool_or(F.col("status") == "warning").alias("warned"),
        F.array_sort(F.collect_list(F.when(lacking, F.col("model")))).alias("missing"),
    )
    short = F.lit("insufficient") if every else F.when(F.col("some"), "partial").otherwise("insufficient")
    status = F.when(F.size("missing") > 0, short).when(F.col("warned"), "warning").otherwise("ok")
    return rows.select(*key, F.lit(name).alias("model"), "n", "missing_pct", status.alias("status"), "missing")


class WeightedEnsemble:
    """Weighted mean of its members; weights equal, given, or from their accuracy."""

    def __init__(self, models: Sequence[ForecastModel], weights: str | Mapping[str, float] = "equal"):
        self.name, self.models, self.method = "weighted", list(models), weights

    def add(self, model: ForecastModel) -> WeightedEnsemble:
        self.models.append(model)
        return self

    def measure(self, series: DataFrame, b: Binding) -> tuple[DataFrame, DataFrame, int]:
        return holdout(series, b, 0.8)

    def status(self) -> DataFrame:
        """A row per key and member."""
        return reduce(DataFrame.unionByName, [m.status() for m in self.models])

    def own_status(self) -> DataFrame:
        """A row per key: a key that some members cannot serve is forecast by the others."""
        return together(self.status(), self.b.key, self.name, every=False)

    def fit(self, series: DataFrame, b: Binding) -> WeightedEnsemble:
        self.b = b
        self.train = series = series.select(*b.key, *b.order, b.value)
        if self.method == "performance":
            train, test, steps = self.measure(series, b)
            fitted(self.models, train, b)
            pairs = E.match_actuals(all_predictions(self.models, steps), test, b)
            self.weights = cut(E.performance_weights(E.metrics(pairs, (*b.key, "model")), b))
        elif self.method == "equal":
            self.weights = E.equal_weights([m.name for m in self.models])
        else:
            self.weights = dict(self.method)
        for m in self.models:
            m.fit(series, b)
        return self

    def predict(self, steps: int = 24, level: float = 0.95) -> DataFrame:
        key = self.b.key
        mixed = E.weighted(all_predictions(self.models, steps, level), self.weights, (*key, "step", "ts"), key)
        return shaped(mixed, self.b, self.name)


class DynamicEnsemble(WeightedEnsemble):
    """Weights from the accuracy over the newest ``window`` rows of each key, renewed every ``every`` rows."""

    def __init__(self, models: Sequence[ForecastModel], window: int = 24, every: int = 6):
        super().__init__(models, "performance")
        self.name, self.window, self.every = "dynamic", window, every

    def measure(self, series: DataFrame, b: Binding) -> tuple[DataFrame, DataFrame, int]:
        return last_rows(series, b, self.window)

    def renew(self, series: DataFrame) -> bool:
        """Take in a longer series: weights and members are fitted anew once some key has grown by ``every`` rows."""
        if largest_group(series, self.b.key) - largest_group(self.train, self.b.key) < self.every:
            return False
        self.fit(series, self.b)
        return True

    def follow(self, series: DataFrame, b: Binding, fraction: float = 0.8) -> DataFrame:
        """Forecast the held-out part of each key with weights renewed on the way.

        The members are fitted once, on the first part. Every ``every`` steps the weights follow
        the members' errors over the newest ``window`` steps whose actual values are then known;
        up to the first renewal all weigh the same. Returns (key, step, ts, actual, forecast, a
        weight per member). Steps without an actual value are left out, as are keys that a member
        cannot serve (see ``own_status``).
        """
        self.b = b
        self.train = series = series.select(*b.key, *b.order, b.value)
        train, test, steps = holdout(series, b, fraction)
        fitted(self.models, train, b)
        names = [m.name for m in self.models]
        wide = side_by_side(all_predictions(self.models, steps), names, b.key)
        rows = cut(link(wide, test, (*b.key, "step"), "inner"))
        mixed = E.dynamic(rows, Binding(b.key, "step", ("actual",)), "actual", names, self.window, self.every)
        return mixed.select(*b.key, "step", "ts", "actual", "forecast", *[f"weight_{n}" for n in names])


class StackingEnsemble:
    """A second model learns how to combine its members' forecasts of the held-out rows."""

    def __init__(self, models: Sequence[ForecastModel], meta: str = "ridge"):
        if meta not in ("ridge", "lasso", "forest", "boosted"):
            raise ValueError(f"unknown meta learner {meta!r}")
        self.name, self.models, self.meta = "stacking", list(models), meta

    def status(self) -> DataFrame:
        """A row per key and member."""
        return reduce(DataFrame.unionByName, [m.status() for m in self.models])

    def own_status(self) -> DataFrame:
        """A row per key: the second model needs the forecasts of every member."""
        return together(self.status(), self.b.key, self.name, every=True)

    def wide(self, predictions: DataFrame) -> DataFrame:
        return side_by_side(predictions, [m.name for m in self.models], self.b.key)

    def fit(self, series: DataFrame, b: Binding) -> StackingEnsemble:
        self.b = b
        series = series.select(*b.key, *b.order, b.value)
        train, test, steps = holdout(series, b, 0.7)
        fitted(self.models, train, b)
        names = [m.name for m in self.models]
        rows = link(self.wide(all_predictions(self.models, steps)), test, (*b.key, "step"), "inner")
        rows = cut(rows.dropna(subset=[*names, "actual"]))
        if self.meta in ("ridge", "lasso"):
            self.coefficients = cut(self.linear(rows, names))
        else:
            kind = RandomForestRegressor if self.meta == "forest" else GBTRegressor
            size = {"numTrees": 50} if self.meta == "forest" else {"maxIter": 50}
            ready = self.assemble(rows, names).withColumnRenamed("actual", "label")
            self.model = kind(seed=42, **size).fit(ready)
        for m in self.models:
            m.fit(series, b)
        return self

    def assemble(self, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        return VectorAssembler(inputCols=list(names), outputCol="features").transform(rows)

    def linear(self, rows: DataFrame, names: Sequence[str]) -> DataFrame:
        vector = F.array(F.lit(1.0), *[F.col(n) for n in names], F.col("actual").cast("double"))
        sums = gram(rows, self.b.key, vector)
        lasso = self.meta == "lasso"

        def solve(r: dict):
            g = square(r["g"])
            n = g[0, 0]
            mean = g[0, 1:] / n
            centred = g[1:, 1:] - n * np.outer(mean, mean)
            a, rhs = centred[:-1, :-1], centred[:-1, -1]
            beta = lasso_path(a / n, rhs / n, 0.1) if lasso else np.linalg.solve(a + np.eye(len(a)), rhs)
            yield {"intercept": float(mean[-1] - beta @ mean[:-1]), "beta": beta}

        return solve_rows(sums, self.b.key, solve, "intercept double, beta array<double>")

    def predict(self, steps: int = 24, level: float = 0.95) -> DataFrame:
        b, names = self.b, [m.name for m in self.models]
        rows = self.wide(all_predictions(self.models, steps, level)).dropna(subset=names)
        if self.meta in ("ridge", "lasso"):
            rows = link(rows, self.coefficients, b.key, "inner")
            rows = rows.withColumn("forecast", F.col("intercept") + dot("beta", F.array(*names)))
        else:
            rows = self.model.transform(self.assemble(rows, names)).withColumnRenamed("prediction", "forecast")
        # the members' disagreement stands for the uncertainty
        mean = sum((F.col(n) for n in names), F.lit(0.0)) / len(names)
        var = sum(((F.col(n) - mean) * (F.col(n) - mean) for n in names), F.lit(0.0)) / len(names)
        half = F.sqrt(var) * E.z_value(level)
        rows = rows.withColumn("lower", F.col("forecast") - half).withColumn("upper", F.col("forecast") + half)
        return shaped(rows, b, self.name)


def lasso_path(a: np.ndarray, rhs: np.ndarray, alpha: float, rounds: int = 1000) -> np.ndarray:
    """Coordinate descent on the normal equations of least squares with an absolute penalty."""
    beta = np.zeros(len(rhs))
    for _ in range(rounds):
        before = beta.copy()
        for j in range(len(beta)):
            if a[j, j] <= 0:
                continue
            rest = rhs[j] - a[j] @ beta + a[j, j] * beta[j]
            beta[j] = math.copysign(max(abs(rest) - alpha, 0.0), rest) / a[j, j]
        if np.max(np.abs(beta - before)) < 1e-10:
            break
    return beta


def default_ensemble(kind: str = "weighted", rounds: int = 100, trees: int = 100):
    """The five standard members under one of the three ways of combining them."""
    members: list[ForecastModel] = [
        SeasonalModel(),
        ArimaModel(),
        boosted(rounds),
        boosted_wide(rounds),
        forest(trees),
    ]
    if kind == "weighted":
        return WeightedEnsemble(members, "performance")
    if kind == "stacking":
        return StackingEnsemble(members, "ridge")
    if kind == "dynamic":
        return DynamicEnsemble(members)
    raise ValueError(f"unknown ensemble {kind!r}")
