"""Correlation and least squares from moments Spark computes in one pass
(SURVEY E12-E15).

* Correlation: one aggregate with, per pair, ``covar_pop`` and the two
  ``stddev_pop`` restricted to rows where both values are known (pairwise
  NULL deletion), divided with ``try_divide`` so a constant column gives NULL
  instead of failing under ANSI mode.
* OLS: one aggregate of counts, means and ``covar_pop`` per group and NULL
  pattern; every fit merges the patterns in which its columns are all present
  (listwise NULL deletion), so fits share the moments of a pair. ``covar_pop``
  merges centred partial moments, so the Gram matrix is free of the
  cancellation of raw sums and combines map-side. Only the moment rows reach
  the driver, where the small solves run.
  The rank is checked on the correlation scale; a deficient fit gets the
  solution of least norm (pseudo-inverse) and is flagged ``singular``.
* Diagnostics: the coefficients are joined to the rows as one row per group.
  Skewness and kurtosis of the residuals come from Spark's central-moment
  aggregates, the Durbin-Watson sums from sorted ranges of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodframe.functions import distributions as dist
from moodframe.operators.sequence import _listify, squared_steps

#: Groups whose moments may be collected; a larger group domain is an error.
MAX_GROUPS = 10_000
#: Rows of moments (groups x NULL patterns) that may be collected.
MAX_MOMENT_ROWS = 5 * MAX_GROUPS
#: Share of its variance that a column must add to those before it to count.
RANK_TOLERANCE = 1e-10


# E12 -------------------------------------------------------------------------
def correlation_matrix(df: DataFrame, cols: Sequence[str], keys=None, upper_only: bool = False) -> DataFrame:
    """Pearson correlation for every pair of ``cols`` in long form
    ``(keys..., col_a, col_b, corr)``; pairs with a NULL are dropped per
    pair; a constant column gives NULL."""
    keys = _listify(keys)
    cols = list(cols)
    aggs, items = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            xa = F.when(F.col(b).isNotNull(), F.col(a).cast("double"))
            xb = F.when(F.col(a).isNotNull(), F.col(b).cast("double"))
            aggs.append(F.try_divide(F.covar_pop(xa, xb), F.stddev_pop(xa) * F.stddev_pop(xb)).alias(f"r{i}_{j}"))
    wide = df.groupBy(*keys).agg(*aggs)
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if upper_only and j < i:
                continue
            r = F.col(f"r{min(i, j)}_{max(i, j)}")
            items.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), r.alias("corr")))
    return wide.select(*keys, F.inline(F.array(*items)))


# E13 -------------------------------------------------------------------------
@dataclass(frozen=True)
class FitSpec:
    target: str
    features: tuple[str, ...]
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or f"{self.target} ~ {' + '.join(self.features)}"


def _moment_aggs(cols: list[str], pairs: list[tuple[str, str]]) -> list[Column]:
    x = {c: F.col(c).cast("double") for c in cols}
    return ([F.count(F.lit(1)).alias("__n")] + [F.avg(x[c]).alias(f"__m{i}") for i, c in enumerate(cols)]
            + [F.covar_pop(x[a], x[b]).alias(f"__c{i}") for i, (a, b) in enumerate(pairs)])


def _merged(parts: list[tuple[int, np.ndarray, np.ndarray]], m: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and population covariances of disjoint parts together."""
    n, means, products = 0, np.full(m, np.nan), np.full((m, m), np.nan)
    for k, mean, cov in parts:
        if n == 0:
            n, means, products = k, mean, cov * k
            continue
        delta = mean - means
        products = products + cov * k + np.outer(delta, delta) * (n * k / (n + k))
        means = means + delta * (k / (n + k))
        n += k
    return n, means, products / n if n else products


def _inverse(n: int, mx: np.ndarray, sxx: np.ndarray) -> tuple[np.ndarray, int]:
    """Pseudo-inverse of X'X for the design [1, x1..xp], and its rank."""
    p = len(mx)
    scale = np.sqrt(np.maximum(np.diag(sxx), 0.0))
    varies = scale > 1e-12 * np.maximum(np.abs(mx) * math.sqrt(n), 1e-300)
    unit = np.where(varies, 1.0 / np.where(varies, scale, 1.0), 0.0)
    values, vectors = np.linalg.eigh(sxx * np.outer(unit, unit)) if p else (np.zeros(0), np.zeros((0, 0)))
    keep = values > RANK_TOLERANCE
    s = (vectors[:, keep] / values[keep]) @ vectors[:, keep].T * np.outer(unit, unit)
    out = np.empty((p + 1, p + 1))
    out[0, 0] = 1.0 / n + mx @ s @ mx
    out[0, 1:] = out[1:, 0] = -s @ mx
    out[1:, 1:] = s
    rank = 1 + int(keep.sum())
    if rank < p + 1:  # project the directions that the data leave open out of the solution
        free = [np.where(varies, v * unit, 0.0) for v in vectors[:, ~keep].T if np.linalg.norm(v[varies]) > 1e-6]
        free += [np.eye(p)[j] for j in np.flatnonzero(~varies)]
        basis = np.linalg.qr(np.array([np.r_[-mx @ v, v] for v in free]).T)[0]
        project = np.eye(p + 1) - basis @ basis.T
        out = project @ out @ project
    return out, rank


def _solve(n: int, means: np.ndarray, cov: np.ndarray, p: int) -> dict:
    """OLS with intercept from n, means and population covariances of
    [y, x1..xp]. Returns coefficients, standard errors and fit statistics."""
    nan = float("nan")
    out: dict = {"nobs": n, "df_model": p, "df_resid": n - p - 1, "rank": None, "singular": None}
    if n == 0:
        return out | {"coef": [nan] * (p + 1), "se": [nan] * (p + 1), "r2": nan, "ssr": nan}
    my, mx = means[0], means[1:]
    sxx, sxy, syy = n * cov[1:, 1:], n * cov[1:, 0], n * cov[0, 0]
    inv, rank = _inverse(n, mx, sxx)
    dfr = n - rank
    out |= {"df_model": rank - 1, "df_resid": dfr, "rank": rank, "singular": rank < p + 1}
    if dfr <= 0:
        return out | {"coef": [nan] * (p + 1), "se": [nan] * (p + 1), "r2": nan, "ssr": nan}
    beta = inv @ np.r_[n * my, sxy + n * mx * my]
    ssr = max(float(syy - 2 * beta[1:] @ sxy + beta[1:] @ sxx @ beta[1:]), 0.0)
    s2 = ssr / dfr
    se = [math.sqrt(max(s2 * float(v), 0.0)) for v in np.diag(inv)]
    r2 = 1.0 - ssr / syy if syy > 0 else nan
    adj = 1.0 - (n - 1) / dfr * (1.0 - r2) if syy > 0 else nan
    f = (r2 / (rank - 1)) / ((1.0 - r2) / dfr) if rank > 1 and syy > 0 and r2 < 1 else nan
    ll = -n / 2.0 * (math.log(2 * math.pi) + math.log(ssr / n) + 1) if ssr > 0 else nan
    xtx = np.empty((p + 1, p + 1))
    xtx[0, 0] = n
    xtx[0, 1:] = xtx[1:, 0] = n * mx
    xtx[1:, 1:] = sxx + n * np.outer(mx, mx)
    ev = np.linalg.eigvalsh(xtx)
    cond = math.sqrt(ev.max() / ev.min()) if ev.min() > 0 else nan
    return out | {"coef": [float(v) for v in beta], "se": se, "r2": r2, "adj_r2": adj, "f": f,
                  "f_pvalue": dist.f_sf(f, rank - 1, dfr) if not math.isnan(f) else nan, "ll": ll,
                  "aic": -2 * ll + 2 * rank, "bic": -2 * ll + math.log(n) * rank, "ssr": ssr, "cond_no": cond}


def ols_moments(df: DataFrame, specs: Sequence[FitSpec], keys=None) -> list[tuple[tuple, dict]]:
    """``(key values, {columns of a fit: (rows, means, covariances)})`` per group.

    One aggregate serves every fit: it groups by the keys and by which columns
    are NULL, so a column's mean and a pair's covariance are taken once and a
    fit merges the patterns in which all its columns are present. Its rows are
    collected; more than ``MAX_GROUPS`` groups or ``MAX_MOMENT_ROWS`` rows are
    an error."""
    keys = _listify(keys)
    sets = sorted({(s.target, *s.features) for s in specs})
    cols = sorted({c for s in sets for c in s})
    at = {c: i for i, c in enumerate(cols)}
    pairs = sorted({(a, b) for s in sets for a in s for b in s if at[a] <= at[b]})
    present = F.concat(*(F.when(F.col(c).isNull(), "0").otherwise("1") for c in cols)).alias("__present")
    rows = (df.select(*keys, *(c for c in cols if c not in keys), present).groupBy(*keys, "__present")
              .agg(*_moment_aggs(cols, pairs)).limit(MAX_MOMENT_ROWS + 1).collect())
    groups: dict[tuple, list] = {}
    for r in rows:
        groups.setdefault(tuple(r[k] for k in keys), []).append(r)
    if not keys and not rows:
        groups[()] = []
    if len(groups) > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups of {keys}")
    if len(rows) > MAX_MOMENT_ROWS:
        raise ValueError(f"more than {MAX_MOMENT_ROWS} groups of {keys} and NULL patterns of {cols}")
    where = {p: f"__c{i}" for i, p in enumerate(pairs)}
    out = []
    for kv, patterns in groups.items():
        patterns.sort(key=lambda r: r["__present"])
        moments = {}
        for s in sets:
            parts = [(int(r["__n"]), np.array([r[f"__m{at[c]}"] for c in s], dtype=float),
                      np.array([[r[where[min(a, b), max(a, b)]] for b in s] for a in s], dtype=float))
                     for r in patterns if all(r["__present"][at[c]] == "1" for c in s)]
            moments[s] = _merged(parts, len(s))
        out.append((kv, moments))
    return out


def ols_fit(df: DataFrame, specs: Sequence[FitSpec], keys=None, spark: SparkSession | None = None,
            with_tests: bool = True) -> tuple[DataFrame, DataFrame]:
    """(coefficient table, fit table) for every spec and group.

    Coefficients: ``keys..., fit, target, term, coef, std_err, t_value,
    p_value, ci_low, ci_high``. Fits: ``keys..., fit, target, nobs, df_model,
    df_resid, r2, adj_r2, f_stat, f_pvalue, log_lik, aic, bic, cond_no, rank,
    singular``. A fit whose columns are collinear or constant is ``singular``; its
    coefficients are those of least norm and its degrees of freedom follow the rank."""
    spark = spark or df.sparkSession
    keys = _listify(keys)
    coef_rows, fit_rows = [], []
    for kv, moments in ols_moments(df, specs, keys):
        for spec in specs:
            n, means, cov = moments[(spec.target, *spec.features)]
            res = _solve(n, means, cov, len(spec.features))
            dfr = res["df_resid"]
            tq = dist.t_ppf(0.975, dfr) if with_tests and dfr > 0 else float("nan")
            for term, c, se in zip(("Intercept", *spec.features), res["coef"], res["se"]):
                t = c / se if se and not math.isnan(se) and se > 0 else float("nan")
                p = dist.t_sf2(abs(t), dfr) if with_tests and not math.isnan(t) else float("nan")
                coef_rows.append((*kv, spec.label, spec.target, term, _f(c), _f(se), _f(t), _f(p),
                                  _f(c - tq * se), _f(c + tq * se)))
            fit_rows.append((*kv, spec.label, spec.target, n, res["df_model"], dfr,
                             _f(res.get("r2")), _f(res.get("adj_r2")), _f(res.get("f")),
                             _f(res.get("f_pvalue")), _f(res.get("ll")), _f(res.get("aic")),
                             _f(res.get("bic")), _f(res.get("cond_no")), res["rank"], res["singular"]))
    key_fields = [df.schema[k] for k in keys]
    coef_schema = T.StructType(key_fields + [T.StructField(c, T.StringType()) for c in ("fit", "target", "term")]
                               + [T.StructField(c, T.DoubleType()) for c in
                                  ("coef", "std_err", "t_value", "p_value", "ci_low", "ci_high")])
    fit_schema = T.StructType(key_fields + [T.StructField("fit", T.StringType()), T.StructField("target", T.StringType()),
                                            T.StructField("nobs", T.LongType()), T.StructField("df_model", T.LongType()),
                                            T.StructField("df_resid", T.LongType())]
                              + [T.StructField(c, T.DoubleType()) for c in
                                 ("r2", "adj_r2", "f_stat", "f_pvalue", "log_lik", "aic", "bic", "cond_no")]
                              + [T.StructField("rank", T.LongType()), T.StructField("singular", T.BooleanType())])
    return spark.createDataFrame(coef_rows, coef_schema), spark.createDataFrame(fit_rows, fit_schema)


def _f(x):
    if x is None:
        return None
    x = float(x)
    return None if math.isnan(x) or math.isinf(x) else x


# E14 -------------------------------------------------------------------------
def ols_diagnostics(df: DataFrame, specs: Sequence[FitSpec], coefs: DataFrame, order, keys=None) -> DataFrame:
    """Residual diagnostics per fit and group: skew, kurtosis (non-excess),
    Jarque-Bera and its p value, omnibus (D'Agostino-Pearson) and its p value,
    Durbin-Watson in ``order``. The coefficients reach the rows by a join on the
    group; groups without coefficients drop out."""
    keys, order = _listify(keys), _listify(order)
    terms = [(i, t) for i, spec in enumerate(specs) for t in ("Intercept", *spec.features)]
    wide = coefs.groupBy(*keys).agg(*(
        F.max(F.when((F.col("fit") == specs[i].label) & (F.col("term") == t), F.col("coef"))).alias(f"__b{k}")
        for k, (i, t) in enumerate(terms)))
    at = {x: f"__b{k}" for k, x in enumerate(terms)}
    join_on = keys or ["__one"]  # without keys there is one row of coefficients
    rows = df if keys else df.withColumn("__one", F.lit(1))
    joined = rows.join(wide if keys else wide.withColumn("__one", F.lit(1)), join_on)
    names = [f"__e{i}" for i in range(len(specs))]
    residuals = []
    for i, spec in enumerate(specs):
        pred = F.col(at[i, "Intercept"])
        for x in spec.features:
            pred = pred + F.col(at[i, x]) * F.col(x)
        residuals.append((F.col(spec.target) - pred).alias(names[i]))
    d = joined.select(*keys, *order, *residuals)
    aggs = []
    for i, name in enumerate(names):
        aggs += [F.count(name).alias(f"n{i}"), F.skewness(name).alias(f"sk{i}"), F.kurtosis(name).alias(f"ku{i}")]
    items = []
    for i, spec in enumerate(specs):
        n, sk, ku = F.col(f"n{i}").cast("double"), F.col(f"sk{i}"), F.col(f"ku{i}") + 3.0
        jb = n / 6.0 * (sk * sk + (ku - 3.0) * (ku - 3.0) / 4.0)
        items.append(F.struct(F.lit(names[i]).alias("col"), F.lit(spec.label).alias("fit"), F.lit(spec.target).alias("target"),
                              F.col(f"n{i}").alias("nobs"), sk.alias("skew"), ku.alias("kurtosis"),
                              jb.alias("jarque_bera"), F.exp(-jb / 2.0).alias("jb_pvalue")))
    shape = d.groupBy(*keys).agg(*aggs).select(*keys, F.inline(F.array(*items)))
    steps = squared_steps(d, names, order, keys).select(
        *keys, "col", F.try_divide("steps", "squares").alias("durbin_watson"))
    return shape.join(steps, [*keys, "col"], "left").drop("col")


def omnibus(skew: float, kurt: float, n: int) -> tuple[float, float]:
    """D'Agostino-Pearson K^2 from skew and (non-excess) kurtosis, and its p."""
    if n is None or n < 8 or skew is None or kurt is None:
        return float("nan"), float("nan")
    k2 = dist.skew_z(skew, n) ** 2 + dist.kurtosis_z(kurt, n) ** 2
    return k2, dist.chi2_2_sf(k2)


def with_omnibus(diag: DataFrame) -> DataFrame:
    """Add ``omnibus``/``omnibus_pvalue`` (a tiny per-fit frame, so a small
    vectorised pandas step)."""
    import pandas as pd

    def run(it):
        for pdf in it:
            vals = [omnibus(s, k, n) for s, k, n in zip(pdf["skew"], pdf["kurtosis"], pdf["nobs"])]
            pdf = pdf.copy()
            pdf["omnibus"] = [v[0] for v in vals]
            pdf["omnibus_pvalue"] = [v[1] for v in vals]
            yield pdf

    schema = T.StructType(diag.schema.fields + [T.StructField("omnibus", T.DoubleType()),
                                                T.StructField("omnibus_pvalue", T.DoubleType())])
    _ = pd  # pandas is the batch format of mapInPandas
    return diag.mapInPandas(run, schema)


# E15 -------------------------------------------------------------------------
def ols_grid(targets: Sequence[str], feature_sets: Sequence[Sequence[str]],
             controls: Sequence[str] = ()) -> list[FitSpec]:
    """All target x feature-set fits, each with and without the controls."""
    specs = []
    for t in targets:
        for fs in feature_sets:
            specs.append(FitSpec(t, tuple(fs) + tuple(controls)))
            if controls:
                specs.append(FitSpec(t, tuple(fs)))
    return specs
