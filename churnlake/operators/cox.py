"""Cox proportional hazards with Efron's handling of ties.

A Newton step needs, for every distinct duration, the sums of w, w x and w x x' with
w = exp(x'b), for all rows and for rows with an event. Tasks add them up in blocks (``moments``)
and again after a shuffle by duration; what reaches the driver is one line per distinct duration (days, so a few thousand)
and event flag. Sums over risk sets are suffix sums of those lines, and the sums over a
duration's tied events take the same time however many events there are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake import schema as S
from churnlake.functions import expressions as E
from churnlake.functions import pvalues as P
from churnlake.operators import mlprep as M
from churnlake.operators.moments import time_sums
from churnlake.session import kept, small_frame

Z_95 = 1.959963984540054
#: Tied events that are added one by one; those before them are added by quadrature.
DIRECT = 1024
_NODES, _NODE_WEIGHTS = np.polynomial.legendre.leggauss(16)


def survival_times(features: DataFrame, ref: datetime,
                   horizon_days: int = S.CHURN_DAYS) -> DataFrame:
    """Adds ``duration`` (days, at least 1) and ``event`` from the last activity.

    Activity is an order, a login or a cart row; a user without any has the event.
    """
    threshold = E.ts(ref - timedelta(days=horizon_days))
    last = F.greatest("last_purchase_date", "last_login_at", "last_cart_at")
    until = F.least(last, threshold)
    # Nothing ends before the account starts: such spans count as the shortest one.
    days = E.elapsed_days(F.col("created_at"), until)
    return features.withColumns({
        "last_activity_at": last,
        "event": F.when(last.isNull() | (last < threshold), 1).otherwise(0),
        "duration": E.at_least(days, 1).cast("int"),
    })


def cox_frame(features: DataFrame, ref: datetime,
              horizon_days: int = S.CHURN_DAYS) -> tuple[DataFrame, list[str]]:
    """Duration, event and covariates without missing values, and the covariate names."""
    timed = survival_times(features, ref, horizon_days)
    encoded, dummies = M.one_hot(timed, M.levels(timed, ["gender"]), drop="first")
    numeric = list(S.DRIVER_NUMERIC)
    cleaned = encoded.withColumns({
        **{c: E.finite(F.col(c).cast("double")) for c in numeric},
        "used_coupon": F.col("used_coupon").cast("double"),
    }).na.drop(subset=["duration", "event"])
    filled = M.impute_medians(cleaned, numeric)
    covariates = [*numeric, *dummies, "used_coupon"]
    return filled.select("user_id", "duration", "event", *covariates), covariates


def _duration_sums(df: DataFrame, duration: str, event: str, covariates: Sequence[str],
                   means: np.ndarray, scales: np.ndarray, beta: np.ndarray) -> pd.DataFrame:
    lines = time_sums(df, duration, event, covariates, means, scales, beta)
    table = lines.toArrow().to_pandas().set_index(["duration", "event"]).astype(float)
    return table.sort_index().set_axis(range(table.shape[1]), axis=1)


def tied_sums(deaths: int, s0: float, e0: float) -> np.ndarray:
    """Sums over the tied events k = 0 .. deaths - 1 of log r, r, k' r, r r, k' r r and k' k' r r.

    k' = k / deaths and r = 1 / (s0 - k' e0): Efron's k-th tied event leaves that share of the
    tied weight out of the risk set. The last ``DIRECT`` events, next to the pole of r, are added
    one by one. Those before are an integral between half steps (Gauss-Legendre on blocks that
    double away from the pole) with the first end correction, true to about 1e-12.
    """
    def terms(left: np.ndarray) -> np.ndarray:  # left = deaths - k
        share = 1.0 - left / deaths
        r = 1.0 / ((s0 - e0) + e0 * (left / deaths))
        return np.stack([np.log(r), r, share * r, r * r, share * r * r, share * share * r * r])

    total = terms(np.arange(1.0, min(deaths, DIRECT) + 1)).sum(axis=1)
    if deaths > DIRECT:
        near, far = DIRECT + 0.5, deaths + 0.5
        cuts = near * 2.0 ** np.arange(math.ceil(math.log2(far / near)) + 1)
        cuts[-1] = far
        half = np.diff(cuts) / 2
        left = (cuts[:-1] + half)[:, None] + half[:, None] * _NODES
        total += terms(left.ravel()) @ (half[:, None] * _NODE_WEIGHTS).ravel()

        def slope(left: float) -> np.ndarray:  # by left; r' = -q r r, k'' = -1 / deaths
            share, q = 1.0 - left / deaths, e0 / deaths
            r = 1.0 / ((s0 - e0) + q * left)
            return np.array([
                -q * r, -q * r * r, -r / deaths - share * q * r * r, -2 * q * r**3,
                -r * r / deaths - 2 * share * q * r**3,
                -2 * share * r * r / deaths - 2 * share**2 * q * r**3])

        total -= (slope(far) - slope(near)) / 24
    return total


def _likelihood(sums: pd.DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood, gradient and information from the sums per duration."""
    p = len(beta)
    upper = np.triu_indices(p)
    weighted = sums.iloc[:, 1 + p:]
    risk = weighted.groupby(level="duration").sum()
    died = sums[sums.index.get_level_values("event") == 1]
    at_risk = risk.to_numpy()[::-1].cumsum(axis=0)[::-1]
    at_risk = at_risk[risk.index.get_indexer(died.index.get_level_values("duration"))]
    tied = died.to_numpy()[:, 1 + p:]
    s0, s1, s2 = at_risk[:, 0], at_risk[:, 1:1 + p], at_risk[:, 1 + p:]
    e0, e1, e2 = tied[:, 0], tied[:, 1:1 + p], tied[:, 1 + p:]
    weights = np.array([tied_sums(int(round(n)), s, e) for n, s, e in zip(died[0], s0, e0)])
    logs, a, b, c0, c1, c2 = weights.reshape(-1, 6).T
    x_sum = died.to_numpy()[:, 1:1 + p].sum(axis=0)
    gradient = x_sum - (a @ s1 - b @ e1)
    second = np.zeros((p, p))
    second[upper] = a @ s2 - b @ e2
    second = second + np.triu(second, 1).T
    cross = (s1 * c1[:, None]).T @ e1
    information = second - (
        (s1 * c0[:, None]).T @ s1 - cross - cross.T + (e1 * c2[:, None]).T @ e1
    )
    return float(x_sum @ beta + logs.sum()), gradient, information


def cox_fit(df: DataFrame, covariates: Sequence[str], duration: str = "duration",
            event: str = "event", max_iter: int = 50, tolerance: float = 1e-7) -> DataFrame:
    """Coefficient table: coef, hazard ratio, standard error, 95 % interval, z, p, -log2 p.

    Unpenalised; covariates are standardised for the steps and scaled back at the end.
    """
    scaler = M.fit_scaler(df, list(covariates))
    means = np.array([scaler.means[c] for c in covariates])
    scales = np.array([scaler.scales[c] for c in covariates])
    beta = np.zeros(len(covariates))
    with kept(df.select(duration, event, *map(E.col, covariates))) as rows:
        sums = _duration_sums(rows, duration, event, covariates, means, scales, beta)
        value, gradient, information = _likelihood(sums, beta)
        for _ in range(max_iter):
            step = np.linalg.lstsq(information, gradient, rcond=None)[0]
            if float(gradient @ step) < tolerance:
                break
            size = 1.0
            while True:
                trial = beta + size * step
                sums = _duration_sums(rows, duration, event, covariates, means, scales, trial)
                new = _likelihood(sums, trial)
                if new[0] >= value - 1e-10 or size < 1e-6:
                    break
                size /= 2.0
            gained = new[0] - value
            beta, (value, gradient, information) = trial, new
            if gained <= 1e-9 * abs(value):
                break
    spread = np.sqrt(np.maximum(np.diag(np.linalg.pinv(information)), 0.0))
    table = []
    for name, coef, se in zip(covariates, beta / scales, spread / scales):
        z = coef / se if se > 0 else math.nan
        p = P.normal_two_sided(z) if se > 0 else math.nan
        bits = -math.log2(p) if p > 0 else math.inf
        low, high = coef - Z_95 * se, coef + Z_95 * se
        with np.errstate(over="ignore"):
            ratios = [float(np.exp(v)) for v in (coef, low, high)]
        table.append((name, float(coef), ratios[0], float(se), float(low), float(high),
                      ratios[1], ratios[2], float(z), float(p), float(bits)))
    return small_frame(
        df.sparkSession, table,
        "covariate STRING, coef DOUBLE, hazard_ratio DOUBLE, se DOUBLE, coef_low DOUBLE, "
        "coef_high DOUBLE, hr_low DOUBLE, hr_high DOUBLE, z DOUBLE, p_value DOUBLE, "
        "neg_log2_p DOUBLE",
    )


def cox_gradient(df: DataFrame, fitted: DataFrame, duration: str = "duration",
                 event: str = "event") -> DataFrame:
    """Slope of the log-likelihood per row at fitted coefficients, by standardised covariate.

    ``fitted`` is the table of ``cox_fit`` (one line per covariate). Zero at a maximum.
    """
    lines = fitted.select("covariate", "coef").collect()
    names = [r["covariate"] for r in lines]
    scaler = M.fit_scaler(df, names)
    means, scales = ([f[c] for c in names] for f in (scaler.means, scaler.scales))
    beta = np.array([r["coef"] for r in lines]) * scales
    sums = _duration_sums(df, duration, event, names, np.array(means), np.array(scales), beta)
    _, gradient, _ = _likelihood(sums, beta)
    rows = [(c, float(g) / float(sums[0].sum())) for c, g in zip(names, gradient)]
    return small_frame(df.sparkSession, rows, "covariate STRING, gradient DOUBLE")
