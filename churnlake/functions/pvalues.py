"""Tail probabilities for test statistics; one number per tested variable."""

from __future__ import annotations

import math

_TINY = 1e-300


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def chi_square_tail(x: float, dof: int) -> float:
    """Upper tail of chi-square by the finite recurrence for whole degrees of freedom."""
    if x <= 0:
        return 1.0
    half = x / 2.0
    # Q(a+1, h) = Q(a, h) + h^a e^-h / Gamma(a+1), from a = 1/2 or from a = 0
    a, tail = (0.5, math.erfc(math.sqrt(half))) if dof % 2 else (0.0, 0.0)
    while a < dof / 2.0 - 1e-9:
        tail += math.exp(a * math.log(half) - half - math.lgamma(a + 1.0))
        a += 1.0
    return min(1.0, tail)


def student_two_sided(t: float, dof: float) -> float:
    """Two-sided tail of Student's t: the regularised incomplete beta function."""
    if math.isnan(t) or math.isnan(dof):
        return math.nan
    return incomplete_beta(dof / (dof + t * t), dof / 2.0, 0.5)


def incomplete_beta(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(1.0 - x, b, a)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    ) / a
    c, d = 1.0, 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0))
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        d = 1.0 / _away_from_zero(1.0 + even * d)
        c = _away_from_zero(1.0 + even / c)
        value *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        d = 1.0 / _away_from_zero(1.0 + odd * d)
        c = _away_from_zero(1.0 + odd / c)
        value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * value


def _away_from_zero(v: float) -> float:
    return v if abs(v) > _TINY else _TINY


def mann_whitney_exact(u: int, n1: int, n2: int) -> float:
    """Two-sided p-value of U without ties: the share of all orders at least as far out.

    The numbers of orders with each U are the coefficients of the product of
    (1 - q^(large + i)) / (1 - q^i) for i up to the smaller class's rows; whole numbers
    throughout, in time that grows with n1 n2 times the smaller class.
    """
    small, large = sorted((n1, n2))
    ways = [1] + [0] * (small * large)
    for i in range(1, small + 1):
        for v in range(len(ways) - 1, large + i - 1, -1):
            ways[v] -= ways[v - large - i]
        for v in range(i, len(ways)):
            ways[v] += ways[v - i]
    tail = sum(ways[max(u, n1 * n2 - u):])
    return min(1.0, 2 * tail / sum(ways))
