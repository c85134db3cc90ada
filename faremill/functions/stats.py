"""Closed-form statistics over counts and central moments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sample_skew(n: Column, g1: Column) -> Column:
    """Bias-corrected skewness from the population skewness."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1.0)) / (n - 2.0))


def sample_excess_kurtosis(n: Column, excess: Column) -> Column:
    """Bias-corrected excess kurtosis from the population excess kurtosis."""
    return F.when(n > 3, (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * excess + 6.0))


def skew_score(n: Column, g1: Column) -> Column:
    """D'Agostino (1970) normal score of the population skewness."""
    y = g1 * F.sqrt((n + 1.0) * (n + 3.0) / (F.lit(6.0) * (n - 2.0)))
    beta2 = F.lit(3.0) * (n * n + n * 27.0 - 70.0) * (n + 1.0) * (n + 3.0) / ((n - 2.0) * (n + 5.0) * (n + 7.0) * (n + 9.0))
    w2 = F.sqrt(F.lit(2.0) * (beta2 - 1.0)) - 1.0
    scale = F.sqrt(F.lit(2.0) / (w2 - 1.0))
    return F.try_divide(F.asinh(y / scale), F.sqrt(F.log(F.sqrt(w2))))


def kurtosis_score(n: Column, excess: Column) -> Column:
    """Anscombe and Glynn (1983) normal score of the population kurtosis."""
    expected = F.lit(3.0) * (n - 1.0) / (n + 1.0)
    variance = F.lit(24.0) * n * (n - 2.0) * (n - 3.0) / ((n + 1.0) * (n + 1.0) * (n + 3.0) * (n + 5.0))
    x = (excess + 3.0 - expected) / F.sqrt(variance)
    beta1 = (
        F.lit(6.0) * (n * n - n * 5.0 + 2.0) / ((n + 7.0) * (n + 9.0))
        * F.sqrt(F.lit(6.0) * (n + 3.0) * (n + 5.0) / (n * (n - 2.0) * (n - 3.0)))
    )
    a = F.lit(6.0) + F.lit(8.0) / beta1 * (F.lit(2.0) / beta1 + F.sqrt(F.lit(1.0) + F.lit(4.0) / (beta1 * beta1)))
    base = (F.lit(1.0) - F.lit(2.0) / a) / (F.lit(1.0) + x * F.sqrt(F.lit(2.0) / (a - 4.0)))
    return (F.lit(1.0) - F.lit(2.0) / (a * 9.0) - F.cbrt(base)) / F.sqrt(F.lit(2.0) / (a * 9.0))


def normal_tail(z: Column) -> Column:
    """Two-sided tail of the standard normal (Abramowitz and Stegun 26.2.17, error below 1e-7)."""
    x = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + x * 0.2316419)
    series = t * (F.lit(0.319381530) + t * (F.lit(-0.356563782) + t * (F.lit(1.781477937) + t * (F.lit(-1.821255978) + t * 1.330274429))))
    return F.lit(2.0) * F.exp(-(x * x) / 2.0) / F.sqrt(F.lit(2.0) * F.pi()) * series


def normal_quantile(p: Column) -> Column:
    """Inverse of the standard normal distribution (Acklam's rational approximation)."""
    # Published coefficients of the approximation.
    a = (-3.969683028665376e1, 2.209460984245205e2, -2.759285104469687e2, 1.383577518672690e2, -3.066479806614716e1, 2.506628277459239)
    b = (-5.447609879822406e1, 1.615858368580409e2, -1.556989798598866e2, 6.680131188771972e1, -1.328068155288572e1)
    c = (-7.784894002430293e-3, -3.223964580411365e-1, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
    d = (7.784695709041462e-3, 3.224671290700398e-1, 2.445134137142996, 3.754408661907416)

    def poly(coefficients, x: Column) -> Column:
        total = F.lit(coefficients[0])
        for value in coefficients[1:]:
            total = total * x + value
        return total

    def tail(q: Column) -> Column:
        return poly(c, q) / (poly(d, q) * q + 1.0)

    middle = p - 0.5
    square = middle * middle
    centre = poly(a, square) * middle / (poly(b, square) * square + 1.0)
    lower, upper = F.sqrt(F.lit(-2.0) * F.log(p)), F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - p))
    return F.when(p < 0.02425, tail(lower)).when(p <= 0.97575, centre).otherwise(-tail(upper))
