"""Column expressions for phases, amplitudes and pair scores; all of them stay in the JVM."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def wrap(x: Column) -> Column:
    """An angle brought to (-pi, pi]."""
    return F.atan2(F.sin(x), F.cos(x))


def wrap_half_open(x: Column) -> Column:
    """An angle brought to [-pi, pi); differs from ``wrap`` at odd multiples of pi alone."""
    return F.pmod(x + F.lit(math.pi), F.lit(2 * math.pi)) - F.lit(math.pi)


def finite(x: Column) -> Column:
    """Not null, NaN or infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def nonzero_sample(re: Column, im: Column) -> Column:
    """A usable complex sample: both parts finite and not both zero."""
    return finite(re) & finite(im) & ~((re == 0) & (im == 0))


def conj_re(re_a: Column, im_a: Column, re_b: Column, im_b: Column) -> Column:
    """Real part of a times the conjugate of b."""
    return re_a * re_b + im_a * im_b


def conj_im(re_a: Column, im_a: Column, re_b: Column, im_b: Column) -> Column:
    """Imaginary part of a times the conjugate of b."""
    return im_a * re_b - re_a * im_b


def rotate(re: Column, im: Column, angle: Column) -> tuple[Column, Column]:
    """A complex sample turned by an angle."""
    c, s = F.cos(angle), F.sin(angle)
    return re * c - im * s, re * s + im * c


def rayleigh_scale2(mean: Column, var: Column) -> Column:
    """Squared Rayleigh scale of amplitudes from their mean and population variance."""
    return (var + mean * mean) / 2


def glrt_statistic(n: int, a: Column, b: Column) -> Column:
    """Likelihood ratio statistic of equal squared scales; null unless both are positive."""
    return F.when((a > 0) & (b > 0), F.lit(float(n)) * (2 * F.log((a + b) / 2) - F.log(a) - F.log(b)))


def glrt_threshold(alpha: float) -> float:
    """The chi-square quantile with one degree of freedom that the statistic stays below."""
    return NormalDist().inv_cdf(1 - alpha / 2) ** 2


def ambiguity(x: Column) -> Column:
    """Whole turns in an angle, halves to even."""
    return F.rint(x / F.lit(2 * math.pi)).cast("int")


def edge_score(days: Column, metres: Column, most_days: float, most_metres: float) -> Column:
    return F.hypot(days / F.lit(float(most_days)), metres / F.lit(float(most_metres)))


def metres(dr: Column, dc: Column, azimuth: float, ground_range: float) -> Column:
    return F.hypot(dr * F.lit(azimuth), dc * F.lit(ground_range))


def years(days: Column) -> Column:
    return days / F.lit(365.25)


def tidy(x: Column, digits: int = 6) -> Column:
    """Rounded, without a negative zero."""
    return F.round(x, digits) + F.lit(0.0)


def ground_range(slant: Column, incidence_degrees: Column) -> Column:
    """Ground spacing of a slant-range spacing at an incidence angle."""
    return slant / F.sin(F.radians(incidence_degrees))


def half_window(radius: Column, spacing: Column) -> Column:
    """Cells that reach at least ``radius`` metres from a cell's centre, one at least."""
    return F.greatest(F.ceil(radius / spacing).cast("int"), F.lit(1))
