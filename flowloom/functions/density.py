"""Normal densities and guarded logarithms as Column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def normal_pdf(x: Column, mean: float, sd: float) -> Column:
    """Density of N(mean, sd) at x."""
    return F.exp(-F.pow(x - mean, 2) / (2 * sd * sd)) / (sd * math.sqrt(2 * math.pi))


def log_if_positive(guard: Column, value: Column) -> Column:
    """ln(value) where the guard is above zero, else 0; a density that underflows to 0 gives -infinity."""
    log = F.when(value > 0, F.ln(value)).otherwise(F.lit(-math.inf))
    return F.when(guard > 0, log).otherwise(F.lit(0.0))


def mixture_pdf(size: Column, gap: Column, components) -> Column:
    """Density of a mixture of normals with diagonal covariance over (size, gap).

    ``components`` holds (weight, (size mean, size sd), (gap mean, gap sd)) entries.
    """
    total = F.lit(0.0)
    for weight, (size_mean, size_sd), (gap_mean, gap_sd) in components:
        total = total + F.lit(weight) * normal_pdf(size, size_mean, size_sd) * normal_pdf(gap, gap_mean, gap_sd)
    return total
