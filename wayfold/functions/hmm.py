"""Probabilities of the hidden Markov model."""

from __future__ import annotations

from math import pi, sqrt

from pyspark.sql import Column
from pyspark.sql import functions as F

AZIMUTH_VARIANCE, LEAST_AZIMUTH_FACTOR = 100.0, 0.01


def emission(distance_m: Column, sigma: float) -> Column:
    return 1 / sqrt(2 * pi * sigma * sigma) * F.exp(-0.5 * distance_m * distance_m / (sigma * sigma))


def azimuth_factor(sample: Column, road: Column) -> Column:
    """Of the circular difference, which enters the exponent as it is, not squared."""
    d = F.abs(sample - road)
    d = F.least(d, 360 - d)
    return F.greatest(F.lit(LEAST_AZIMUTH_FACTOR), 1 / sqrt(2 * pi * AZIMUTH_VARIANCE) * F.exp(-0.5 * d / AZIMUTH_VARIANCE))


def transition(route_cost: Column, sample_distance_m: Column, dt_ms: Column, beta_lambda: float) -> Column:
    base = sample_distance_m / 60.0
    beta = 2 * F.greatest(F.lit(1.0), dt_ms.cast("double")) / 1000.0 if beta_lambda == 0 else F.lit(1.0 / beta_lambda)
    return 1 / beta * F.exp(-F.greatest(F.lit(0.0), route_cost - base) / beta)


def search_bound(dt_ms: Column, max_distance_m: float) -> Column:
    """Metres that a route between two samples may have."""
    return F.greatest(F.lit(1000.0), F.least(F.lit(float(max_distance_m)), F.floor(dt_ms / 1000) * 100.0))
