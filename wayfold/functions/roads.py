"""Road classes, costs and speeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Free-flow speed (km/h) and priority of road classes 0 to 6, then of all others.
CLASS_SPEED = {0: 130.0, 1: 120.0, 2: 110.0}
OTHER_SPEED = 80.0
CLASS_PRIORITY = {0: 0.9, 1: 1.1, 2: 1.2, 3: 1.4, 4: 1.6, 5: 2.5, 6: 3.0}
OTHER_PRIORITY = 5.0
ROAD_CLASSES = range(9)
SPEED_LIMIT = 130.0


def _lookup(key: Column, table: dict[int, float], other: float) -> Column:
    return F.coalesce(reduce(lambda acc, kv: acc.when(key == kv[0], kv[1]), table.items(), F.when(F.lit(False), 0.0)), F.lit(other))


def free_flow_kmh(road_class: Column) -> Column:
    return _lookup(road_class, CLASS_SPEED, OTHER_SPEED)


def priority(road_class: Column) -> Column:
    return _lookup(road_class, CLASS_PRIORITY, OTHER_PRIORITY)


def valid_class(road_class: Column) -> Column:
    """The class, or an error where there is no such class."""
    return F.when(road_class.between(0, 8), road_class).when(road_class.isNull(), F.lit(None)).otherwise(F.raise_error(F.concat(F.lit("no road class "), road_class.cast("string"))).cast("int"))


def cost_distance(length_m: Column) -> Column:
    return length_m


def cost_time(length_m: Column, max_speed: Column) -> Column:
    """Seconds at the road's speed, at most SPEED_LIMIT."""
    return length_m * 3.6 / F.least(max_speed, F.lit(SPEED_LIMIT))


def cost_time_priority(length_m: Column, max_speed: Column, priority: Column) -> Column:
    return cost_time(length_m, max_speed) * F.greatest(F.lit(1.0), priority)


def fractional(cost: Column, fraction: Column) -> Column:
    return cost * fraction


def segment_speed(length_m: Column, dt_ms: Column, whole_seconds: bool = False) -> Column:
    """Metres a second; null where no time passed. whole_seconds drops fractions of a second first."""
    seconds = F.floor(dt_ms / 1000).cast("double") if whole_seconds else dt_ms / 1000.0
    return F.when(seconds > 0, length_m / seconds)


def speed_bin(mps: Column) -> Column:
    """Whole km/h, halves up."""
    return F.floor(mps * 3.6 + 0.5).cast("int")


def mph_of_kmh(kmh: Column) -> Column:
    return kmh * 0.621371


def mph_text(mps: Column) -> Column:
    """Miles an hour cut to a tenth."""
    return F.floor(mps * 2.23694 * 10) / 10


def bins(length_m: Column, bin_size_m: float) -> Column:
    return (F.floor(length_m / bin_size_m) + 1).cast("int")


def bin_of(fraction: Column, n_bins: Column) -> Column:
    return F.when(fraction >= 1, n_bins - 1).otherwise(F.floor(fraction / (1.0 / n_bins)).cast("int"))


#: Eight colours from slow to fast, of our own choice.
PALETTE = ["#d7191c", "#f07c4a", "#fec980", "#ffffbf", "#c7e9ad", "#80bfab", "#4a90b8", "#2b5fa3"]


def colour_bin(kmh: Column) -> Column:
    """ceil(v / 7) - 1, kept in 0..7: eight steps of 60 / 8 km/h cut to whole ones."""
    return F.greatest(F.lit(0), F.least(F.lit(7), (F.ceil(kmh / 7) - 1).cast("int")))


def colour(kmh: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, PALETTE)), colour_bin(kmh) + 1)
