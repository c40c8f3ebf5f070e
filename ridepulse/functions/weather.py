"""Weather expressions: rain level, wind scales, rounding and comfort flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limits in m/s of Beaufort 0 to 11.
BEAUFORT_LIMITS = (0.3, 1.5, 3.4, 5.4, 7.9, 10.7, 13.8, 17.1, 20.7, 24.4, 28.4, 32.6)


def rain_level(rain: Column) -> Column:
    """Name of the rain intensity in mm per hour; a negative reading counts as drizzle."""
    return (
        F.when(rain == 0, "no rain")
        .when(rain <= 0.3, "drizzle")
        .when(rain <= 0.5, "light rain")
        .when(rain <= 4, "moderate rain")
        .when(rain > 4, "heavy rain")
    )


def knots_to_ms(knots: Column) -> Column:
    return knots * F.lit(0.514)


def ms_to_knots(ms: Column) -> Column:
    return ms * F.lit(3.6 / 1.852)


def beaufort(ms: Column) -> Column:
    """Beaufort number 0 to 12: the first limit the speed stays below, 12 at or above all."""
    scale = F.when(ms.isNull(), None)
    for number, limit in enumerate(BEAUFORT_LIMITS):
        scale = scale.when(ms < limit, number)
    return scale.otherwise(len(BEAUFORT_LIMITS))


def wind_group(scale: Column) -> Column:
    """Five named groups of the Beaufort scale."""
    return (
        F.when(scale < 3, "Calm / Light Breeze")
        .when(scale < 4, "Breeze")
        .when(scale < 6, "Moderate Breeze")
        .when(scale < 8, "Strong Breeze / Near Gale")
        .when(scale >= 8, "Gale / Storm")
    )


def round_half_away(x: Column) -> Column:
    """Nearest integer, halves away from zero."""
    return F.round(x).cast("int")


def round_half_even(x: Column) -> Column:
    """Nearest integer, halves to the even neighbour."""
    return F.bround(x).cast("int")


def is_ideal(temp: Column, wind: Column) -> Column:
    return F.when((temp > 27) & (wind < 30), 1).otherwise(0)


def is_sticky(working_day: Column, humidity: Column) -> Column:
    return F.when(working_day & (humidity >= 60), 1).otherwise(0)


def blend(first: Column, second: Column, first_weight: float = 0.2) -> Column:
    """Weighted mean of two predictions, rounded to the even neighbour on a tie."""
    return F.bround(first * F.lit(first_weight) + second * F.lit(1 - first_weight))


def is_high_demand(predicted: Column, limit: int = 8) -> Column:
    return predicted > limit
