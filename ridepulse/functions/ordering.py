"""Domain order of the category columns, as an ordinal to sort or encode by."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category levels in the order reports show them.
DOMAIN_ORDER = {
    "dayofweek": ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"],
    "timesofday": ["Morning", "Afternoon", "Evening", "Night"],
    "season": ["Winter", "Spring", "Summer", "Autumn"],
    "rainfall_intensity": ["no rain", "drizzle", "light rain", "moderate rain", "heavy rain"],
    "wind_speed_group": [
        "Calm / Light Breeze",
        "Breeze",
        "Moderate Breeze",
        "Strong Breeze / Near Gale",
        "Gale / Storm",
    ],
    "battery_status": ["< 30%", "30% - 50%", "50% - 80%", "> 80%"],
}


def ordinal_of(value: Column, levels: list[str]) -> Column:
    """Position of the value in ``levels``, -1 for anything else."""
    lookup = F.create_map(*[part for i, level in enumerate(levels) for part in (F.lit(level), F.lit(i))])
    return F.coalesce(F.element_at(lookup, value), F.lit(-1))


def domain_ordinal(column: str, value: Column | None = None) -> Column:
    return ordinal_of(F.col(column) if value is None else value, DOMAIN_ORDER[column])
