"""All registered queries."""

from . import files, hours, models, profiles, rentals, streams
from .catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "files", "hours", "models", "profiles", "rentals", "streams"]
