"""Column-expression helpers (all native Spark expressions)."""

from .codes import SEASON_CODES, SEASON_DEFAULT, WEATHER_CODES, WEATHER_DEFAULT, code_label
from .hashing import SPACE, cumulative_thresholds, hash_unit, threshold

__all__ = [
    "SEASON_CODES", "SEASON_DEFAULT", "SPACE", "WEATHER_CODES", "WEATHER_DEFAULT",
    "code_label", "cumulative_thresholds", "hash_unit", "threshold",
]
