from playback_qos.functions.paths import col_or_null, has_path
from playback_qos.functions.qos import (
    clamp_non_negative,
    dominant_quality,
    ratio_or_zero,
    tier_column,
    total_received,
)

__all__ = [
    "clamp_non_negative",
    "col_or_null",
    "dominant_quality",
    "has_path",
    "ratio_or_zero",
    "tier_column",
    "total_received",
]
