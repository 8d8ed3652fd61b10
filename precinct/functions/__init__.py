"""Column expressions."""

from precinct.functions.features import (
    flag_sum,
    hour_band,
    hour_bucket,
    incident_date,
    incident_type,
    day_type,
    month_key,
    whole_number,
)
from precinct.functions.text import fixed, key_values, minutes, run_seconds, run_stamp, thousands

__all__ = [
    "day_type",
    "fixed",
    "flag_sum",
    "hour_band",
    "hour_bucket",
    "incident_date",
    "incident_type",
    "key_values",
    "minutes",
    "month_key",
    "run_seconds",
    "run_stamp",
    "thousands",
    "whole_number",
]
