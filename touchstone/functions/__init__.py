from touchstone.functions.values import (
    TOLERANCE,
    UNBOUNDED_US,
    finite_decimal,
    interval_end_us,
    iso_date,
    iso_timestamp,
    missing,
    one_of,
    present,
    quoted,
    within_tolerance,
)

__all__ = [
    "TOLERANCE",
    "UNBOUNDED_US",
    "finite_decimal",
    "interval_end_us",
    "iso_date",
    "iso_timestamp",
    "missing",
    "one_of",
    "present",
    "quoted",
    "within_tolerance",
]
