"""Column expressions (all JVM-side built-ins; Python twins only for tests)."""

from fundcast.functions.casts import lenient_int, null_token
from fundcast.functions.dates import calendar_days, epoch_to_text, hours_between
from fundcast.functions.repair import repair_country, repair_currency
from fundcast.functions.text import (
    join_text,
    quote_runs_to_space,
    split_lines,
    split_on_space,
)

__all__ = [
    "lenient_int",
    "null_token",
    "calendar_days",
    "epoch_to_text",
    "hours_between",
    "repair_country",
    "repair_currency",
    "join_text",
    "quote_runs_to_space",
    "split_lines",
    "split_on_space",
]
