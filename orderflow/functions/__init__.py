from orderflow.functions.clock import day_window, instant, midnight
from orderflow.functions.numbers import to_bigint
from orderflow.functions.text import nth_part, part_count

__all__ = ["day_window", "instant", "midnight", "nth_part", "part_count", "to_bigint"]
