"""Column expressions: units, time, text."""

from tidegauge.functions.text import id_parts, reading_line, without_trailing_empty
from tidegauge.functions.time import end_iso, end_ms, floor_to
from tidegauge.functions.units import celsius

__all__ = ["celsius", "end_iso", "end_ms", "floor_to", "id_parts", "reading_line",
           "without_trailing_empty"]
