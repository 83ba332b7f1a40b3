"""Column-level building blocks. Everything returns a ``Column`` built from Spark built-ins."""
from .params import param_value, extract_params
from .timeparts import add_months_py, calendar_parts, micros_of, ymd_of_micros
from .text import page_path, route_segment, strip_py_whitespace, utm_campaign
from .safe import json_text_or_null, nonempty_or_null, strict_least

__all__ = [
    "param_value", "extract_params", "add_months_py", "calendar_parts", "micros_of", "ymd_of_micros",
    "page_path", "route_segment", "strip_py_whitespace", "utm_campaign",
    "json_text_or_null", "nonempty_or_null", "strict_least",
]
