"""Analytics on collections of call-path profiles, as Spark data frames."""

from callgrove.errors import (
    CallgroveError,
    ReportError,
    SystemMismatchError,
    TreeError,
    UnknownMetricError,
)
from callgrove.model import SystemDimension
from callgrove.operators.algebra import CompareResult
from callgrove.profile import Profile

__all__ = [
    "CallgroveError",
    "CompareResult",
    "Profile",
    "ReportError",
    "SystemDimension",
    "SystemMismatchError",
    "TreeError",
    "UnknownMetricError",
]
