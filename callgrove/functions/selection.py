"""Selection strings such as ``0,1,5-10``."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_ITEM = re.compile(r"(\d+)(?:\s*-\s*(\d+))?")


def id_ranges(text: str) -> list[tuple[int, int]] | None:
    """Disjoint, ascending, inclusive ranges of a selection; ``None`` selects all."""
    if text.strip().lower() == "all":
        return None
    found = []
    for item in text.split(","):
        match = _ITEM.fullmatch(item.strip())
        if match is None:
            raise ValueError(f"bad selection item {item!r} in {text!r}")
        low = int(match[1])
        high = int(match[2]) if match[2] else low
        if high < low:
            raise ValueError(f"empty range {item!r} in {text!r}")
        found.append((low, high))
    merged: list[tuple[int, int]] = []
    for low, high in sorted(found):
        if merged and low <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
        else:
            merged.append((low, high))
    return merged


def id_filter(text: str) -> Callable[[Column], Column] | None:
    """Predicate on an id column, in a form the parquet scan can use."""
    ranges = id_ranges(text)
    if ranges is None:
        return None
    singles = [low for low, high in ranges if low == high]
    spans = [(low, high) for low, high in ranges if low != high]

    def chosen(ids: Column) -> Column:
        tests = [ids.between(low, high) for low, high in spans]
        if singles:
            tests.append(ids.isin(singles))
        return functools.reduce(operator.or_, tests)

    return chosen
