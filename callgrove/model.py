"""Table schemas of a profile collection.

A collection keeps many call-path profiles side by side.  Every table carries
``experiment_id``; ``facts`` stores *exclusive* values in long form, one row per
(experiment, metric, call-tree node, thread) cell, and is by far the largest.
"""

from __future__ import annotations

import enum

from pyspark.sql import types as T

_LONG, _DOUBLE, _STRING = T.LongType(), T.DoubleType(), T.StringType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


EXPERIMENTS = _schema(("experiment_id", _LONG), ("wallclock_time", _DOUBLE))

METRICS = _schema(
    ("experiment_id", _LONG),
    ("metric", _STRING),
    ("display_name", _STRING),
    ("dtype", _STRING),
    ("uom", _STRING),
    ("description", _STRING),
    ("parent_metric", _STRING),
    ("ord", _LONG),
)

LOCATIONS = _schema(
    ("experiment_id", _LONG),
    ("thread_id", _LONG),
    ("machine", _STRING),
    ("node", _STRING),
    ("process", _STRING),
    ("thread", _STRING),
)

CNODES = _schema(
    ("experiment_id", _LONG),
    ("cnode_id", _LONG),
    ("region_id", _LONG),
    ("region_name", _STRING),
    ("file", _STRING),
    ("line", _LONG),
    ("parent_id", _LONG),
    ("path_class", _STRING),
)

FACTS = _schema(
    ("experiment_id", _LONG),
    ("metric", _STRING),
    ("cnode_id", _LONG),
    ("thread_id", _LONG),
    ("value", _DOUBLE),
)

#: Columns that turn the call-tree table into a tree: the path from the root to
#: the node, the node itself last, as three arrays of equal length.
PATH_COLUMNS = _schema(
    ("ids", T.ArrayType(_LONG)),
    ("regions", T.ArrayType(_LONG)),
    ("names", T.ArrayType(_STRING)),
)

TREE = T.StructType(CNODES.fields + PATH_COLUMNS.fields)

TABLES = {
    "experiments": EXPERIMENTS,
    "metrics": METRICS,
    "locations": LOCATIONS,
    "cnodes": CNODES,
    "facts": FACTS,
}

#: ``thread_id`` of values summed over all threads.
ALL_THREADS = -1


class SystemDimension(enum.Enum):
    """What profile algebra does with the machine/node/process/thread dimension."""

    KEEP = "keep"
    """Operands must have the same locations; anything else is an error."""

    REDUCE = "reduce"
    """Threads are summed within their process; processes are aligned by name."""

    COLLAPSE = "collapse"
    """The whole system is summed into one location."""
