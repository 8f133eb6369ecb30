"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of region names that mark a path class.
_CLASS_PREFIXES = {"MPI_": "MPI", "!$omp": "OMP"}
DEFAULT_CLASS = "USR"


def path_class(explicit: Column, region_name: Column) -> Column:
    """Class of a call path: the stored one, else by the name of its last region."""
    derived = F.lit(DEFAULT_CLASS)
    for prefix, label in _CLASS_PREFIXES.items():
        derived = F.when(F.startswith(region_name, F.lit(prefix)), F.lit(label)).otherwise(derived)
    return F.coalesce(explicit, derived)


def call_path(cls: Column, names: Column) -> Column:
    """``CLASS:/root/.../name``."""
    return F.concat(cls, F.lit(":/"), F.array_join(names, "/"))


def percent_of(value: Column, total: Column) -> Column:
    """Share of ``total`` in percent, 0 where the total is 0 or unknown."""
    return F.when(total != 0, value / total * 100.0).otherwise(F.lit(0.0))


def class_label(cls: Column) -> Column:
    """Three-way label of a path class as shown in rankings."""
    return (
        F.when(cls == "USR", F.lit("user code"))
        .when(cls == "MPI", F.lit("MPI"))
        .otherwise(F.lit("other"))
    )


def hash_id(*columns: Column | str) -> Column:
    """Non-negative 63-bit identifier of a value."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))


def inclusive_name(routine: Column) -> Column:
    """Region name inside ``INCL(...)``, null for any other routine label."""
    name = F.regexp_extract(routine, r"^INCL\((.*)\)$", 1)
    return F.when(F.startswith(routine, F.lit("INCL(")), name)


def tree_label(depth: Column, name: Column) -> Column:
    """Name indented by two blanks per level."""
    return F.concat(F.repeat(F.lit("  "), depth.cast("int")), name)
