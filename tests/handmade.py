"""A profile small enough to work out every value on paper.

    0 main            10 = 1 + 2 + 3 + 4 (threads 0..3)
    +- 1 work         40 = 10 + 0 + 30 + 0
    |  +- 2 work      10 = 5 + 5 + 0 + 0     (recursive)
    +- 3 MPI_Send      8 = 0 + 0 + 0 + 8
    +- 4 MPI_Send      2 = 2 + 0 + 0 + 0     (sibling of equal name)
    5 init             no values             (second root)
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from callgrove import Profile, model

TIME = {
    (0, 0): 1.0, (0, 1): 2.0, (0, 2): 3.0, (0, 3): 4.0,
    (1, 0): 10.0, (1, 2): 30.0,
    (2, 0): 5.0, (2, 1): 5.0,
    (3, 3): 8.0,
    (4, 0): 2.0,
}
VISITS = {(0, 0): 1.0, (1, 0): 2.0, (1, 2): 1.0, (3, 3): 4.0}
NODES = [
    (0, 10, "main", "main.f90", 3, None),
    (1, 11, "work", "work.f90", 7, 0),
    (2, 11, "work", "work.f90", 7, 1),
    (3, 12, "MPI_Send", None, None, 0),
    (4, 12, "MPI_Send", None, None, 0),
    (5, 13, "init", "main.f90", 90, None),
]


def handmade_profile(
    spark: SparkSession,
    experiment_id: int = 1,
    *,
    metrics: dict[str, dict] | None = None,
    threads: tuple[int, ...] = (0, 1, 2, 3),
    nodes: list[tuple] = NODES,
    wallclock: float | None = None,
) -> Profile:
    values = {"time": TIME, "visits": VISITS} if metrics is None else metrics
    e = experiment_id
    tables = {
        "experiments": [(e, wallclock)],
        "metrics": [
            (e, name, name.title(), "DOUBLE", "sec", f"all {name}", None, i)
            for i, name in enumerate(values)
        ],
        "locations": [
            (e, t, "cluster", "node 0", f"rank {t // 2}", f"thread {t % 2}") for t in threads
        ],
        "cnodes": [(e, *node, None) for node in nodes],
        "facts": [
            (e, name, node, thread, value)
            for name, cells in values.items()
            for (node, thread), value in cells.items()
            if thread in threads
        ],
    }
    frames = {
        name: spark.createDataFrame(rows, model.TABLES[name]) for name, rows in tables.items()
    }
    return Profile(**frames, experiment_id=experiment_id)
